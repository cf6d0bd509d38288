"""Text files: cells, positions, formats, identities and the registry document."""

import csv
import hashlib
import io
import json
import random

import pytest

from tallybook.errors import FormatDetectionError, MappingError
from tallybook.sources import delimited as S
from tallybook.sources import reference_tables as RT
from tallybook.sources import sinks
from tallybook.sources.records import numbered_records, staged_lines
from tallybook.sources.manifest import file_digests, source_manifest


def scan(spark, path, delimiter=",", encoding="utf-8", **options):
    header = S.header_of(spark, str(path), encoding, delimiter)
    return header, S.all_text_scan(spark, str(path), header, encoding, delimiter, **options)


def test_cells_blank_missing_surplus_and_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        'A,B,C\n1,,"x, y"\n2,"say ""hi""", padded \n3\n4,,"q,""r""",extra,more\n\n 5,0.00,""\n', encoding="utf-8"
    )
    header, rows = scan(spark, path)
    placed = rows.orderBy("row_number").collect()
    assert header == ["A", "B", "C"]
    assert [(r.row_number, r.A, r.B, r.C, r["__extra__"]) for r in placed] == [
        (1, "1", "", "x, y", None),
        (2, "2", 'say "hi"', " padded ", None),
        (3, "3", None, None, None),
        (4, "4", "", 'q,"r"', ["extra", "more"]),
        (5, " 5", "0.00", "", None),
    ]


def test_byte_order_mark_and_repeated_header(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("﻿A,B,A\n1,2,3\n", encoding="utf-8")
    header, rows = scan(spark, path)
    assert header == ["A", "B", "A"]
    row = rows.first()
    assert (row.A, row.B) == ("3", "2")


def test_latin_text_and_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes('N|T\n1|Müller\n2|"two\nlines"\n'.encode("latin-1"))
    _, rows = scan(spark, path, "|", "latin-1")
    assert sorted((r.N, r["T"]) for r in rows.collect()) == [("1", "Müller"), ("2", "two\nlines")]


def test_positions_hold_over_many_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for f, count in (("a.csv", 700), ("b.csv", 3000), ("c.csv", 1)):
        lines = [f"{i},{'x' * (i % 50)}" for i in range(1, count + 1)]
        (folder / f).write_text("N,T\n" + "\n".join(lines) + "\n")
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = staged_lines(spark, str(folder), [","])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert lines.rows.select("block_key").distinct().count() > 5
    placed = S.all_text_scan(spark, str(folder), ["N", "T"], "utf-8", ",", lines)
    assert placed.where("row_number <> cast(N AS bigint)").count() == 0
    assert placed.count() == 3701


def test_format_audit(spark, tmp_path):
    folder = tmp_path / "audit"
    folder.mkdir()
    (folder / "empty.csv").write_bytes(b"")
    (folder / "breaks.csv").write_text('a,b\n"1\n2","x, ""y\n\n"\n')
    (folder / "western.csv").write_bytes("a,b\n\u20ac5,\u201cx\u201d\n".encode("cp1252"))
    (folder / "comma.csv").write_text('a,b,c\n1,"x,y",3\n\n4,5,6\n')
    (folder / "tab.tsv").write_bytes("a\tb\n1\tM\xfcller, x\n".encode("latin-1"))
    (folder / "tie.txt").write_text("a|b\t1\nc|d\t2\n")
    (folder / "ragged.csv").write_text("a,b\n1\n")
    audit = S.format_audit(spark, str(folder), ["utf-8", "cp1252", "latin-1"], [",", "\t", "|"])
    got = {r.source_file: (r.encoding, r.delimiter, r.width) for r in audit.collect()}
    assert got == {
        "empty.csv": (None, None, None),
        "breaks.csv": ("utf-8", ",", 2),
        "western.csv": ("cp1252", ",", 2),
        "comma.csv": ("utf-8", ",", 3),
        "tab.tsv": ("cp1252", "\t", 2),
        "tie.txt": ("utf-8", "\t", 2),
        "ragged.csv": ("utf-8", None, None),
    }
    with pytest.raises(FormatDetectionError, match="empty.csv, ragged.csv"):
        S.require_formats(audit)
    strict = S.format_audit(spark, str(folder / "tab.tsv"), ["ascii", "utf-8"], ["\t"])
    assert strict.first().encoding is None
    for encodings, delimiters in (([], [","]), (["utf-8"], []), (["utf-8"], ["||"]), (["utf-7"], [","])):
        with pytest.raises(FormatDetectionError):
            S.format_audit(spark, str(folder), encodings, delimiters)


def test_files_order_their_columns_their_own_way(spark, tmp_path):
    folder = tmp_path / "layouts"
    folder.mkdir()
    (folder / "a.csv").write_text("\n\ufeffA,B,C\n1,2,x\n", encoding="utf-8")
    (folder / "b.csv").write_text('"B","C",A\n4,"y\nz",3\n6,,5\n')
    (folder / "c.csv").write_text("B,A,C\n")
    header, rows = scan(spark, folder)
    assert header == ["A", "B", "C"]
    assert sorted((r.A, r.B, r.C, r.row_number) for r in rows.collect()) == [
        ("1", "2", "x", 1), ("3", "4", "y\nz", 1), ("5", "6", "", 2),
    ]
    (folder / "d.csv").write_text("A,D,B\n")
    with pytest.raises(FormatDetectionError, match="same columns"):
        scan(spark, folder)


def test_manifest_whole_and_streamed(spark, engagement, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    contents = {"a.csv": b"A,B\n1,2\n", "b.csv": b"A,B\n" + b"3,4\n" * 700_000}
    for name, content in contents.items():
        (folder / name).write_bytes(content)
    rows = source_manifest(spark, str(folder), engagement).collect()
    got = {r.filename: (r.sha256, r.byte_size, r.provider) for r in rows}
    want = {n: (hashlib.sha256(c).hexdigest(), len(c), "CLIENT_A") for n, c in contents.items()}
    assert got == want
    streamed = file_digests(spark, str(folder), whole_file_bytes=100).collect()
    assert {r.path.rsplit("/", 1)[1]: r.sha256 for r in streamed} == {n: w[0] for n, w in want.items()}


def test_registry_document(spark, tmp_path):
    path = tmp_path / "mappings.json"
    path.write_text(json.dumps({"registry_version": 1, "clients": {}}))
    assert RT.read_registry(spark, str(path)).collect() == []
    column = {"canonical_field": "entity", "source_tier": 3, "confidence": 0.9, "approved_by": "human", "rationale": "r"}
    document = {"clients": {"P": {"gl": {"approved_at": "2026", "columns": {"Co Code": column}}}}}
    path.write_text(json.dumps(document, indent=2))
    row = RT.read_registry(spark, str(path)).first()
    assert (row.provider, row.dataset, row.source_column, row.canonical_field, row.approved_at) == (
        "P", "gl", "Co Code", "entity", "2026",
    )
    path.write_text("[]")
    with pytest.raises(MappingError):
        RT.read_registry(spark, str(path))


def test_registry_versions_stand_beside_each_other(spark, tmp_path):
    empty = RT.empty_registry(spark)
    first = sinks.write_registry_version(empty, str(tmp_path), 1)
    again = spark.read.schema(empty.schema).parquet(first)
    second = sinks.write_registry_version(again, str(tmp_path), 2)
    assert first != second and spark.read.parquet(second).count() == 0


def test_row_index_holds_under_a_file_limit(spark):
    from pyspark.sql import functions as F

    from tallybook.workspace import stage_with_index

    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        rows = stage_with_index(spark.range(100), [F.col("id")], "numbered").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted((r.id, r.row_index) for r in rows) == [(n, n) for n in range(100)]


def test_staging_wants_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from tallybook.workspace import base_dir

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="checkpoint"):
        base_dir(bare)


def csv_rows(text, delimiter):
    """Rows as the csv module has them, without the header; its own line ends are kept inside quotes."""
    found = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=delimiter) if r]
    return found[0], found[1:]


def torn_text(rng, rows, width, end):
    """Cells with breaks, quotes, delimiters and blank lines, also where a quote is only a character."""
    cells = ["", "plain", "a b", '"two\nlines"', '"\r\n"', '"say ""hi"""', '"x, y"', 'inch 5"', '"\n\n\n"', "é", '""']
    lines = [",".join(f"H{i}" for i in range(width))]
    lines += [",".join([str(n), *(rng.choice(cells) for _ in range(width - 1))]) for n in range(rows)]
    return "".join(x + (end if rng.random() < 0.9 else end + end) for x in lines)


@pytest.mark.parametrize("block", [37, 517])
def test_quoted_line_breaks_over_block_ends(spark, tmp_path, block):
    rng = random.Random(block)
    folder = tmp_path / "torn"
    folder.mkdir()
    texts = {f"f{n}.csv": torn_text(rng, rows, 4, end) for n, (rows, end) in enumerate([(80, "\n"), (60, "\r\n"), (1, "\n"), (0, "\n")])}
    texts["long.csv"] = 'H0,H1,H2,H3\n0,"' + "line\n" * 200 + '",,\n1,,,\n'
    texts["plain.csv"] = "H0,H1,H2,H3\n" + "".join(f"{n},a,b,c\n" for n in range(100))
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    limits = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        lines = staged_lines(spark, str(folder), [",", "|"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert lines.rows.select("block_key").distinct().count() > 5
    audit = S.format_audit(spark, str(folder), ["utf-8"], [",", "|"], lines)
    found = numbered_records(lines, ",")
    headers = S.header_names(found, "utf-8")
    rows = S.rows_of(found, headers, ["H0", "H1", "H2", "H3"], "utf-8").collect()
    audited = {r.source_file: (r.delimiter, r.width, r.lines) for r in audit.collect()}
    for name, text in texts.items():
        header, want = csv_rows(text, ",")
        got = sorted((r.row_number, r.H0, r.H1, r.H2, r.H3) for r in rows if r.source_file == name)
        assert got == [(n + 1, *w) for n, w in enumerate(want)], name
        assert audited[name] == (",", 4, len(want) + 1)


def test_a_quote_that_is_never_closed(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('A,B\n1,"x\n' + "2,y\n" * 300_000)
    with pytest.raises(FormatDetectionError, match="open.csv: record 2 has an open quote"):
        scan(spark, path)
    path.write_text('A,B\n1,"x\n2,y\n')
    assert [(r.A, r.B) for r in scan(spark, path)[1].collect()] == [("1", "x\n2,y")]
