"""Delimited text as text: every cell arrives as a string or as missing.

Spark splits the files; records may hold quoted line breaks wherever the splits fall (see
``records``). A blank cell is '', a cell a short row does not have is NULL, and a long
row's surplus goes to ``__extra__``.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.errors import FormatDetectionError
from tallybook.sources.records import Lines, Numbered, first_records, numbered_records, record_widths, records, staged_lines
from tallybook.workspace import stage

# Encodings that can be told from the bytes, and their common names.
ENCODINGS = {
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
    "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "ascii": "US-ASCII",
    "cp1252": "windows-1252",
    "windows-1252": "windows-1252",
}

CORRUPT = "_corrupt"


def _windows_1252() -> tuple[str, str, str]:
    """The characters that differ from ISO-8859-1 there, what they stand for, and the bytes that stand for none."""
    high = [bytes([x]) for x in range(0x80, 0xA0)]
    meant = [(x.decode("latin-1"), x.decode("cp1252", "ignore")) for x in high]
    return "".join(a for a, b in meant if b), "".join(b for _, b in meant), "".join(a for a, b in meant if not b)


def decoded(text: Column, encoding: str) -> Column:
    """Bytes held in a string column, as text of an encoding the audit found to read them."""
    name = ENCODINGS[encoding.lower()]
    if name in ("UTF-8", "US-ASCII"):
        return text
    latin = F.decode(text.cast("binary"), "ISO-8859-1")
    if name == "ISO-8859-1":
        return latin
    here, there, _ = _windows_1252()
    return F.translate(latin, here, there)


def canonical_path(column: str) -> Column:
    """A file's path as the manifest spells it, whichever reader gave it."""
    return F.regexp_replace(F.col(column), "^file:/+", "file:///")


def _outside_quotes(delimiter: str) -> str:
    d = re.escape(delimiter)
    return rf'{d}(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _cells_of(record: Column, delimiter: str) -> Column:
    """A record the parser called malformed, cut at unquoted delimiters."""
    cells = F.split(record, _outside_quotes(delimiter))
    return F.transform(
        cells,
        lambda c: F.when(
            c.rlike('(?s)^".*"$'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )


def _parsed(record: Column, width: int, delimiter: str) -> Column:
    """A struct of ``width`` cells and, if the record has another number of them, the record itself."""
    schema = ", ".join(f"{n} string" for n in [*(f"_c{i}" for i in range(width)), CORRUPT])
    options = {
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        # Outside the alphabet of any ledger: no text stands for a missing cell.
        "nullValue": "\u0000",
        "emptyValue": "",
        "columnNameOfCorruptRecord": CORRUPT,
        "mode": "PERMISSIVE",
        "multiLine": "true",  # line breaks stay as they are
    }
    return F.from_csv(record, schema, options)


def _names(record: Column, delimiter: str) -> Column:
    return _cells_of(F.ltrim(record, F.lit("\ufeff")), delimiter)


def header_names(found: Numbered, encoding: str) -> DataFrame:
    """Staged: source_path and names, the cells of each file's first record."""
    first = first_records(found)
    return stage(first.select("source_path", _names(decoded(F.col("record"), encoding), found.delimiter).alias("names")), "headers")


def one_header(headers: DataFrame, path: str | list[str]) -> list[str]:
    """The header of the first file by path; all files must have its columns, in any order."""
    first = headers.orderBy("source_path").first()
    if first is None:
        raise FormatDetectionError(f"{path} is empty")
    names = list(first["names"])
    other = headers.where(F.array_sort("names") != F.array_sort(F.lit(names))).first()
    if other is not None:
        raise FormatDetectionError(f"the files under {path} do not have the same columns: {names}, {list(other['names'])}")
    return names


def header_of(spark: SparkSession, path: str, encoding: str, delimiter: str) -> list[str]:
    """The column names of the file, or of the first file of the folder."""
    found = numbered_records(staged_lines(spark, path, [delimiter]), delimiter)
    return one_header(header_names(found, encoding), path)


def rows_of(found: Numbered, headers: DataFrame, header: Sequence[str], encoding: str) -> DataFrame:
    """Rows after each file's header: ``header`` columns, ``__extra__``, source_path, source_file and row_number (from 1).

    A file may order the columns its own way. Where a name repeats, the last column of that name is the one kept.
    """
    width = len(header)
    ordered = headers.select("names").distinct().limit(2).collect()
    same = all(list(r["names"]) == list(header) for r in ordered)
    rows = records(found).where("record_number > 1").withColumn("record", decoded(F.col("record"), encoding))
    parsed = rows.withColumn("_csv", _parsed(F.col("record"), width, found.delimiter))
    ragged = F.col(f"_csv.{CORRUPT}").isNotNull()
    regular = F.array(*[F.coalesce(f"_csv._c{i}", F.lit("")) for i in range(width)])
    cells = parsed.withColumn("_cells", F.when(ragged, _cells_of(F.col("record"), found.delimiter)).otherwise(regular))
    distinct = list(dict.fromkeys(header))
    if same:
        last = {name: i for i, name in enumerate(header)}
        values = [F.get("_cells", F.lit(last[name])).alias(name) for name in distinct]
    else:
        # One place per column and file: as many rows as there are files.
        places = [
            (F.size("names") - F.array_position(F.reverse("names"), F.lit(name))).cast("int").alias(f"_p{i}")
            for i, name in enumerate(distinct)
        ]
        cells = cells.join(headers.select("source_path", *places), "source_path")
        values = [F.get("_cells", F.col(f"_p{i}")).alias(name) for i, name in enumerate(distinct)]
    surplus = F.slice("_cells", width + 1, F.greatest(F.size("_cells") - width, F.lit(1)))
    extra = F.when(F.size("_cells") > width, surplus).alias("__extra__")
    number = (F.col("record_number") - 1).cast("bigint").alias("row_number")
    return cells.select(*values, extra, "source_path", "source_file", number)


def all_text_scan(
    spark: SparkSession, path: str | list[str], header: Sequence[str], encoding: str, delimiter: str, lines: Lines | None = None
) -> DataFrame:
    """Rows of the file, folder or listed files under ``header``; see ``rows_of``.

    A quoted field may hold line breaks; files are split all the same. ``lines`` are the
    file's written lines, if they have been read before.
    """
    found = numbered_records(lines or staged_lines(spark, path, [delimiter]), delimiter)
    return rows_of(found, header_names(found, encoding), header, encoding)


def format_audit(
    spark: SparkSession, path: str, encodings: Sequence[str], delimiters: Sequence[str], lines: Lines | None = None
) -> DataFrame:
    """Per file: the first encoding that reads all of it and the widest constant delimiter.

    The width is that of records, so a quoted field may hold line breaks and delimiters.
    ``lines`` counts records under the delimiter found (else lines). A file that no
    candidate reads, and one of no bytes, has NULL there.
    """
    if not encodings:
        raise FormatDetectionError("no encodings are configured")
    if not delimiters or any(len(d) != 1 for d in delimiters):
        raise FormatDetectionError("delimiters must be given, each a single character")
    unknown = [e for e in encodings if e.lower() not in ENCODINGS]
    if unknown:
        raise FormatDetectionError(f"encodings that cannot be audited: {', '.join(unknown)}")

    lines = lines or staged_lines(spark, path, delimiters)
    # The reader passes bytes through, so each line still shows what it was. No line feed
    # byte falls inside a character of these encodings, so lines can be judged one by one.
    raw = F.col("line")
    utf8 = F.is_valid_utf8(raw)
    ascii_only = utf8 & (F.octet_length(raw) == F.length(raw))
    gaps = F.decode(raw.cast("binary"), "ISO-8859-1").rlike("[" + _windows_1252()[2] + "]")
    reads = {
        "UTF-8": F.count_if(~utf8) == 0,
        "ISO-8859-1": F.lit(True),
        "US-ASCII": F.count_if(~ascii_only) == 0,
        "windows-1252": F.count_if(gaps) == 0,
    }
    first = F.coalesce(*(F.when(reads[ENCODINGS[e.lower()]], F.lit(e)) for e in encodings))
    audit = lines.rows.groupBy("source_path", "source_file").agg(F.count_if(~F.col("blank")).alias("_lines"), first.alias("encoding"))
    audit = stage(audit, "encodings")
    for i, delimiter in enumerate(delimiters):
        widths = record_widths(lines, delimiter)
        found = F.struct(
            F.when(F.col("least") == F.col("most"), F.col("most")).alias("width"),
            F.lit(-i).alias("earlier"),
            F.lit(delimiter).alias("delimiter"),
            "records",
        )
        audit = audit.join(widths.select("source_path", found.alias(f"_d{i}")), "source_path", "left")
    candidates = F.array(*(f"_d{i}" for i in range(len(delimiters))))
    best = F.array_max(F.filter(candidates, lambda c: c["width"] >= 2))
    judged = audit.select(
        "source_path",
        "source_file",
        F.coalesce(best["records"], F.col("_lines")).alias("lines"),
        "encoding",
        best["delimiter"].alias("delimiter"),
        best["width"].cast("bigint").alias("width"),
    )
    return judged.unionByName(_empty_files(spark, path, judged))


def _empty_files(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Files of no bytes, which Spark's readers pass over; what comes to the driver is a folder's listing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    for status in system.globStatus(place) or []:
        listed = system.listStatusIterator(status.getPath())
        while listed.hasNext():
            file = listed.next()
            name = file.getPath().getName()
            if file.isFile() and not file.getLen() and not name.startswith(("_", ".")):
                rows.append((file.getPath().toString(), name))
    listed = spark.createDataFrame(rows, "source_path string, source_file string").withColumn("lines", F.lit(0))
    found = set(listed.columns)
    return listed.select(*((F.col(f.name) if f.name in found else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields))


def require_formats(audit: DataFrame) -> None:
    """Refuse files that no configured encoding or delimiter reads. At most 20 are named, all are counted."""
    bad = audit.where(F.col("encoding").isNull() | F.col("delimiter").isNull())
    named = bad.orderBy("source_file").limit(20).collect()
    if named:
        more = bad.count() - len(named)
        raise FormatDetectionError(
            "no configured format reads " + ", ".join(r.source_file for r in named) + (f" and {more} more" if more else "")
        )
