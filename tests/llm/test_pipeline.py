"""The pipeline's stages, each against plain answers on its own input."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallybook.llm import components, fertility, ngram_join, suffix_dedup  # noqa: E402
from tallybook.llm.shared import identified, stage, table  # noqa: E402
from tallybook.workspace import base_dir  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test data")


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, by_stage = docs.columns, [docs]
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, FOLDER), name)
        by_stage.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in by_stage[:-1]]
    ids = [{i for i, _ in r} for r in rows]
    kept = {r.doc_id for r in fertility.quality(by_stage[0]).collect() if r.kept}
    assert ids[1] == kept
    groups = {}
    for i, n, c in brute.near_duplicates(rows[1], 5, 80):
        groups.setdefault(c if n else ("none", i), []).append(i)
    assert ids[2] == {min(g) for g in groups.values()}
    assert ids[3] == ids[2]
    removed = {r[0]: r[2] for r in brute.suffixes(rows[2], corpus_pipeline.REPEATED_BYTES)}
    before, after = dict(rows[2]), dict(rows[3])
    for i, n in removed.items():
        assert 0 <= len(before[i].encode()) - len(after[i].encode()) <= n
        assert n == 0 or len(after[i]) < len(before[i])
    words = [brute.WORD.findall(t or "") for _, t in rows[3]]
    passages = Counter(tuple(w[p : p + 51]) for w in words for p in range(len(w) - 50))
    before_words = [brute.WORD.findall(t or "") for _, t in rows[2]]
    planted = Counter(tuple(w[p : p + 51]) for w in before_words for p in range(len(w) - 50))
    assert not any(n > 1 for n in passages.values()) and any(n > 1 for n in planted.values())
    untouched = {i for i, n in removed.items() if not n}
    assert len(untouched) > 0.5 * len(removed) and all(before[i] == after[i] for i in untouched)
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    found = {d for d, *_ in brute.contained(rows[3], items)}
    assert ids[4] == ids[3] - found
    packed = by_stage[5].collect()
    assert {r.doc_id for r in packed} == ids[4]
    assert corpus_pipeline.run(spark, FOLDER).count() == len(packed)


def test_tables_on_the_way_are_deleted_once_the_result_is_written(spark):
    words = [f"w{n}" for n in range(120)]
    texts = [" ".join(words), " ".join(words[:119]), " ".join(words[::-1]), " ".join(words[60:] + words[:60]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    there = lambda: {p.name for p in Path(base_dir(spark)).iterdir()}
    before = there()
    joined = ngram_join.linked(identified(docs), 5, 80)
    assert [x.partition("-")[0] for x in there() - before] == ["linked"]
    assert sorted(r.n for r in joined.collect()) == [0, 115, 116, 116, 116]
    before = there()
    cut = suffix_dedup.removal_digests(docs, 60)
    assert [x.partition("-")[0] for x in there() - before] == ["repeats"]
    assert sum(r.n_removed > 0 for r in cut.collect()) == 3
    before = there()
    roots = components.components(spark.createDataFrame([(1, 2), (2, 3)], "u long, v long"))
    assert [x.partition("-")[0] for x in there() - before] == ["roots"] and roots.count() == 3
