"""The resolver's tiers, its gate and its contests; the similarity against brute force."""

import random

import pytest
from ledgers import GL_B_HEADER, GL_HEADER, PROPOSALS, SYNONYMS
from pyspark.sql import functions as F

from tallybook.errors import ApprovalError, MappingError
from tallybook.functions.text import letter_masks, normalise_header, similarity
from tallybook.operators import approve as A
from tallybook.operators import mapping as M
from tallybook.schemas import HEADERS_SCHEMA, REGISTRY_SCHEMA
from tallybook.sources import reference_tables as RT


def headers(spark, names, provider="P", dataset="gl"):
    return spark.createDataFrame([(provider, dataset, n, i) for i, n in enumerate(names)], HEADERS_SCHEMA)


def registry(spark, *rows):
    return spark.createDataFrame([("P", "gl", *r) for r in rows], REGISTRY_SCHEMA)


def indel(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    total = len(a) + len(b)
    return 2 * row[-1] / total if total else 1.0


def _next(above, x, b):
    row = [0]
    for j, y in enumerate(b):
        row.append(max(above[j + 1], row[j], above[j] + (x == y)))
    return row


def test_similarity_against_the_table(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdé") for _ in range(n))
    pairs = [(word(rng.randint(0, 20)), word(rng.randint(0, 20))) for _ in range(120)]
    pairs += [(word(70), word(n)) for n in (61, 62, 63, 75)] + [("firm", "accountcode"), ("", ""), ("a", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    masks = F.when(F.length("b").between(1, 62), letter_masks(F.col("b")))
    got = df.select("a", "b", similarity(F.col("a"), F.col("b"), masks).alias("r")).collect()
    for r in got:
        assert r.r == pytest.approx(indel(r.a, r.b)), (r.a, r.b)


def resolve(spark, names, registered=None, proposals=PROPOSALS, gate=0.85, synonyms=SYNONYMS):
    return {
        r.position: r
        for r in M.resolve_columns(
            headers(spark, names),
            registered if registered is not None else RT.empty_registry(spark),
            RT.synonyms_table(spark, synonyms),
            None if proposals is None else RT.proposals_table(spark, proposals),
            gate,
        ).collect()
    }


def test_without_a_proposer_everything_is_accounted_for(spark):
    names = GL_HEADER.split(",")
    got = resolve(spark, names, proposals=None)
    assert [got[i].source_column for i in range(len(names))] == names
    assert not [r for r in got.values() if r.source_tier == 3]
    unresolved = got[0]
    assert unresolved.state == "review" and unresolved.source_tier is None and unresolved.confidence == 0.0
    terms = [(f, t.replace(" ", "")) for f, of in SYNONYMS["gl"].items() for t in of]
    field, term = max(terms, key=lambda x: indel("firm", x[1]))
    assert unresolved.rationale == (
        f"unresolved: nearest synonym '{term}' for {field} scored {indel('firm', term):.2f}, below the 0.85 gate; "
        "no model attached"
    )


def test_second_provider_figures(spark):
    got = resolve(spark, GL_B_HEADER.split(","))
    tiers = [r.source_tier for r in got.values()]
    assert (tiers.count(2), tiers.count(3)) == (9, 3)
    assert sum(r.state == "review" for r in got.values()) == 3


def test_registry_is_letter_exact(spark):
    known = registry(spark, ("Firm", "entity", 3, 0.88, "human", "2026-07-28", "as told"))
    got = resolve(spark, ["Firm", "firm"], known)
    assert got[0].source_tier == 1 and got[0].confidence == 1.0
    assert got[0].rationale == "registry entry for P gl, approved by human on 2026-07-28 at tier 3: as told"
    assert got[1].source_tier == 3 and got[1].state == "review"
    assert "'Firm' already resolves to entity" in got[1].rationale


def test_gate_boundary_and_first_mapping(spark):
    known = registry(spark, ("x", "currency", 2, 1.0, "deterministic", None, ""))
    at = [("gl", "zzzz", "entity", 0.85, "r"), ("gl", "yyyy", "period", 0.84, "r")]
    got = resolve(spark, ["zzzz", "yyyy"], known, at)
    assert (got[0].state, got[1].state) == ("resolved", "review")
    assert resolve(spark, ["zzzz"], None, at)[0].state == "review"


def test_fuzzy_settles_at_the_gate_and_first_term_wins(spark):
    terms = {"gl": {"debit": ["abcdefghij", "abcdefghik"]}}
    (got,) = resolve(spark, ["abcdefghi"], synonyms=terms, proposals=None).values()
    assert got.source_tier == 2 and got.rationale == (
        "fuzzy match to synonym 'abcdefghij' for debit scoring 0.95, at or above the 0.85 gate"
    )
    exactly = {"gl": {"debit": ["abcdefghijklmnopqXXX"]}}
    (got,) = resolve(spark, ["abcdefghijklmnopqrst"], synonyms=exactly, proposals=None).values()
    assert got.confidence == pytest.approx(0.85) and got.state == "resolved"


def test_first_column_holds_a_contested_field(spark):
    got = resolve(spark, ["Remark", "Wording", "Note"], proposals=None)
    assert [got[i].state for i in range(3)] == ["resolved", "review", "review"]
    assert got[2].rationale == (
        "exact synonym match; 'Remark' already resolves to description, so both need adjudication"
    )


def test_a_queued_proposal_claims_nothing(spark):
    known = registry(spark, ("q", "currency", 2, 1.0, "deterministic", None, ""))
    weak = [("gl", "weak", "entity", 0.5, "r"), ("gl", "strong", "entity", 0.9, "r")]
    got = resolve(spark, ["weak", "strong"], known, weak)
    assert (got[0].state, got[1].state) == ("review", "resolved")


def test_packed_terms_beyond_the_broadcast(spark, monkeypatch):
    names = GL_HEADER.split(",")
    want = {p: r.asDict() for p, r in resolve(spark, names).items()}
    monkeypatch.setattr(M, "BROADCAST_TERMS", 1)
    monkeypatch.setattr(M, "TERMS_PER_ROW", 3)
    monkeypatch.setattr(M, "SALTS", 4)
    assert {p: r.asDict() for p, r in resolve(spark, names).items()} == want


def test_checks(spark):
    fields = RT.canonical_fields(spark)
    with pytest.raises(MappingError, match="two fields"):
        M.check_synonyms(RT.synonyms_table(spark, {"gl": {"debit": ["a b"], "credit": ["A_B"]}}), fields)
    with pytest.raises(MappingError, match="does not have"):
        M.check_synonyms(RT.synonyms_table(spark, {"tb": {"debit": ["x"]}}), fields)
    ok = ("gl", "h", "entity", 0.9, "r")
    for bad, what in (
        ([("tb", "h", "debit", 0.9, "r")], "does not have"),
        ([ok, ok], "two proposals"),
        ([("gl", "h", "entity", 1.1, "r")], "outside 0 to 1"),
    ):
        with pytest.raises(MappingError, match=what):
            M.check_proposals(RT.proposals_table(spark, bad), fields)
    M.check_proposals(RT.proposals_table(spark, PROPOSALS), fields)
    unsent = M.unsent_proposals(RT.proposals_table(spark, [ok]), headers(spark, ["other"]))
    assert unsent.count() == 1


def test_missing_fields_and_accounting(spark):
    names = GL_HEADER.split(",")
    h = headers(spark, names)
    res = M.resolve_columns(
        h, RT.empty_registry(spark), RT.synonyms_table(spark, SYNONYMS), RT.proposals_table(spark, PROPOSALS), 0.85
    )
    missing = [r.field for r in M.missing_fields(res, RT.canonical_fields(spark)).orderBy("field_position").collect()]
    assert missing == ["entity", "period", "line_no", "currency", "source_system"]
    assert M.column_accounting(h, res).collect() == []
    assert M.column_accounting(h, res.where("position > 0")).first().problem == "lost"


def test_normalise(spark):
    got = spark.createDataFrame([("Co Code",), ("co_code",), ("CO--CODE",)], "h string")
    assert {r.n for r in got.select(normalise_header(F.col("h")).alias("n")).collect()} == {"cocode"}


def test_approval(spark):
    names = ["Firm", "Fin Year", "Remark", "Mystery"]
    known = registry(spark, ("Remark", "description", 2, 1.0, "human", "2020", "kept as found"))
    other = spark.createDataFrame([("Q", "gl", "x", "entity", 2, 1.0, "human", "2020", "r")], REGISTRY_SCHEMA)
    reg = known.unionByName(other)
    weak = [("gl", "firm", "entity", 0.6, "r"), ("gl", "finyear", "period", 0.95, "r")]
    queue = M.resolve_columns(
        headers(spark, names), reg, RT.synonyms_table(spark, SYNONYMS), RT.proposals_table(spark, weak), 0.85
    )
    updated, written = A.approve(queue, reg, "now", ["Firm"])
    got = {(r.provider, r.source_column): (r.approved_by, r.approved_at, r.rationale) for r in updated.collect()}
    assert got == {
        ("P", "Firm"): ("human", "now", "r"),
        ("P", "Fin Year"): ("model", "now", "r"),
        ("P", "Remark"): ("human", "2020", "kept as found"),
        ("Q", "x"): ("human", "2020", "r"),
    }
    assert written.first().asDict() == dict(
        provider="P", dataset="gl", columns=3, tier1=1, tier2=0, tier3=2, deterministic=0, human=2, model=1
    )
    with pytest.raises(ApprovalError, match="not awaiting"):
        A.approve(queue, reg, "now", ["Remark"])
    with pytest.raises(ApprovalError, match="nothing proposed"):
        A.approve(queue, reg, "now", ["Mystery"])
    with pytest.raises(ApprovalError, match="nothing was approved"):
        A.approve(queue.where("state = 'resolved'"), reg, "now")


def edited(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        place = rng.randrange(len(letters) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            letters.insert(place, rng.choice("abcdexyz "))
        elif letters and kind == 1:
            del letters[min(place, len(letters) - 1)]
        elif letters:
            letters[min(place, len(letters) - 1)] = rng.choice("abcdexyz ")
    return "".join(letters)


def test_index_of_segments_misses_no_nearest_term(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    terms = sorted({" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(150)} | {"aaaaaaaa", "aaaa", "ab" * 40})
    keys = sorted({edited(rng, rng.choice(terms), rng.randint(0, 6)) for _ in range(300)} | {"", "q", "aaaaaaa", "ab" * 41})
    synonyms = spark.createDataFrame([("d", f"f{n}", t, n) for n, t in enumerate(terms)], "dataset string, field string, term string, term_position long")
    headers = spark.createDataFrame([("d", k) for k in keys], "dataset string, header_key string")
    normal = {r.term: r.term_position for r in M.synonym_terms(synonyms).collect()}
    want = {}
    for k in keys:
        ratio, place, term = max((indel(k, t), -p, t) for t, p in normal.items())
        if ratio > 0:
            want[k] = (round(ratio, 12), term)
    got = {}
    for few in (0, 10**6):
        monkeypatch.setattr(M, "FEW_TERMS", few)
        rows = M.nearest_argmax(headers, synonyms).collect()
        got[few] = {r.header_key: (round(r.ratio, 12), r.term) for r in rows}
        assert len(rows) == len(got[few])
    assert got[0] == want and got[10**6] == want
    assert sum(r >= M.CLOSE for r, _ in want.values()) > 30


def test_few_of_all_pairs_are_compared(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", weights=range(22, 0, -1), k=rng.randint(3, 8)))
    words = [word() for _ in range(3000)]
    terms = sorted({" ".join(rng.choices(words, k=3)) for _ in range(50_000)})
    keys = sorted({edited(rng, rng.choice(terms), rng.randint(0, 2)) for _ in range(100_000)})
    term_rows = spark.createDataFrame([("d", n, t) for n, t in enumerate(terms)], "dataset string, term_position long, term string")
    key_rows = spark.createDataFrame([("d", k) for k in keys], "dataset string, header_key string")
    pairs = M.close_pairs(key_rows, term_rows)
    met = pairs.groupBy("header_key").count().agg({"count": "sum", "header_key": "count"}).first()
    assert met["sum(count)"] < 0.002 * len(terms) * len(keys)
    assert met["count(header_key)"] > 0.9 * len(keys)
