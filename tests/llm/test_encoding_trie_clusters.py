"""Byte-level BPE, the prefix trie and centroid clustering against plain answers."""

import base64
import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from tallybook.llm import byte_bpe, centroids, prefix_trie  # noqa: E402
from tallybook.llm import hashing as H  # noqa: E402

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

ALPHABET = [*"abstdm12!'?é², ", "'s", "'re", "'ve", "'l", "'ll", "'S", "  ", "\n", "\t", "\r\n", "...", " ", "　", "ß", "日本", "🙂", "٣", "Ⅷ"]
ALPHABET += ["<|endoftext|>", "́", "\x00", "don't ", " 'tis"]


def library(name=byte_bpe.VOCABULARY):
    with open(tokenizers.path(name), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hostile_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 50))) for _ in range(4000)]
    texts += ["", " ", "'", "'r", "'re", "x'", "a" * 5000, "ab" * 3000, "'" * 300, " " * 1000, "x" + "\n" * 500 + "y"]
    texts += ["".join(rng.choices("abcdefgh", k=3000)), " word" * 70000]
    return texts


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_are_the_library_s(name):
    texts, known, merger = hostile_texts(), library(name), byte_bpe.ranks(name)
    data, bounds = H.text_bytes(pa.array(texts, pa.string()))
    ids, firsts = merger.encode(data, bounds)
    for n, text in enumerate(texts):
        assert ids[firsts[n] : firsts[n + 1]].tolist() == known.encode_ordinary(text), text[:80]


def test_every_code_point_beside_others():
    known, merger = library(), byte_bpe.ranks(byte_bpe.VOCABULARY)
    points = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    texts = ["a ".join(points[n : n + 4000]) + "'s" for n in range(0, len(points), 4000)]
    data, bounds = H.text_bytes(pa.array(texts, pa.string()))
    ids, firsts = merger.encode(data, bounds)
    assert all(ids[firsts[n] : firsts[n + 1]].tolist() == known.encode_ordinary(t) for n, t in enumerate(texts))


def test_merging_in_step_and_by_heap_agree():
    rng = random.Random(2)
    merger = byte_bpe.ranks(byte_bpe.VOCABULARY)
    pieces = sorted({bytes(rng.choices(b"aabcdehinorst", k=rng.randint(1, 60))) for _ in range(3000)} | {b"a" * n for n in range(1, 60)})
    ids, counts = merger.merge_in_step(pieces)
    ends = np.cumsum(counts)
    for n, piece in enumerate(pieces):
        assert ids[ends[n] - counts[n] : ends[n]].tolist() == merger.merge_with_heap(piece)


def test_cache_may_start_anew(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)
    merger, known = byte_bpe.Ranks(tokenizers.path(byte_bpe.VOCABULARY)), library()
    for text in ("one two three four " * 5, " ".join(map(str, range(200))), "one two three"):
        data = np.frombuffer(text.encode(), np.uint8)
        assert merger.encode(data, np.array([0, len(data)]))[0].tolist() == known.encode_ordinary(text)


def test_equal_hashes_do_not_pass_for_equal_slices(monkeypatch):
    monkeypatch.setattr(H.Hasher, "ranges", lambda self, start, end: np.zeros(len(start), np.uint64))
    data = np.frombuffer(b"abcabcabd", np.uint8)
    numbers, heads = H.distinct_slices(data, np.array([0, 3, 6]), np.array([3, 6, 9]))
    assert numbers.tolist() == [0, 0, 1] and heads.tolist() == [0, 2]


def test_scan_is_a_running_composition():
    rng = np.random.default_rng(1)
    numbers, table, _ = byte_bpe._automaton()
    for size in (1, 64, 65, 1000, 70001):
        functions = numbers[rng.integers(0, len(numbers), size)]
        got, state = byte_bpe.scan(functions, table), functions[0]
        for n in range(1, size):
            state = table[state, functions[n]]
            assert got[n] == state


def test_round_trip_of_a_table(spark):
    texts = [*hostile_texts()[-20:], None, None, "same", "same", "é" * 400_000 + " x" * 500_000, "word, é \n" * 500_000]
    rows = [(None if n == 5 else n // 2, t, "clash", [n]) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, offsets array<int>").repartition(3)
    got = Counter(map(tuple, byte_bpe.round_trip(docs).collect()))
    known = library()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter()
    for i, t, *_ in rows:
        ids = known.encode_ordinary(t or "")
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(t or "")] += 1
    assert got == want
    row = next(r for r in byte_bpe.encoded(docs).collect() if len(r.ids) > 10)
    merger = byte_bpe.ranks(byte_bpe.VOCABULARY)
    part = byte_bpe.decoded_bytes(merger, np.array(row.ids[3:8]), np.array(row.offsets[3:8]))
    assert part.tobytes() == known.decode_bytes(row.ids[3:8])
    assert byte_bpe.round_trip(docs.limit(0)).count() == 0


def turns():
    rng = random.Random(4)
    rows = []
    for c in [*range(-12, 40), 10**12, 10**12 + 3, -(1 << 63), (1 << 63) - 1]:
        if c % 7 == 2:
            continue  # some bases are absent
        for t in range(rng.randint(1, 12)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["hi", "é so", "", None, f"own {c}"])))
    rows += [(c, t, "user", "always") for c in range(100, 160) for t in range(14)]  # one hot conversation
    rows += [(200, t, "user", f"long {t % 7}") for t in range(300)] + [(201, 0, "user", "x" * 1_200_000)]
    rows += [rows[0], rows[0], (None, 1, "user", "of nobody"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("height, block", [(8, 1024), (2, 7), (3, 16), (1000, 50)])
def test_trie(spark, height, block):
    rows = turns()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int")
    got = [tuple(r) for r in prefix_trie.trie(*prefix_trie.rebuilt(table.repartition(4)), height, block).collect()]
    assert Counter(got) == Counter(brute.trie(rows))


def test_trie_of_nothing(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.rebuilt_trie(table).count() == 0


def test_ends_of_a_hot_node_stream_in_order(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        ends = spark.range(-2000, 3000).selectExpr("if(id % 10 < 8, 7L, id) as node", "2L as depth", "id as member")
        got = {r.conv_id: r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[7] == brute.sha(",".join(str(x) for x in range(-2000, 3000) if x < 0 or x % 10 < 8))
    assert got[9] == brute.sha("9")


@pytest.mark.parametrize("leaf", [1, 4])
def test_search_equals_all_distances(leaf):
    rng = np.random.default_rng(3)
    centers = rng.integers(-4000, 4000, (300, 6))
    centers[50:60] = centers[0]  # equal centroids: the smallest number wins
    points = np.concatenate([centers[rng.integers(0, 300, 2000)] + rng.integers(-300, 300, (2000, 6)), centers, centers[:1] * 9])
    points[:50] = (centers[:50] + centers[100:150]) // 2
    tree = centroids.vantage_tree(centers, leaf)
    assert sorted(m for node in tree for m in node.members.tolist()) == list(range(300))
    cluster, distance, taken = centroids.nearest(points, centers, tree)
    all_of_them = ((points[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (cluster == all_of_them.argmin(axis=1)).all() and (distance == all_of_them.min(axis=1)).all()
    assert taken < 0.6 * all_of_them.size


def test_ties_on_a_grid():
    rng = np.random.default_rng(8)
    centers = np.stack(np.meshgrid([0, 2, 4, 6], [0, 2, 4, 6], [0, 2]), -1).reshape(-1, 3)
    centers = centers[rng.permutation(len(centers))]
    points = rng.integers(-1, 8, (4000, 3))  # many lie exactly between several centroids
    cluster, _, _ = centroids.nearest(points, centers, centroids.vantage_tree(centers, 2))
    assert (cluster == ((points[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def vectors(size):
    rng = random.Random(6)
    rows = [(n, [rng.choice([-1, 0, 1]) * 2.0 + rng.gauss(0, 0.3) for _ in range(size)]) for n in range(200)]
    good = rows[3][1]
    rows += [(300, None), (301, []), (302, good[:-1]), (303, [*good, 1.0]), (304, [None, *good[1:]])]
    rows += [(305, [float("nan"), *good[1:]]), (306, [float("inf"), *good[1:]]), (None, good), (None, rows[5][1])]
    return rows + [rows[9]] * 100 + [(9, rows[4][1])]  # a vector with a third of all rows


def test_clusters(spark):
    rows = vectors(16)
    schema = "vec_id long, embedding array<double>, cluster string, _llm_point int"
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(5)
    got = Counter(map(tuple, centroids.cluster_digests(table, dimensions=16).collect()))
    assert got == Counter(brute.clusters(rows, size=16))


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster_digests(spark.createDataFrame([(1, None)], schema)).count() == 0
    few = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, [4.0, 4.0])]
    got = Counter(map(tuple, centroids.cluster_digests(spark.createDataFrame(few, schema), dimensions=2).collect()))
    assert got == Counter(brute.clusters(few, size=2))


def test_components_too_large_for_exact_distances(spark):
    table = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(PySparkException, match="too large"):
        centroids.cluster_digests(table, dimensions=2).collect()
