"""Near duplicates by an exact Jaccard self-join on word n-grams.

Documents with equal n-gram sets are one node. In one order of all n-grams, rare ones
first, two nodes similar enough share one of their first few n-grams (the prefix).
Prefix n-grams found in one node alone are dropped; the others join their nodes, and
length, positional and suffix filters thin out the pairs, each of which is verified once.

What is asked for is the groups that links connect, so a pair already connected needs no
look. Nodes under one n-gram are first compared with one of them (a star, twice), which
connects large groups of copies at a cost in proportion to their size. Then all pairs
under an n-gram that are not connected yet are compared, so no group is missed. An n-gram
of two nodes needs no more than its first star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.components import components
from tallybook.llm.shared import (
    DIGEST,
    KEY,
    RANK,
    TEXT,
    document_key,
    identified,
    leaves_one,
    passes,
    split_by_filter,
    stage,
    task_filter,
    without,
)
from tallybook.llm.vocabularies import in_use

#: The suffix filter parts n-grams by hash into at most so many parts, 64 to a column. A set has as
#: many columns as a power of two gives it a part for each n-gram; the others are zero and compress to nothing.
_PARTS = 2048
SKETCH = tuple(f"s{n}" for n in range(_PARTS // 64))

#: Frequencies are counted in so many slots, by hash; they order n-grams and decide nothing else.
_SLOT_BITS = 18


def _chunks(batch: pa.RecordBatch, size: int):
    """Per chunk of texts: first row, rows, and hash and row of every n-gram, A-Z in lower case."""
    data, bounds = H.text_bytes(batch.column(TEXT))
    for i, j in H.chunks(bounds):
        hashes, _, _, first = H.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], H.LOWER)
        yield i, j - i, *H.shingles(hashes, first, size)


def _sets(batch: pa.RecordBatch, size: int):
    """Per chunk: first row, distinct n-grams of each row, row offsets, and each row's node (a digest of its set)."""
    for i, rows, found, row in _chunks(batch, size):
        flat, bounds = H.distinct_sets(found, row, rows)
        sums = np.zeros((2, len(flat) + 1), np.uint64)
        np.cumsum(flat, out=sums[0, 1:])
        np.cumsum(H.mix(flat), out=sums[1, 1:])
        one, two = (x[bounds[1:]] - x[bounds[:-1]] for x in sums)
        node = H.mix(H.mix(one + np.diff(bounds).astype(np.uint64)) ^ two)
        yield i, flat, bounds, node


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _counted(size: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _SLOT_BITS, np.int64)
        for batch in batches:
            for _, _, found, _ in _chunks(batch, size):
                total += np.bincount(_slot(found), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": used, "n": total[used]})

    return emit


def frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """How often n-grams occur in all documents, summed per slot."""
    counts = docs.select(TEXT).mapInArrow(_counted(size), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # one row per slot
    out = np.zeros(1 << _SLOT_BITS, np.int64)
    out[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return out


def _sketches(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row, for each part, whether it holds an odd number of the row's n-grams; 64 parts to an integer."""
    rows = len(bounds) - 1
    place = np.repeat(np.arange(rows), np.diff(bounds)) * _PARTS + (flat & np.uint64(_PARTS - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=rows * _PARTS) & 1
    sketches = np.packbits(odd.astype(np.uint8).reshape(rows, _PARTS), axis=1).view(np.int64)
    n, half = np.diff(bounds), len(SKETCH) // 2
    while half:  # two parts that become one hold an odd number if one of them does
        few = n <= 64 * half
        sketches[few, :half] ^= sketches[few, half : 2 * half]
        sketches[few, half : 2 * half] = 0
        half //= 2
    return sketches


def _nodes(size: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            for i, flat, bounds, node in _sets(batch, size):
                kept = [batch.column(c).slice(i, len(node)) for c in ("doc_id", *KEY)]
                figures = [H.signed(node), np.diff(bounds), *np.ascontiguousarray(_sketches(flat, bounds).T)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *map(pa.array, figures)], names=["doc_id", *KEY, "node", "n", *SKETCH]
                )

    return emit


def _prefixes(size: int, percent: int, frequency):
    """Per chunk of a batch: first row, nodes, and of every prefix n-gram its row, hash and place."""

    def of(batch: pa.RecordBatch):
        often = np.minimum(frequency.value, (1 << 20) - 1).astype(np.uint64)
        for i, flat, bounds, node in _sets(batch, size):
            n = np.diff(bounds)
            row = np.repeat(np.arange(len(n)), n)
            # Sets are in order of hash, which breaks ties.
            order = np.lexsort(((often[_slot(flat)] << np.uint64(44)) | (flat >> np.uint64(20)), row))
            place = np.arange(len(flat)) - bounds[row]
            head = place < (n + (-percent * n) // 100 + 1)[row]  # n - ceil(percent * n / 100) + 1
            yield i, node, n, row[head], flat[order][head], place[head]

    return of


def _prefix_tokens(prefixes):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            for _, node, _, row, token, _ in prefixes(batch):
                yield pa.RecordBatch.from_pydict({"token": H.signed(token), "node": H.signed(node[row])})

    return emit


def _entries(prefixes, wanted):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            for _, node, n, row, token, place in prefixes(batch):
                hit = passes(wanted.value, token)
                row, token, place = row[hit], token[hit], place[hit]
                yield pa.RecordBatch.from_pydict(
                    {"token": H.signed(token), "node": H.signed(node[row]), "n": n[row], "place": place}
                )

    return emit


def prefix_entries(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Staged (token, node, n, place) of prefix n-grams that more than one node has."""
    frequency = docs.sparkSession.sparkContext.broadcast(frequencies(docs, size))
    prefixes = _prefixes(size, percent, frequency)
    tokens = docs.select(TEXT).mapInArrow(_prefix_tokens(prefixes), "token long, node long")
    shared = tokens.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("token")
    shared = stage(shared, "tokens")
    wanted = task_filter(shared, "token")
    schema = "token long, node long, n long, place long"
    rows = docs.select(TEXT).mapInArrow(_entries(prefixes, wanted), schema).distinct()  # copies are one node
    return stage(rows.join(shared, "token", "left_semi"), "entries")


def _may_link(percent: int, x: str, y: str) -> Column:
    """Length filter, and positional filter: no more can be shared than before, at and after this n-gram."""
    n, m, i, j = (F.col(f"{side}.{c}") for c in ("n", "place") for side in (x, y))
    most = F.least(i, j) + 1 + F.least(n - i, m - j) - 1
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))


def _may_differ(percent: int, x: str, y: str) -> Column:
    """Suffix filter: parts with an odd number in one set and an even one in the other are no more than n-grams may differ.

    Of two sketches with unequal numbers of columns the longer one is folded to the shorter's. Where it
    is over twice as long, the sets differ too much in length to link, for any ``percent`` above 50; else they pass.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = [F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}")) for s in SKETCH]
    apart, columns = sum(map(F.bit_count, differ), F.lit(0)), len(SKETCH) // 2
    less, more = F.least(n, m), F.greatest(n, m)
    while columns:
        folded = sum((F.bit_count(differ[k].bitwiseXOR(differ[k + columns])) for k in range(columns)), F.lit(0))
        fewer, twice = less <= 64 * columns, more > 64 * columns
        far = more > 128 * columns if 2 * columns < len(SKETCH) else F.lit(False)
        apart = F.when(fewer & twice, F.when(far, 0).otherwise(folded)).otherwise(apart)
        columns //= 2
    return (100 + percent) * apart <= (100 - percent) * (n + m)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def star_heads(entries: DataFrame, pick: Column) -> DataFrame:
    """Staged (token, y, nodes): each n-gram's picked node and how many nodes it has. ``entries`` has ``root``."""
    picked = F.min_by(F.struct("node", "n", "place", "root"), pick).alias("y")
    return stage(entries.groupBy("token").agg(picked, F.count(F.lit(1)).alias("nodes")), "heads")


def star_pairs(entries: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Pairs of each n-gram's picked node and its nodes of other groups. ``entries`` has ``root``."""
    rows = entries.select("token", F.struct("node", "n", "place", "root").alias("x")).join(stars.drop("nodes"), "token")
    rows = rows.filter((F.col("x.root") != F.col("y.root")) & _may_link(percent, "x", "y"))
    return _ordered(rows.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def remaining_pairs(entries: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """All pairs under one n-gram that are in different groups and pass the filters."""
    groups = entries.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    groups = stage(groups.filter("low < high").select("token"), "groups")
    side = ("node", "n", "place", "root", *SKETCH)
    mixed = stage(entries.join(groups, "token").join(sketches.drop("n"), "node").select("token", *side), "mixed")
    left = mixed.select("token", F.struct(*side).alias("x"))
    right = mixed.select("token", F.struct(*side).alias("y"))
    rows = left.join(
        right,
        (left["token"] == right["token"])
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.root") != F.col("y.root"))
        & _may_link(percent, "x", "y")
        & _may_differ(percent, "x", "y"),
    )
    return _ordered(rows.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _verified(size: int, percent: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                one = pa.RecordBatch.from_arrays([batch.column(name)], names=[TEXT])
                sides.append([x for _, flat, bounds, _ in _sets(one, size) for x in np.split(flat, bounds[1:-1])])
            linked = np.zeros(batch.num_rows, bool)
            for n, (x, y) in enumerate(zip(*sides, strict=True)):
                least = -(-percent * (len(x) + len(y)) // (100 + percent))  # of shared n-grams
                linked[n] = len(np.intersect1d(x, y, assume_unique=True)) >= least
            at = pa.array(np.flatnonzero(linked))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("a", "b")], names=["u", "v"])

    return emit


def filtered(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the suffix filter."""
    side = F.struct("n", *SKETCH)
    rows = pairs.join(sketches.select(F.col("node").alias("a"), side.alias("x")), "a")
    rows = rows.join(sketches.select(F.col("node").alias("b"), side.alias("y")), "b")
    return rows.filter(_may_differ(percent, "x", "y")).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, heads: DataFrame, size: int, percent: int) -> DataFrame:
    """Staged links (u, v): pairs whose Jaccard similarity reaches the threshold.

    Only texts of nodes in ``pairs`` move: a filter of their documents' keys thins out ``docs`` where it lies.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(nodes.join(heads, "node"), "wanted")
    near, _ = split_by_filter(docs.select(*KEY, TEXT), document_key(), wanted, document_key())
    # A document that comes twice is read once; by the join's columns, so that no text moves for it.
    texts = stage(near.join(wanted, list(KEY)).dropDuplicates([*KEY, "node"]).select("node", TEXT), "texts")
    rows = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col(TEXT).alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col(TEXT).alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    return stage(rows.mapInArrow(_verified(size, percent), "u long, v long"), "links")


def _node_heads(nodes: DataFrame, live: DataFrame) -> DataFrame:
    """Staged (node, key): one document of every node with entries, which stands for it."""
    heads = nodes.join(live, "node", "left_semi").groupBy("node").agg(F.min(F.struct(*KEY)).alias("head"))
    return stage(heads.select("node", *(F.col(f"head.{c}").alias(c) for c in KEY)), "heads")


@leaves_one
def linked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Staged rows of every document: doc_id, key, n (distinct n-grams) and component (its least doc_id).

    ``docs`` has passed ``identified``. Words are separated by space and the characters
    from tab to carriage return, A-Z count as a-z; a text with fewer than ``size`` words
    has all of them as its one n-gram. Documents link if 100 * shared >= ``percent`` *
    all n-grams of both. A null text and one without words link with nothing. A null
    doc_id counts as the greatest. Rows with the same doc_id and different texts are
    different documents. An empty table gives an empty one.

    N-grams and sets are told apart by 64-bit hashes.
    """
    schema = f"doc_id long, {RANK} long, {DIGEST} long, node long, n long, " + ", ".join(f"{s} long" for s in SKETCH)
    figures = stage(docs.select("doc_id", *KEY, TEXT).mapInArrow(_nodes(size), schema), "nodes")
    nodes = figures.drop(*SKETCH)
    filled = nodes.filter("n > 0")
    entries = prefix_entries(docs, size, percent)
    live = stage(entries.select("node").distinct(), "live")
    heads = _node_heads(filled, live)
    sketches = stage(figures.select("node", "n", *SKETCH).join(live, "node", "left_semi").dropDuplicates(["node"]), "sketches")
    rooted, links, roots, first = entries.withColumn("root", F.col("node")), None, None, True
    # First a node with the fewest rare n-grams before the shared one, so one in the middle of its copies; then any.
    for pick in (F.struct("place", "node"), F.struct(F.xxhash64("node"), "node"), None):
        if pick is None:
            pairs = remaining_pairs(rooted, sketches, percent)
        else:
            stars = star_heads(rooted, pick)
            pairs = filtered(star_pairs(rooted, stars, percent), sketches, percent)
        pairs = stage(pairs, "pairs")
        if first:  # A star of two nodes is all their pairs, so n-grams that no more nodes have are done with.
            first, token = False, F.col("token")
            entries, _ = split_by_filter(entries, token, stars.filter("nodes > 2"), token)
            rooted = entries.withColumn("root", F.col("node"))
        if pairs.isEmpty():
            continue
        found = verified(pairs, docs, heads, size, percent)
        # A component found before stands in the next graph as the links of its nodes to its root.
        links = found if links is None else found.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
        roots = components(links)
        rooted = stage(entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    if roots is None:
        roots = nodes.select("node", F.col("node").alias("root")).limit(0)
    group = F.when(F.col("n") > 0, F.coalesce("root", "node"))
    placed = nodes.join(roots, "node", "left").withColumn("group", group).drop("root", "node")
    placed = stage(placed, "placed")
    least = stage(placed.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct(*KEY)).alias("head")), "least")
    return stage(placed.join(least, "group", "left").drop("group"), "linked")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id; see ``linked``."""
    slim = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT))
    rows = linked(slim, size, percent)
    component = F.coalesce(F.col(f"head.{RANK}"), F.col(RANK))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without all but one document of each group of near duplicates: the one with the least doc_id stays.

    Documents without words are in no group and stay.
    """
    slim = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT))
    rows = linked(slim, size, percent).filter("n > 0")
    key = F.struct(*KEY)
    rejected = stage(rows.filter(key != F.col("head")).select(*KEY).distinct(), "rejected")
    # The same row twice: one of them stays.
    twice = stage(rows.filter(key == F.col("head")).groupBy(*KEY).count().filter("count > 1").select(*KEY), "twice")
    left = without(docs, rejected)
    keyed = identified(left.withColumn("_llm_text", F.col(TEXT)))
    near, far = split_by_filter(keyed, document_key(), twice, document_key())
    again = near.join(twice, list(KEY), "left_semi").dropDuplicates(list(KEY))
    rest = near.join(twice, list(KEY), "left_anti").unionByName(far)
    return rest.unionByName(again).withColumn(TEXT, F.col("_llm_text")).select(*docs.columns)
