"""Centroid clustering of integer vectors; each round searches a vantage-point tree of the centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallybook.llm.shared import stage

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Components of integer vectors stay below this, so that a squared distance of up to 1024 of them is a long.
COMPONENT_LIMIT = 1 << 25
#: A leaf of the tree holds at most this many centroids.
LEAF = 4
#: Bounds kept at a time while a batch is searched: vectors times tree nodes.
BOUNDS = 1 << 20
#: Distances to vantage points are rounded to 53 bits; a node is passed over only beyond this relative error.
SLACK = 1e-12

VECTOR, POINT = "_llm_vector", "_llm_point"


@dataclass(frozen=True)
class Node:
    """Centroids ``members`` at a leaf; else ball(s) around the vantage point of the node.

    ``inner`` and ``outer`` are the children's numbers; ``reach`` is the largest distance of
    an inner centroid from the vantage point, ``gap`` the smallest of an outer one.
    """

    members: np.ndarray
    inner: int = -1
    outer: int = -1
    reach: float = 0.0
    gap: float = 0.0


def squared(points: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``points`` from one centroid."""
    apart = points - centroid
    return np.einsum("ij,ij->i", apart, apart)


def vantage_tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes of a vantage-point tree, the root first. An inner node's vantage point is its only member."""
    nodes: list[Node | None] = [None]
    open_nodes = [(0, np.arange(len(centroids)))]
    while open_nodes:
        place, members = open_nodes.pop()
        if len(members) <= leaf:
            nodes[place] = Node(members)
            continue
        # The member farthest from the first one lies at the rim, so its distances spread widely.
        vantage = members[np.argmax(squared(centroids[members], centroids[members[0]]))]
        rest = members[members != vantage]
        far = squared(centroids[rest], centroids[vantage])
        order = np.argsort(far, kind="stable")
        half = len(rest) // 2
        inner, outer = len(nodes), len(nodes) + 1
        nodes += [None, None]
        reach, gap = (float(np.sqrt(far[order[n]])) for n in (half - 1, half))
        nodes[place] = Node(np.array([vantage]), inner, outer, reach, gap)
        open_nodes += [(inner, rest[order[:half]]), (outer, rest[order[half:]])]
    return nodes


def nearest(points: np.ndarray, centroids: np.ndarray, tree: list[Node]) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of each point's nearest centroid, and how many distances that took.

    Best first: every point goes to its open node with the least lower bound, until that
    bound exceeds its best distance. A node at exactly the best distance is still opened,
    as a centroid of a smaller number may tie there.
    """
    cluster = np.zeros(len(points), np.int64)
    distance = np.full(len(points), np.iinfo(np.int64).max, np.int64)
    taken = 0
    step = max(1, BOUNDS // len(tree))
    for low in range(0, len(points), step):
        some = points[low : low + step]
        number, best = cluster[low : low + step], distance[low : low + step]
        bounds = np.full((len(some), len(tree)), np.inf)
        bounds[:, 0] = 0.0
        active = np.arange(len(some))
        while len(active):
            chosen = np.argmin(bounds[active], axis=1)
            bound = bounds[active, chosen]
            # A bound of infinity means that no open node is left.
            go = np.isfinite(bound) & (bound <= np.sqrt(best[active].astype(np.float64)) * (1 + SLACK))
            active, chosen, bound = active[go], chosen[go], bound[go]
            for place in np.unique(chosen):
                node = tree[place]
                here = chosen == place
                rows = active[here]
                bounds[rows, place] = np.inf
                for member in node.members:
                    found = squared(some[rows], centroids[member])
                    taken += len(rows)
                    better = (found < best[rows]) | ((found == best[rows]) & (member < number[rows]))
                    best[rows[better]], number[rows[better]] = found[better], member
                if node.inner >= 0:
                    away = np.sqrt(found.astype(np.float64))
                    for child, apart in ((node.inner, away - node.reach), (node.outer, node.gap - away)):
                        safe = apart - (away + node.reach + node.gap) * SLACK
                        bounds[rows, child] = np.maximum(bound[here], safe)
    return cluster, distance, taken


def _points(column: pa.Array, dimensions: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), dimensions)


def integer_vectors(rows: DataFrame, vector: str, dimensions: int, scale: int) -> DataFrame:
    """Rows whose vector has ``dimensions`` components, none null or non-finite, and ``_llm_point``,
    their floor(scale * component). Components beyond COMPONENT_LIMIT raise an error."""
    exact = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(exact, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    kept = rows.filter(F.col(vector).isNotNull() & (F.size(vector) == dimensions) & finite)

    def whole(x: Column) -> Column:
        y = x * F.lit(float(scale))
        small = F.abs(y) < COMPONENT_LIMIT
        return F.when(small, F.floor(y).cast("int")).otherwise(F.raise_error(F.lit("a component is too large")).cast("int"))

    return kept.withColumn(POINT, F.transform(exact, whole))


def first_centroids(points: DataFrame, key: Column, clusters: int) -> np.ndarray:
    """The vectors of the ``clusters`` smallest keys; equal keys in order of their components."""
    rows = points.select(key.alias("key"), POINT).orderBy("key", POINT).limit(clusters).collect()
    return np.array([r[POINT] for r in rows], np.int64)


def _sums(dimensions: int, shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = shared.value
        total = np.zeros((len(centroids), dimensions + 1), np.int64)
        for batch in batches:
            points = _points(batch.column(POINT), dimensions)
            cluster, _, _ = nearest(points, centroids, tree)
            for number in np.unique(cluster):
                mine = points[cluster == number]
                total[number, :dimensions] += mine.sum(axis=0)
                total[number, dimensions] += len(mine)
        used = np.flatnonzero(total[:, dimensions])
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": np.repeat(used, dimensions + 1),
                "place": np.tile(np.arange(dimensions + 1), len(used)),
                "total": total[used].reshape(-1),
            }
        )

    return emit


def next_centroids(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor(sum / count) of each centroid's vectors; a centroid without vectors stays.

    A task sends one row per centroid and component, so the shuffle and the driver see
    tasks x centroids x components numbers, whatever the number of vectors.
    """
    dimensions = centroids.shape[1]
    shared = points.sparkSession.sparkContext.broadcast((centroids, vantage_tree(centroids)))
    partial = points.select(POINT).mapInArrow(_sums(dimensions, shared), "cluster long, place long, total long")
    # Decimals: the sum over all tasks may exceed a long.
    rows = partial.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total")).collect()
    found = {(r.cluster, r.place): int(r.total) for r in rows}
    moved = centroids.copy()
    for number in range(len(centroids)):
        if (number, dimensions) in found:
            count = found[number, dimensions]
            moved[number] = [found[number, place] // count for place in range(dimensions)]
    return moved


def _assigned(dimensions: int, shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = shared.value
        for batch in batches:
            cluster, distance, _ = nearest(_points(batch.column(POINT), dimensions), centroids, tree)
            plain = batch.drop_columns([POINT])
            yield pa.RecordBatch.from_arrays(
                [*plain.columns, pa.array(cluster), pa.array(distance)], names=[*plain.schema.names, "cluster", "distance"]
            )

    return emit


def clustered(
    rows: DataFrame,
    vector: str = "embedding",
    row_id: str = "vec_id",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Rows with ``row_id``, ``cluster`` and ``distance``, and the final centroids.

    Vectors with another number of components, or with a null or non-finite one, are left
    out; components become floor(``scale`` * x) of x as a double, and must then be smaller
    than COMPONENT_LIMIT, else the job ends with an error. Centroids start as the vectors
    with the smallest SHA-256 of ``3:<row_id>`` (a null id as no digits), equal ones in
    order of their components; with fewer vectors than ``clusters`` there are as many
    centroids as vectors. Repeated rows count as often as they occur; ties go to the
    smaller centroid number; an empty centroid stays where it is. An empty table gives an
    empty one.

    Integer vectors are written once and read once per round. A round broadcasts a
    vantage-point tree over the centroids (``clusters`` x ``dimensions`` numbers, nothing
    that grows with the rows) and each vector is assigned by a best-first search of it.
    """
    kept = integer_vectors(rows.select(F.col(row_id).cast("long").alias("vec_id"), F.col(vector).alias(VECTOR)), VECTOR, dimensions, scale)
    points = stage(kept.select("vec_id", POINT), "points")
    spark = rows.sparkSession
    schema = StructType([*points.drop(POINT).schema, StructField("cluster", LongType()), StructField("distance", LongType())])
    key = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = first_centroids(points, key, clusters)
    if not len(centroids):
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", row_id), centroids.reshape(0, dimensions)
    for _ in range(rounds):
        centroids = next_centroids(points, centroids)
    shared = spark.sparkContext.broadcast((centroids, vantage_tree(centroids)))
    found = points.mapInArrow(_assigned(dimensions, shared), schema)
    return found.withColumnRenamed("vec_id", row_id), centroids


def cluster_digests(rows: DataFrame, **options) -> DataFrame:
    """Per vector: vec_id, cluster, distance, the distances summed over its cluster and over all
    vectors, and the SHA-256 of its final centroid's components."""
    found, centroids = clustered(rows, **options)
    spark = rows.sparkSession
    found = stage(found, "clusters")
    digests = [
        (number, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for number, centroid in enumerate(centroids.tolist())
    ]
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    figures = found.groupBy("cluster").agg(total.alias("part")).collect()  # one row per centroid
    parts = {r.cluster: int(r.part) for r in figures}
    table = [(number, parts.get(number, 0), sum(parts.values()), digest) for number, digest in digests]
    known = spark.createDataFrame(table, "cluster long, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid: as small as the tree that every round broadcasts.
    joined = found.join(F.broadcast(known), "cluster")
    return joined.select(
        "vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
