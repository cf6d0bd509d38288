"""Duplicate detection: rows are flagged and kept, never removed.

One pass finds the five-column keys held by two or more lines. An exact duplicate
group shares its five-column key, so both tests need only the lines under those
keys. They are fetched once and written; everything else works on them. That pass
counts 64-bit hashes of the keys, an eighth of their size; keys that share a hash by
chance are told apart by the full digests, by which lines are grouped.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.config import UNIDENTIFIED_RUN
from tallybook.functions.text import money_text, sentence
from tallybook.operators.controls import as_findings
from tallybook.schemas import EXACT_KEY, SUSPECTED_KEY
from tallybook.workspace import stage

# Fixed value: the separator between key fields before hashing.
UNIT_SEPARATOR = "\u001f"

# A key with more lines than this, and more than its share below, is hot: it is joined
# by broadcast, so that its lines stay spread over the tasks that scanned them.
HOT_ROWS = 1_000_000
# A hot key also has more than one in this many of all keyed lines, so there are always
# fewer hot keys than this, and a key that is not hot is a small part of a join.
HOT_KEYS = 100_000
# Width of a row_index range numbered by one window task.
INDEX_RANGE = 1_000_000
# Candidates compress to a few bytes each, so a task of 128 MB would read some 20 million and hold the
# group of each (150 bytes). In files of this many it reads 32 times as many at most.
CANDIDATES_PER_FILE = 100_000


def _digest(columns: tuple[str, ...]) -> Column:
    def text(name: str) -> Column:
        return money_text(F.col(name)) if name in ("debit", "credit") else F.col(name).cast("string")

    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *(text(c) for c in columns)), 256)


def exact_key() -> Column:
    """SHA-256 over the eight identifying fields."""
    return _digest(EXACT_KEY)


def suspected_key() -> Column:
    """SHA-256 over entity, account, date and amounts."""
    return _digest(SUSPECTED_KEY)


def key_hash() -> Column:
    """A 64-bit hash of the five-column key; NULL where a field of it is missing."""
    whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in SUSPECTED_KEY))
    return F.when(whole, F.xxhash64(*SUSPECTED_KEY))


def repeated_keys(detail: DataFrame) -> DataFrame:
    """Hashes of five-column keys that two or more lines have, with how many have them.

    A key with a missing field equals no other.
    """
    return (
        detail.groupBy(key_hash().alias("key_hash"))
        .agg(F.count(F.lit(1)).alias("key_rows"))
        .where(F.col("key_hash").isNotNull() & (F.col("key_rows") >= 2))
    )


def join_hot(
    lines: DataFrame, keys: DataFrame, on: list[str], weight: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``lines`` joined with ``keys`` (a written table, one row a key, ``weight`` its lines).

    Hot keys are split off and broadcast: fewer than ``HOT_KEYS`` by construction,
    whatever the size of the table. The others meet their lines in an ordinary join.
    """
    total = keys.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("lines")).first().lines
    bound = max(hot_rows, total // HOT_KEYS)
    hot, cold = keys.where(F.col(weight) > bound), keys.where(F.col(weight) <= bound)
    joined = lines.join(cold, on)
    return joined.unionByName(lines.join(F.broadcast(hot), on)) if not hot.isEmpty() else joined


def duplicate_candidates(detail: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every line that can belong to a duplicate group, with both its digests.

    The lines are written, their digests are not: they do not compress, so they would be most
    of what is written. Each reader derives the one that it needs.
    """
    needed = detail.select(*EXACT_KEY, "row_index")
    keys = stage(repeated_keys(needed), "repeated-keys")
    hashed = needed.withColumn("key_hash", key_hash())
    lines = join_hot(hashed, keys, ["key_hash"], "key_rows", hot_rows).select(*needed.columns)
    lines = stage(lines, "duplicate-candidates", CANDIDATES_PER_FILE)
    return lines.select("*", exact_key().alias("exact_key"), suspected_key().alias("suspected_key"))


def _as_text(digest: str) -> Column:
    """A digest's 64 letters; groups are made by its 32 bytes, which take half the room."""
    return F.lower(F.hex(digest)).alias(digest)


def exact_groups(candidates: DataFrame) -> DataFrame:
    """Groups of two or more identical lines: digest, how many, first and last; ``with_rows`` adds them all."""
    return (
        candidates.groupBy(F.unhex("exact_key").alias("digest"))
        .agg(
            F.count(F.lit(1)).alias("group_rows"),
            F.min("row_index").alias("first_row"),
            F.max("row_index").alias("last_row"),
        )
        .where(F.col("group_rows") >= 2)
        .select(
            _as_text("digest"), F.lit("EXACT").alias("kind"), "group_rows", F.lit(1).cast("bigint").alias("journals"),
            "first_row", "last_row",
        )
    )


def suspected_groups(candidates: DataFrame) -> DataFrame:
    """Groups of equal account, date and amount spanning two or more journals."""
    # Two levels, both with map-side combine: lines per journal, then journals per key.
    return (
        candidates.groupBy(F.unhex("suspected_key").alias("digest"), "journal_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("row_index").alias("first_row"),
            F.max("row_index").alias("last_row"),
        )
        .groupBy("digest")
        .agg(
            F.sum("lines").alias("group_rows"),
            F.count(F.lit(1)).alias("journals"),
            F.min("first_row").alias("first_row"),
            F.max("last_row").alias("last_row"),
        )
        .where(F.col("journals") >= 2)
        .select(_as_text("digest"), F.lit("SUSPECTED").alias("kind"), "group_rows", "journals", "first_row", "last_row")
    )


def duplicate_groups(candidates: DataFrame) -> DataFrame:
    return exact_groups(candidates).unionByName(suspected_groups(candidates))


def _members(candidates: DataFrame, hot_rows: int) -> DataFrame:
    """Every line of every group beside its group."""
    groups = stage(duplicate_groups(candidates), "duplicate-groups")

    def of(kind: str, key: str, other: str) -> DataFrame:
        lines = candidates.withColumnRenamed(key, "digest").drop(other)
        return join_hot(lines, groups.where(F.col("kind") == kind), ["digest"], "group_rows", hot_rows)

    return of("EXACT", "exact_key", "suspected_key").unionByName(of("SUSPECTED", "suspected_key", "exact_key"))


def duplicate_journals(candidates: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per (group, journal) with how many of the group's lines it holds."""
    return (
        _members(candidates, hot_rows)
        .groupBy("kind", "digest", "journal_id")
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(decision_id().alias("decision_id"), "kind", "journal_id", "lines")
    )


def duplicate_members(
    candidates: DataFrame, index_range: int = INDEX_RANGE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per (group, line) with the line's occurrence number, from 1.

    A window numbers only the lines of one row_index range, at most ``index_range``
    of them; the lines in earlier ranges are added from per-range counts. So a
    group of any size spreads over many tasks.
    """
    both = _members(candidates, hot_rows)
    ranged = both.withColumn("_range", F.floor(F.col("row_index") / index_range))
    earlier = W.partitionBy("kind", "digest").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = (
        ranged.groupBy("kind", "digest", "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("kind", "digest", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(W.partitionBy("kind", "digest", "_range").orderBy("row_index"))
    return (
        ranged.withColumn("_within", within)
        .join(before, ["kind", "digest", "_range"])
        .withColumn("occurrence", (F.col("_before") + F.col("_within")).cast("bigint"))
        .withColumn("decision_id", decision_id())
        .drop("_range", "_within", "_before")
    )


def decision_id() -> Column:
    return sentence("DUP-", F.col("kind"), "-", F.substring("digest", 1, 12))


def described_groups(candidates: DataFrame) -> DataFrame:
    """One row per group with its first line's fields, fetched by row_index.

    The groups are written first, so that Catalyst knows their size.
    """
    groups = stage(duplicate_groups(candidates), "duplicate-groups")
    first = candidates.select(F.col("row_index").alias("first_row"), F.struct(*EXACT_KEY).alias("first"))
    return groups.join(first, "first_row")


def with_rows(
    exact: DataFrame, candidates: DataFrame, index_range: int = INDEX_RANGE, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Described exact groups with ``population_rows``, the row_index of each of their lines, ascending.

    A task lists the lines of one row_index range of a group, at most ``index_range`` of them; only
    the texts of the ranges meet, in the one value that is the list.
    """
    groups = stage(exact.withColumn("_key", F.unhex("digest")), "exact-groups")
    lines = candidates.select(F.unhex("exact_key").alias("_key"), "row_index")
    members = join_hot(lines, groups.select("_key", "group_rows"), ["_key"], "group_rows", hot_rows)
    numbers = F.sort_array(F.collect_list("row_index")).cast("array<string>")
    texts = F.sort_array(F.collect_list(F.struct("_range", "_text")))
    listed = (
        members.groupBy("_key", F.floor(F.col("row_index") / index_range).alias("_range"))
        .agg(F.array_join(numbers, ", ").alias("_text"))
        .groupBy("_key")
        .agg(F.array_join(F.transform(texts, lambda part: part["_text"]), ", ").alias("population_rows"))
    )
    return groups.join(listed, "_key").drop("_key")


def dedupe_findings(
    described: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN
) -> DataFrame:
    """One finding per group, valued at every occurrence after the first.

    The evidence of exact groups that come ``with_rows`` also lists all their lines.
    """
    rows = described.select("*", "first.*").drop("first")
    value = (
        (F.col("group_rows") - 1).cast("decimal(19,0)")
        * (F.col("debit") + F.col("credit")).cast("decimal(38,2)")
    ).cast("decimal(38,2)")
    listed = sentence("first at population row ", F.col("first_row"), ", last at ", F.col("last_row"))
    every = [sentence("; population rows ", F.col("population_rows"))] if "population_rows" in rows.columns else []
    short = F.substring("digest", 1, 12)
    date, code = F.col("posting_date"), F.col("account_code")
    exact = sentence(
        F.col("group_rows"), " lines identical across all eight key fields: ",
        listed, ", journal ", F.col("journal_id"), " line ", F.col("line_no"), ", account ", code,
        ", dated ", date, ", debit ", money_text(F.col("debit")), " credit ",
        money_text(F.col("credit")), *every, "; hash ", short,
    )
    suspected = sentence(
        F.col("group_rows"), " lines share account ", code, ", date ", date, ", debit ",
        money_text(F.col("debit")), " and credit ", money_text(F.col("credit")), " under ",
        F.col("journals"), " journal identifiers: ", listed, "; hash ", short,
    )
    is_exact = F.col("kind") == "EXACT"
    findings = as_findings(
        rows,
        "DEDUPE",
        tolerance,
        run_id,
        account=code,
        journal=F.when(is_exact, F.col("journal_id")),
        value=value,
        record_count=F.col("group_rows"),
        evidence=F.when(is_exact, exact).otherwise(suspected),
        sort_code=F.col("kind"),
        sort_row=F.col("first_row"),
    )
    return findings.withColumn("block", F.when(F.col("sort_code") == "EXACT", 0).otherwise(1))


def duplicate_decisions(described: DataFrame, decided_at: Column) -> DataFrame:
    """A reversible record per group; its lines are ``duplicate_members``, its journals ``duplicate_journals``."""
    return described.select(
        decision_id().alias("decision_id"),
        "kind",
        "group_rows",
        "journals",
        F.lit("PIPELINE").alias("decided_by"),
        decided_at.alias("decided_at"),
        F.lit("OPEN").alias("disposition"),
        F.lit(True).alias("reversible"),
        "first_row",
        "last_row",
    )


def population_unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows lost and rows added between two populations; both empty when unchanged.

    Both directions come of one grouping: a row's copies before less its copies after.
    """
    columns = before.columns
    both = before.withColumn("_n", F.lit(1).cast("bigint")).union(after.withColumn("_n", F.lit(-1).cast("bigint")))
    apart = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return (
        apart.groupBy(F.when(F.col("_n") > 0, "lost").otherwise("added").alias("change"))
        .agg(F.sum(F.abs("_n")).alias("rows"))
    )
