"""Column resolution: registry, then synonyms, then outside proposals, then a gate.

Everything runs over one headers table (provider, dataset, source_column,
position) holding the columns of every file of every provider at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.errors import MappingError
from tallybook.functions.text import (
    MASK_BITS,
    letter_masks,
    normalise_header,
    sentence,
    similarity,
)
from tallybook.schemas import PROPOSALS_SCHEMA
from tallybook.workspace import stage

# Terms held in one row of the synonym side; more terms make more rows.
TERMS_PER_ROW = 1_000
# Most synonym terms for which the synonym side is broadcast.
BROADCAST_TERMS = 20_000
# Beyond it, each dataset's headers spread over this many salts.
SALTS = 64

# Similarity from which a key's nearest term is found through the index of segments.
CLOSE = 0.9
# Up to so many terms, comparing with all of them is cheaper than the index.
FEW_TERMS = 300

FILE = ("provider", "dataset")


# ---- reference tables and their checks -------------------------------------------


def _refuse(rows: DataFrame, what: str) -> None:
    bad = rows.limit(20).collect()
    if bad:
        raise MappingError(f"{what}: " + "; ".join(str(r.asDict()) for r in bad))


def check_fields_known(rows: DataFrame, fields: DataFrame, column: str, what: str) -> None:
    """Every (dataset, field) named must exist in the canonical schema."""
    known = fields.select("dataset", F.col("field").alias(column))
    _refuse(
        rows.select("dataset", column).distinct().join(known, ["dataset", column], "left_anti"), what
    )


def synonym_conflicts(synonyms: DataFrame) -> DataFrame:
    """Normalised terms that claim two fields of one dataset."""
    return (
        synonyms.select("dataset", normalise_header(F.col("term")).alias("term"), "field")
        .distinct()
        .groupBy("dataset", "term")
        .agg(F.count(F.lit(1)).alias("fields"))
        .where(F.col("fields") > 1)
    )


def check_synonyms(synonyms: DataFrame, fields: DataFrame) -> None:
    check_fields_known(synonyms, fields, "field", "synonyms name a field the dataset does not have")
    _refuse(synonym_conflicts(synonyms), "a synonym maps to two fields")


def synonym_terms(synonyms: DataFrame) -> DataFrame:
    """One row per (dataset, normalised term): its field and first position."""
    return (
        synonyms.select("dataset", normalise_header(F.col("term")).alias("term"), "field", "term_position")
        .groupBy("dataset", "term", "field")
        .agg(F.min("term_position").alias("term_position"))
    )


# ---- tier 1 -----------------------------------------------------------------------


def approved_columns(registry: DataFrame) -> DataFrame:
    """Approved columns with the account of who approved them, when and at which tier."""
    provenance = sentence(
        "registry entry for ", F.col("provider"), " ", F.col("dataset"), ", approved by ",
        F.coalesce(F.col("approved_by"), F.lit("an unrecorded approver")), " on ",
        F.coalesce(F.col("approved_at"), F.lit("an unrecorded date")),
        F.coalesce(sentence(" at tier ", F.col("source_tier")), F.lit("")),
        F.when(F.length("rationale") > 0, sentence(": ", F.col("rationale"))).otherwise(""),
    )
    return registry.select(*FILE, "source_column", "canonical_field", provenance.alias("_provenance"))


def tier1_registry(headers: DataFrame, registry: DataFrame) -> DataFrame:
    """Headers equal, letter for letter, to a column approved for their file."""
    return headers.join(approved_columns(registry), [*FILE, "source_column"]).select(
        *headers.columns,
        "canonical_field",
        F.lit(1.0).alias("confidence"),
        F.lit(1).alias("source_tier"),
        F.col("_provenance").alias("rationale"),
    )


# ---- tier 2 -----------------------------------------------------------------------


def tier2_synonym(headers: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Headers whose normalised form is a normalised synonym."""
    terms = synonym_terms(synonyms).select("dataset", "term", "field")
    return (
        headers.withColumn("term", normalise_header(F.col("source_column")))
        .join(terms, ["dataset", "term"])
        .select(
            *headers.columns,
            F.col("field").alias("canonical_field"),
            F.lit(1.0).alias("confidence"),
            F.lit(2).alias("source_tier"),
            F.lit("exact synonym match").alias("rationale"),
        )
    )


def _term_rows(synonyms: DataFrame) -> DataFrame:
    """Each dataset's terms packed into arrays of TERMS_PER_ROW or fewer."""
    term = F.col("term")
    masks = F.when(F.length(term).between(1, MASK_BITS), letter_masks(term))
    return (
        synonym_terms(synonyms)
        .withColumn("_chunk", F.floor(F.col("term_position") / TERMS_PER_ROW))
        .groupBy("dataset", "_chunk")
        .agg(F.collect_list(F.struct("term_position", "term", "field", masks.alias("masks"))).alias("terms"))
    )


def _allowed(size: Column, ratio: float) -> Column:
    """Most letters outside the common subsequence of two texts of this ratio, one of them this long."""
    return F.floor(size * (2 * (1 - ratio) / ratio) + 1e-9)


def _term_segments(terms: DataFrame, ratio: float) -> DataFrame:
    """Each term cut into one segment more than letters may be lost: one of them is whole in any text of the ratio.

    A letter outside the common subsequence, of either text, breaks one segment of the term at most.
    """
    size = F.length("term")
    many = _allowed(size, ratio) + 1
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1))
    cut = terms.select("dataset", "term_position", "term", size.alias("_n"), many.alias("_many"), number.alias("_i"))
    start = F.floor(F.col("_i") * F.col("_n") / F.col("_many"))
    end = F.floor((F.col("_i") + 1) * F.col("_n") / F.col("_many"))
    return cut.withColumns({"_start": start, "_end": end}).select(
        "dataset", "term_position", "_n", "_start",
        F.substring("term", (F.col("_start") + 1).cast("int"), (F.col("_end") - F.col("_start")).cast("int")).alias("segment"),
    )


def _key_segments(keys: DataFrame, ratio: float) -> DataFrame:
    """Every part of a key that is as long as a segment of a term in its length band can be."""
    size = F.length("header_key")
    band = F.sequence(F.ceil(size * ratio / (2 - ratio) - 1e-9), F.floor(size * (2 - ratio) / ratio + 1e-9))

    def widths(n: Column) -> Column:
        many = _allowed(n, ratio) + 1
        return F.array(F.floor(n / many), F.ceil(n / many))

    width = F.explode(F.array_distinct(F.flatten(F.transform(band, widths))))
    wide = keys.select("dataset", "header_key", size.alias("_m"), width.alias("_width")).where(F.col("_width") <= F.col("_m"))
    place = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - F.col("_width")))
    return wide.select("dataset", "header_key", "_m", "_width", place.alias("_place")).select(
        "dataset", "header_key", "_m", "_place",
        F.substring("header_key", (F.col("_place") + 1).cast("int"), F.col("_width").cast("int")).alias("segment"),
    )


def close_pairs(keys: DataFrame, terms: DataFrame, ratio: float = CLOSE) -> DataFrame:
    """(dataset, header_key, term_position) of every key and term whose similarity may reach ``ratio``.

    An inverted index of the terms' segments: a key meets a term only where their lengths allow
    the ratio and a segment lies in the key no farther from its place than letters may be lost.
    """
    # Written, so that the join can be split under a segment that many texts hold.
    left = stage(_key_segments(keys, ratio), "key-segments")
    right = stage(_term_segments(terms, ratio), "term-segments")
    total = F.col("_m") + F.col("_n")
    lost = total - 2 * F.ceil(total * ratio / 2 - 1e-9)
    near = (F.abs(F.col("_m") - F.col("_n")) <= lost) & (F.abs(F.col("_place") - F.col("_start")) <= lost)
    return left.join(right, ["dataset", "segment"]).where(near).select("dataset", "header_key", "term_position").distinct()


def _close_terms(keys: DataFrame, terms: DataFrame) -> DataFrame:
    """The nearest term of each key that has one of similarity CLOSE or more."""
    masks = F.when(F.length("term").between(1, MASK_BITS), letter_masks(F.col("term")))
    prepared = stage(terms.select("dataset", "term_position", "term", "field", masks.alias("masks")), "terms")
    met = close_pairs(keys, prepared).join(prepared, ["dataset", "term_position"])
    scored = met.withColumn("ratio", similarity(F.col("header_key"), F.col("term"), F.col("masks")))
    best = F.max(F.struct("ratio", (-F.col("term_position")).alias("earlier"), "term", "field")).alias("best")
    return scored.where(F.col("ratio") >= CLOSE).groupBy("dataset", "header_key").agg(best)


def nearest_argmax(keys: DataFrame, synonyms: DataFrame) -> DataFrame:
    """The most similar synonym of each (dataset, header_key); first term wins ties.

    Where there are many terms, keys first look for one of similarity CLOSE or more through
    an index of the terms' segments, which misses none; only keys without one are compared with all
    terms of their dataset, and then only with those whose length does not already keep them
    below the best so far. Terms come as one array per row, so no such pair is ever a row of
    its own. Keys nothing resembles at all are left out.
    """
    n_terms = synonyms.count()
    keys = keys.select("dataset", "header_key").distinct()
    settled = None
    if n_terms > FEW_TERMS:
        keys = stage(keys, "keys")
        settled = stage(_close_terms(keys, stage(synonym_terms(synonyms), "synonyms")), "close-terms")
        keys = keys.join(settled.select("dataset", "header_key"), ["dataset", "header_key"], "left_anti")
    packed = _term_rows(synonyms)
    if n_terms <= BROADCAST_TERMS:
        met = keys.join(F.broadcast(packed), "dataset")
    else:
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        spread = packed.withColumn("_salt", F.explode(salts))
        met = keys.withColumn("_salt", F.pmod(F.xxhash64("header_key"), F.lit(SALTS)).cast("int")).join(
            spread, ["dataset", "_salt"]
        )
    size = F.length("header_key")

    def better(best: Column, t: Column) -> Column:
        # No common subsequence is longer than the shorter text.
        reach = F.when(size + F.length(t["term"]) == 0, F.lit(1.0)).otherwise(
            2.0 * F.least(size, F.length(t["term"])) / (size + F.length(t["term"]))
        )
        scored = F.struct(
            similarity(F.col("header_key"), t["term"], t["masks"]).alias("ratio"),
            (-t["term_position"]).cast("bigint").alias("earlier"),
            t["term"].alias("term"),
            t["field"].alias("field"),
        )
        return F.when(reach < best["ratio"], best).otherwise(F.greatest(best, scored))

    text = F.lit(None).cast("string")
    none = F.struct(
        F.lit(0.0).alias("ratio"), F.lit(-(1 << 62)).cast("bigint").alias("earlier"), text.alias("term"), text.alias("field")
    )
    found = met.select("dataset", "header_key", F.aggregate("terms", none, better).alias("best"))
    found = found.groupBy("dataset", "header_key").agg(F.max("best").alias("best")).where(F.col("best.ratio") > 0)
    parts = [F.col(f"best.{c}").alias(c) for c in ("ratio", "term", "field")]
    answers = found.select("dataset", "header_key", *parts)
    if settled is not None:
        answers = answers.unionByName(settled.select("dataset", "header_key", *parts))
    return answers


def tier2_fuzzy_nearest(headers: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Each header with its nearest synonym. Spelling variants are compared once."""
    keyed = headers.withColumn("header_key", normalise_header(F.col("source_column")))
    nearest = nearest_argmax(keyed.select("dataset", "header_key").distinct(), synonyms)
    return keyed.join(nearest, ["dataset", "header_key"], "left").select(
        *headers.columns, "header_key", "ratio", "term", "field"
    )


# ---- tier 3 -----------------------------------------------------------------------


def check_proposals(proposals: DataFrame, fields: DataFrame) -> None:
    """Outside proposals must name known fields, once per header, confidence in [0, 1]."""
    check_fields_known(
        proposals, fields, "canonical_field", "a proposal names a field the dataset does not have"
    )
    _refuse(
        proposals.groupBy("dataset", "header_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1),
        "two proposals for one header",
    )
    _refuse(
        proposals.where(~F.col("confidence").between(0.0, 1.0) | F.col("confidence").isNull()),
        "a proposal's confidence is outside 0 to 1",
    )


def unsent_proposals(proposals: DataFrame, sent: DataFrame) -> DataFrame:
    """Proposals for headers nobody asked about."""
    asked = sent.select("dataset", normalise_header(F.col("source_column")).alias("header_key")).distinct()
    return proposals.join(asked, ["dataset", "header_key"], "left_anti")


def tier3_proposals(unresolved: DataFrame, proposals: DataFrame) -> DataFrame:
    """Outside proposals for the headers tiers 1 and 2 left. The tier is set here."""
    answers = proposals.select("dataset", "header_key", "canonical_field", "confidence", "rationale")
    return (
        unresolved.withColumn("header_key", normalise_header(F.col("source_column")))
        .join(answers, ["dataset", "header_key"])
        .select(
            "provider", "dataset", "source_column", "position", "canonical_field", "confidence",
            F.lit(3).alias("source_tier"), "rationale",
        )
    )


# ---- the gate ---------------------------------------------------------------------


def _two_places(ratio: Column) -> Column:
    return F.bround(ratio, 2).cast("decimal(10,2)").cast("string")


def gate_routing(
    headers: DataFrame,
    registry: DataFrame,
    synonyms: DataFrame,
    proposals: DataFrame | None,
    gate: float,
) -> DataFrame:
    """Every header with its best answer and where the gate sends it, before contests.

    ``settles`` is true for deterministic answers, and for proposals at or above the
    gate from a provider and dataset that were approved before. Each header meets the
    registry, its nearest synonym and its proposal in turn; only spellings the
    registry does not answer are compared with the synonyms.
    """
    approved = approved_columns(registry).withColumnRenamed("canonical_field", "_approved")
    looked_up = headers.withColumn("header_key", normalise_header(F.col("source_column"))).join(
        approved, [*FILE, "source_column"], "left"
    )
    open_keys = looked_up.where(F.col("_approved").isNull()).select("dataset", "header_key").distinct()
    answers = proposals if proposals is not None else headers.sparkSession.createDataFrame([], PROPOSALS_SCHEMA)
    answers = answers.select(
        "dataset", "header_key", F.col("canonical_field").alias("_proposed"), "confidence",
        F.col("rationale").alias("_stated"),
    )
    known = registry.select(*FILE).distinct().withColumn("_known", F.lit(True))
    met = (
        looked_up.join(nearest_argmax(open_keys, synonyms), ["dataset", "header_key"], "left")
        .join(answers, ["dataset", "header_key"], "left")
        .join(known, list(FILE), "left")
    )

    by_registry = F.col("_approved").isNotNull()
    exact = F.coalesce(F.col("term") == F.col("header_key"), F.lit(False))
    by_synonym = F.coalesce(F.col("ratio") >= gate, F.lit(False))
    by_proposal = F.col("_proposed").isNotNull()
    named = sentence("'", F.col("term"), "' for ", F.col("field"))
    score = _two_places(F.col("ratio"))
    reason = "no model attached" if proposals is None else "the model returned no proposal for this column"
    account = F.when(F.col("term").isNull(), "no synonym in the dataset's list came close").otherwise(
        sentence("nearest synonym ", named, " scored ", score, f", below the {gate:.2f} gate")
    )
    fuzzy = sentence(
        "fuzzy match to synonym ", named, " scoring ", score, f", at or above the {gate:.2f} gate"
    )
    return met.select(
        "provider",
        "dataset",
        "source_column",
        "position",
        F.when(by_registry, F.col("_approved"))
        .when(by_synonym, F.col("field"))
        .otherwise(F.col("_proposed"))
        .alias("canonical_field"),
        F.when(by_registry | (by_synonym & exact), 1.0)
        .when(by_synonym, F.col("ratio"))
        .when(by_proposal, F.col("confidence"))
        .otherwise(0.0)
        .alias("confidence"),
        F.when(by_registry, 1).when(by_synonym, 2).when(by_proposal, 3).alias("source_tier"),
        F.when(by_registry, F.col("_provenance"))
        .when(by_synonym & exact, "exact synonym match")
        .when(by_synonym, fuzzy)
        .when(by_proposal, F.col("_stated"))
        .otherwise(sentence("unresolved: ", account, f"; {reason}"))
        .alias("rationale"),
        (
            by_registry
            | by_synonym
            | (by_proposal & (F.col("confidence") >= gate) & F.col("_known").isNotNull())
        ).alias("settles"),
    )


def _with_holder(routed: DataFrame) -> DataFrame:
    """Each answer with the first column of its file that settles on the same field.

    The holder is found by aggregation and joined back, so a field that very many
    columns claim is never gathered into one task.
    """
    holders = (
        routed.where("settles")
        .groupBy(*FILE, "canonical_field")
        .agg(F.min(F.struct("position", "source_column")).alias("_holder"))
    )
    return routed.join(holders, [*FILE, "canonical_field"], "left")


def _is_contested() -> Column:
    later = F.col("position") > F.col("_holder.position")
    return F.coalesce(F.col("settles") & later, F.lit(False))


def contested_field(routed: DataFrame) -> DataFrame:
    """Settling answers whose field an earlier column of the same file holds."""
    contested = _with_holder(routed).where(_is_contested())
    return contested.select(*routed.columns, F.col("_holder.source_column").alias("holder"))


def resolve_columns(
    headers: DataFrame,
    registry: DataFrame,
    synonyms: DataFrame,
    proposals: DataFrame | None,
    gate: float,
) -> DataFrame:
    """Each header once, either ``resolved`` to a field or in ``review``.

    The routed answers are written before contests are looked for, so the synonym
    comparison runs once.
    """
    routed = stage(gate_routing(headers, registry, synonyms, proposals, gate), "routed")
    adjudicate = sentence(
        F.col("rationale"), "; '", F.col("_holder.source_column"), "' already resolves to ",
        F.col("canonical_field"), ", so both need adjudication",
    )
    return _with_holder(routed).select(
        "provider",
        "dataset",
        "source_column",
        "position",
        "canonical_field",
        "confidence",
        "source_tier",
        F.when(_is_contested(), adjudicate).otherwise(F.col("rationale")).alias("rationale"),
        F.when(F.col("settles") & ~_is_contested(), "resolved").otherwise("review").alias("state"),
    )


# ---- what a resolution amounts to --------------------------------------------------


def missing_fields(resolution: DataFrame, fields: DataFrame) -> DataFrame:
    """Canonical fields no column of a file settled on. Any row stops that file's run."""
    files = resolution.select(*FILE).distinct()
    wanted = files.join(fields, "dataset")
    settled = resolution.where("state = 'resolved'").select(
        *FILE, F.col("canonical_field").alias("field")
    )
    return wanted.join(settled, [*FILE, "field"], "left_anti").select(*FILE, "field", "field_position")


def column_accounting(headers: DataFrame, resolution: DataFrame) -> DataFrame:
    """Headers lost and columns invented between file and resolution; none expected."""
    arrived = headers.select(*FILE, "source_column")
    accounted = resolution.select(*FILE, "source_column")
    lost = arrived.exceptAll(accounted).withColumn("problem", F.lit("lost"))
    return lost.unionByName(accounted.exceptAll(arrived).withColumn("problem", F.lit("invented")))


def mapping_figures(resolution: DataFrame) -> DataFrame:
    """Per file: columns by tier, and how many wait for review."""
    tier = F.col("source_tier")
    return resolution.groupBy(*FILE).agg(
        F.count_if(tier == 1).alias("tier1"),
        F.count_if(tier == 2).alias("tier2"),
        F.count_if(tier == 3).alias("tier3"),
        F.count_if(F.col("state") == "review").alias("review"),
        F.count_if(F.col("state") == "resolved").alias("mapped"),
    )


def file_order(resolution: DataFrame) -> DataFrame:
    return resolution.orderBy(*FILE, "position")
