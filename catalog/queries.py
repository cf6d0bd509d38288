"""One query per operator, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import ledger as L
from catalog import texts as X
from tallybook.functions.grading import above_materiality, severity
from tallybook.functions.parsing import date_from_formats, money, whole_number
from tallybook.functions.text import normalise_header
from tallybook.operators import approve as A
from tallybook.operators import controls as C
from tallybook.operators import dedupe as D
from tallybook.operators import derive as G
from tallybook.operators import mapping as M
from tallybook.operators import profile as P
from tallybook.operators import report as R
from tallybook.operators import totals as T
from tallybook.operators import validate as V
from tallybook.operators.projection import canonical_projection
from tallybook.plans.register import all_findings, control_summary, register_places, run_controls
from tallybook.schemas import DETAIL_RULES, REGISTER_COLUMNS
from tallybook.sources import delimited, sinks
from tallybook.sources.manifest import source_manifest
from tallybook.sources.reference_tables import registry_table
from tallybook.workspace import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

E = L.ENGAGEMENT
RUN = "RUN"
GATE = E.confidence_gate
APPROVED_AT = "2026-08-01"


def query(build: Query | str):
    """Register a query under its own name, or under the one given."""
    if isinstance(build, str):
        return lambda named: QUERIES.setdefault(build, named)
    return QUERIES.setdefault(build.__name__, build)


def register(findings: DataFrame) -> DataFrame:
    return findings.select(*REGISTER_COLUMNS)


def _candidates(spark, sf_dir) -> DataFrame:
    return L._once(spark, sf_dir, "candidates", lambda: D.duplicate_candidates(L.detail(spark, sf_dir)))


def _described(spark, sf_dir) -> DataFrame:
    return L._once(
        spark, sf_dir, "described", lambda: stage(D.described_groups(_candidates(spark, sf_dir)), "described")
    )


def _register(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The whole register, run anew."""
    return run_controls(
        L.detail(spark, sf_dir), L.summary(spark, sf_dir), E, L.prior(spark, sf_dir), run_id=RUN
    )


def _findings(spark, sf_dir) -> DataFrame:
    """The register's findings, for the reports that only read them."""
    return L._once(spark, sf_dir, "findings", lambda: stage(_register(spark, sf_dir)[0], "found"))


def _checked(spark, sf_dir) -> DataFrame:
    return V.check_rows(X.dirty_text(spark, sf_dir), DETAIL_RULES, E.date_formats)


def _resolution(spark, sf_dir) -> DataFrame:
    return M.resolve_columns(
        X.headers(spark, sf_dir), X.registry(spark, sf_dir), X.synonyms(spark, sf_dir),
        X.proposals(spark, sf_dir), GATE,
    )


def _resolved(spark, sf_dir) -> DataFrame:
    return L._once(spark, sf_dir, "resolution", lambda: stage(_resolution(spark, sf_dir), "resolution"))


def _shown(resolution: DataFrame) -> DataFrame:
    return resolution.withColumn("confidence", F.round("confidence", 6))


# ---- the register ------------------------------------------------------------------


@query
def c1_journal_balance(spark, sf_dir):
    return register(C.c1_journal_balance(L.detail(spark, sf_dir), E.tolerance, RUN))


@query
def c1_ledger_crosscheck(spark, sf_dir):
    return C.c1_ledger_crosscheck(L.detail(spark, sf_dir)).withColumn("detail", C.c1_detail_text())


@query
def account_totals(spark, sf_dir):
    return T.account_totals(L.detail(spark, sf_dir))


@query
def c2_detail_vs_summary(spark, sf_dir):
    return register(
        C.c2_detail_vs_summary(T.account_totals(L.detail(spark, sf_dir)), L.summary(spark, sf_dir), E.tolerance, RUN)
    )


@query
def c3_summary_only(spark, sf_dir):
    return register(C.c3_summary_only(T.account_totals(L.detail(spark, sf_dir)), L.summary(spark, sf_dir), E.tolerance, RUN))


@query
def c3_detail_only(spark, sf_dir):
    return register(C.c3_detail_only(T.account_totals(L.detail(spark, sf_dir)), L.summary(spark, sf_dir), E.tolerance, RUN))


@query
def c4_cutoff(spark, sf_dir):
    return register(C.c4_cutoff(L.detail(spark, sf_dir), E.year_start, E.year_end, E.tolerance, RUN))


@query
def out_of_period_guard(spark, sf_dir):
    outside = C.out_of_period(L.detail(spark, sf_dir), E.year_start, E.year_end)
    return outside.select("row_index", "journal_id", F.col("posting_date").cast("string").alias("posting_date"))


@query
def c5_rollforward(spark, sf_dir):
    return register(C.c5_rollforward(L.summary(spark, sf_dir), L.prior(spark, sf_dir), E.tolerance, RUN))


@query
def account_union(spark, sf_dir):
    return C.account_union(L.summary(spark, sf_dir), L.prior(spark, sf_dir))


@query
def c6_tb_internal(spark, sf_dir):
    return register(C.c6_tb_internal(L.summary(spark, sf_dir), E.tolerance, RUN))


@query
def tb_row_arithmetic(spark, sf_dir):
    rows = C.tb_row_arithmetic(L.summary(spark, sf_dir))
    return rows.select("account_code", "closing_balance", "derived", "difference")


@query("control_summary")
def control_summary_rows(spark, sf_dir):
    return control_summary(
        _findings(spark, sf_dir).drop("control_pos"), L.detail(spark, sf_dir), L.summary(spark, sf_dir),
        L.prior(spark, sf_dir), RUN,
    )


@query("run_controls")
def run_controls_register(spark, sf_dir):
    return _register(spark, sf_dir)[0]


@query
def register_order(spark, sf_dir):
    """All findings with their place in the whole register."""
    detail, summary, prior = L.detail(spark, sf_dir), L.summary(spark, sf_dir), L.prior(spark, sf_dir)
    duplicates = D.dedupe_findings(D.described_groups(_candidates(spark, sf_dir)), E.tolerance, RUN)
    return register_places(all_findings(detail, summary, E, prior, RUN, duplicates)).select(
        "place", "control_id", "control_pos", "block", "sort_code", "value"
    )


@query
def evidence(spark, sf_dir):
    return _findings(spark, sf_dir).select("control_id", "evidence")


# ---- duplicates --------------------------------------------------------------------


@query
def exact_key(spark, sf_dir):
    return L.detail(spark, sf_dir).select("row_index", D.exact_key().alias("digest"))


@query
def suspected_key(spark, sf_dir):
    return L.detail(spark, sf_dir).select("row_index", D.suspected_key().alias("digest"))


@query
def dedupe_exact(spark, sf_dir):
    """The findings of exact duplicates; their evidence lists every line of the group."""
    candidates = _candidates(spark, sf_dir)
    described = D.described_groups(candidates).where("kind = 'EXACT'")
    return register(D.dedupe_findings(D.with_rows(described, candidates), E.tolerance, RUN))


@query
def dedupe_suspected(spark, sf_dir):
    described = D.described_groups(_candidates(spark, sf_dir)).where("kind = 'SUSPECTED'")
    return register(D.dedupe_findings(described, E.tolerance, RUN))


@query
def duplicate_decisions(spark, sf_dir):
    decisions = D.duplicate_decisions(_described(spark, sf_dir), F.current_timestamp())
    return decisions.select(
        "decision_id", "kind", "group_rows", "journals", "first_row", "last_row", "decided_by", "disposition", "reversible",
    )


@query
def duplicate_members(spark, sf_dir):
    members = D.duplicate_members(_candidates(spark, sf_dir))
    return members.select("decision_id", "kind", "row_index", "journal_id", "occurrence", "group_rows")


@query
def duplicate_journals(spark, sf_dir):
    return D.duplicate_journals(_candidates(spark, sf_dir))


@query
def population_unchanged(spark, sf_dir):
    """Flagging and unflagging the ledger leaves its rows as they were."""
    before = L.detail(spark, sf_dir)
    flagged = _candidates(spark, sf_dir).select("row_index").distinct().withColumn("_flag", F.lit(True))
    after = before.join(flagged, "row_index", "left").select(*before.columns)
    changes = D.population_unchanged(before, after)
    counts = changes.agg(
        F.coalesce(F.sum(F.when(F.col("change") == "lost", F.col("rows"))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.when(F.col("change") == "added", F.col("rows"))), F.lit(0)).alias("added"),
        F.lit(1).alias("_one"),
    )
    total = before.agg(F.count(F.lit(1)).alias("rows"), F.lit(1).alias("_one"))
    return total.join(counts, "_one").drop("_one")


# ---- projections and grading -------------------------------------------------------


@query("canonical_projection")
def canonical_projection_rows(spark, sf_dir):
    text = X.clean_text(spark, sf_dir)
    arrived = text.select("row_index", *(F.col(c).alias(s) for s, c in X.HEADER.items()))
    return canonical_projection(arrived, X.HEADER, keep=("row_index",))


@query("normalise_header")
def normalise_headers(spark, sf_dir):
    return X.headers(spark, sf_dir).select(
        "provider", "position", "source_column", normalise_header(F.col("source_column")).alias("normalised")
    )


@query("severity")
def severity_scale(spark, sf_dir):
    lines = T.signed_amount(L.detail(spark, sf_dir))
    unbalanced = F.col("line_no") == 1001
    affects = F.col("account_code") != "4000"
    return lines.select(
        "row_index",
        severity(
            F.col("amount"), E.tolerance, unbalanced_journal=unbalanced, affects_balance=affects
        ).alias("severity"),
    )


@query("above_materiality")
def above_materiality_flag(spark, sf_dir):
    amount = F.col("closing_balance")
    return L.summary(spark, sf_dir).select(
        "account_code", above_materiality(F.abs(amount), E.tolerance).alias("above_materiality")
    )


@query
def signed_amount(spark, sf_dir):
    return T.signed_amount(L.detail(spark, sf_dir)).select("row_index", "amount", "movement")


# ---- validation --------------------------------------------------------------------


@query
def parse_money(spark, sf_dir):
    rows = X.dirty_text(spark, sf_dir)
    return rows.select("row_number", F.col("debit").alias("text"), money(F.col("debit")).alias("parsed"))


@query
def parse_date_multi(spark, sf_dir):
    parsed = date_from_formats(F.col("posting_date"), E.date_formats)
    return X.dirty_text(spark, sf_dir).select(
        "row_number", F.col("posting_date").alias("text"), parsed.cast("string").alias("parsed")
    )


@query
def parse_whole_number(spark, sf_dir):
    return X.dirty_text(spark, sf_dir).select(
        "row_number", F.col("line_no").alias("text"), whole_number(F.col("line_no")).alias("parsed")
    )


def _failures(spark, sf_dir, *rules: str) -> DataFrame:
    return V.broken_rules(V.quarantined_rows(_checked(spark, sf_dir)), rules, ("row_number",))


@query
def required_text(spark, sf_dir):
    return _failures(spark, sf_dir, "V-EMPTY", "V-TYPE")


@query
def movement_sign(spark, sf_dir):
    return _failures(spark, sf_dir, "V-SIGN")


@query
def structural_rules(spark, sf_dir):
    """A table without its currency and with a column nobody mapped."""
    rows = X.dirty_text(spark, sf_dir).withColumnRenamed("currency", "ccy")
    checked = V.check_rows(rows, DETAIL_RULES, E.date_formats)
    return V.rule_counts(V.quarantined_rows(checked))


@query
def quarantine_split(spark, sf_dir):
    accepted = V.accepted_rows(_checked(spark, sf_dir), DETAIL_RULES)
    return accepted.withColumn("posting_date", F.col("posting_date").cast("string")).drop("source_sha256")


@query
def quarantine_detail(spark, sf_dir):
    rows = V.quarantined_rows(_checked(spark, sf_dir))
    every = F.array_join(F.transform("failures", lambda f: F.concat(f["rule_id"], F.lit(" "), f["field"])), "; ")
    return rows.select(
        "source_file", "row_number", "rule_id", "field", "detail", every.alias("failures"),
        F.col("raw")["debit"].alias("raw_debit"), F.size("raw").cast("bigint").alias("raw_fields"),
    )


@query
def control_total(spark, sf_dir):
    return V.control_total(X.dirty_text(spark, sf_dir), _checked(spark, sf_dir))


# ---- reports -----------------------------------------------------------------------


@query
def by_control(spark, sf_dir):
    return R.by_control(_findings(spark, sf_dir)).drop("control_pos")


@query
def agreement(spark, sf_dir):
    return R.agreement(_findings(spark, sf_dir), L.summary(spark, sf_dir))


def _counters(spark, sf_dir) -> DataFrame:
    findings = _findings(spark, sf_dir)
    lines, balances = L.detail(spark, sf_dir), L.summary(spark, sf_dir)
    did = control_summary(findings, lines, balances, L.prior(spark, sf_dir), RUN)
    totals = V.control_total(X.dirty_text(spark, sf_dir), _checked(spark, sf_dir))
    return R.counters(
        findings, did, totals, _resolved(spark, sf_dir), lines, balances, _described(spark, sf_dir), 2
    )


@query
def counters(spark, sf_dir):
    return _counters(spark, sf_dir)


@query
def register_sink(spark, sf_dir):
    """The register as it is written, read back from the written file."""
    path = new_path(spark, "register")
    sinks.write_register(_findings(spark, sf_dir), path)
    columns = ", ".join(f"{c} string" for c in REGISTER_COLUMNS)
    back = spark.read.schema(columns).options(header=True, quote='"', escape='"').csv(f"{path}/csv")
    return back.select(*(F.coalesce(c, F.lit("")).alias(c) for c in REGISTER_COLUMNS))


@query
def run_log_sink(spark, sf_dir):
    findings = _findings(spark, sf_dir)
    lines, balances = L.detail(spark, sf_dir), L.summary(spark, sf_dir)
    checked = _checked(spark, sf_dir)
    totals = V.control_total(X.dirty_text(spark, sf_dir), checked, ("source_file",)).select(
        F.lit("gl").alias("dataset"), "source_file", "rows_received", "rows_accepted", "rows_quarantined"
    )
    # The headers of all providers stand for one run's: one entry per dataset.
    figures = M.mapping_figures(_resolved(spark, sf_dir)).groupBy("dataset")
    mapping = figures.agg(*(F.sum(c).alias(c) for c in ("tier1", "tier2", "tier3", "review", "mapped")))
    header = spark.createDataFrame([(RUN, E.provider)], "run_id string, provider string")
    log = sinks.run_log(
        header, _counters(spark, sf_dir), totals, mapping,
        control_summary(findings, lines, balances, L.prior(spark, sf_dir), RUN), R.by_control(findings),
    )
    path = new_path(spark, "run-log")
    sinks.write_run_log(log, path)
    back = spark.read.schema(log.schema).json(path)
    kept = ("run_id", "provider", "counters.rows_received", "counters.exceptions", "control_total_holds")
    return back.select(
        *kept,
        F.size("controls").cast("bigint").alias("controls"),
        F.size("exception_value_by_control").cast("bigint").alias("controls_with_findings"),
        F.col("sources")[0]["rows_quarantined"].alias("quarantined"),
        F.explode("mapping").alias("mapping"),
    ).select("*", "mapping.*").drop("mapping")


@query
def register_vs_expected(spark, sf_dir):
    """C1's findings against the one-sided and copied journals of the plan: what was
    re-keyed is unexpected, and one expectation per re-keyed order is not found."""
    key, zero = F.col("order_key"), F.lit(0).cast("decimal(38,2)")
    per_order = L._per_order(L._postings(spark, sf_dir))
    planned = F.when(key % 499 == 1, F.col("total")).otherwise(zero) + F.when(
        key % 997 == 0, F.lit(250)
    ).otherwise(zero)
    expected = per_order.select(
        F.lit("C1").alias("control_id"), "journal_id", planned.cast("decimal(38,2)").alias("value")
    ).where(F.col("value") != 0).unionByName(
        per_order.where(key % 613 == 2).select(
            F.lit("C1").alias("control_id"), "journal_id", F.lit(1).cast("decimal(38,2)").alias("value")
        )
    )
    found = C.c1_journal_balance(L.detail(spark, sf_dir), E.tolerance, RUN)
    return R.bag_difference(found, expected, ["control_id", "journal_id", "value"])


# ---- column profiles ---------------------------------------------------------------


def _profiled(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    clean = X.clean_text(spark, sf_dir)
    rows = clean.select(
        "row_index", "line_no", "debit", "posting_date", "description",
        F.lit("  ").alias("blank"),
        F.when(F.col("row_index") % 5 == 0, "x").otherwise(F.col("line_no")).alias("mixed"),
    )
    return rows, [c for c in rows.columns if c != "row_index"]


@query
def column_profile(spark, sf_dir):
    rows, columns = _profiled(spark, sf_dir)
    return P.column_profile(rows, columns).withColumn("examples", F.array_join("examples", "|"))


@query
def kind_inference(spark, sf_dir):
    rows, columns = _profiled(spark, sf_dir)
    return P.kind_inference(P.value_counts(rows, columns))


@query
def sample_and_examples(spark, sf_dir):
    """Profiles over the first rows in file order, as a proposer is shown them."""
    rows, columns = _profiled(spark, sf_dir)
    sample = P.sample_rows(rows)
    return P.examples(P.value_counts(sample, columns)).withColumn("examples", F.array_join("examples", "|"))


# ---- column mapping ----------------------------------------------------------------


@query
def tier1_registry(spark, sf_dir):
    return _shown(M.tier1_registry(X.headers(spark, sf_dir), X.registry(spark, sf_dir)))


@query
def tier2_synonym(spark, sf_dir):
    return _shown(M.tier2_synonym(X.headers(spark, sf_dir), X.synonyms(spark, sf_dir)))


@query
def tier2_fuzzy_nearest(spark, sf_dir):
    nearest = M.tier2_fuzzy_nearest(X.headers(spark, sf_dir), X.synonyms(spark, sf_dir))
    return nearest.withColumn("ratio", F.round("ratio", 6))


@query
def nearest_argmax(spark, sf_dir):
    keys = X.headers(spark, sf_dir).select(
        "dataset", normalise_header(F.col("source_column")).alias("header_key")
    ).distinct()
    return M.nearest_argmax(keys, X.synonyms(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


@query
def tier3_proposals(spark, sf_dir):
    headers = X.headers(spark, sf_dir)
    settled = M.tier1_registry(headers, X.registry(spark, sf_dir)).unionByName(
        M.tier2_synonym(headers, X.synonyms(spark, sf_dir))
    )
    file = ["provider", "dataset", "position"]
    left = headers.join(settled.select(*file), file, "left_anti")
    return _shown(M.tier3_proposals(left, X.proposals(spark, sf_dir)))


def _routed(spark, sf_dir) -> DataFrame:
    return M.gate_routing(
        X.headers(spark, sf_dir), X.registry(spark, sf_dir), X.synonyms(spark, sf_dir),
        X.proposals(spark, sf_dir), GATE,
    )


@query
def gate_routing(spark, sf_dir):
    return _shown(_routed(spark, sf_dir))


@query
def contested_field(spark, sf_dir):
    return M.contested_field(_routed(spark, sf_dir)).select(
        "provider", "dataset", "source_column", "position", "canonical_field", "holder"
    )


@query
def file_order_proposals(spark, sf_dir):
    return _shown(M.file_order(_resolution(spark, sf_dir)))


@query
def review_queue_sink(spark, sf_dir):
    path = new_path(spark, "queue")
    sinks.write_review_queue(_resolved(spark, sf_dir), path)
    return _shown(sinks.load_queue(spark, path))


@query
def missing_fields(spark, sf_dir):
    return M.missing_fields(_resolved(spark, sf_dir), X.fields(spark, sf_dir))


@query
def column_accounting(spark, sf_dir):
    headers, resolution = X.headers(spark, sf_dir), _resolved(spark, sf_dir)
    problems = M.column_accounting(headers, resolution)
    one = F.lit(1).alias("_one")
    return (
        headers.agg(F.count(F.lit(1)).alias("headers"), one)
        .join(resolution.agg(F.count(F.lit(1)).alias("accounted"), one), "_one")
        .join(problems.agg(F.count(F.lit(1)).alias("problems"), one), "_one")
        .drop("_one")
    )


@query
def mapping_figures(spark, sf_dir):
    return M.mapping_figures(_resolved(spark, sf_dir))


@query
def reference_tables(spark, sf_dir):
    """The registry as one nested document per provider, flattened again."""
    flat = X.registry(spark, sf_dir)
    column = F.struct(
        "canonical_field", "source_tier", "confidence", "approved_by",
        F.lit(None).cast("string").alias("approved_at"), "rationale",
    )
    # A provider has HEADERS_PER_PROVIDER columns at most.
    nested = flat.groupBy("provider", "dataset").agg(
        F.first("approved_at").alias("at"), F.map_from_entries(F.collect_list(F.struct("source_column", column))).alias("columns")
    )
    document = nested.select(
        F.create_map(
            "provider",
            F.create_map("dataset", F.struct(F.col("at").alias("approved_at"), "columns")),
        ).alias("clients")
    )
    return registry_table(document)


# ---- approval ----------------------------------------------------------------------


@query
def approve_all(spark, sf_dir):
    return _shown(A.approve_all(_resolved(spark, sf_dir)))


def _names(spark, sf_dir) -> DataFrame:
    """Columns waiting with a proposed field whose name ends in a given letter."""
    queue = _resolved(spark, sf_dir)
    return A.approve_all(queue).where(F.col("source_column").endswith("L")).select("source_column")


@query
def approve_named(spark, sf_dir):
    return _shown(A.approve_named(_resolved(spark, sf_dir), _names(spark, sf_dir)))


def _entry(spark, sf_dir) -> DataFrame:
    queue = _resolved(spark, sf_dir)
    approving = A.approve_named(queue, _names(spark, sf_dir)).where(F.col("canonical_field").isNotNull())
    return A.registry_entry(queue, approving, X.registry(spark, sf_dir), APPROVED_AT)


@query
def registry_entry(spark, sf_dir):
    return _shown(_entry(spark, sf_dir)).select(
        "provider", "dataset", "source_column", "canonical_field", "source_tier", "confidence",
        "approved_by", "approved_at", "rationale", "position",
    )


@query
def registry_upsert(spark, sf_dir):
    registry = X.registry(spark, sf_dir)
    return _shown(A.registry_upsert(registry, _entry(spark, sf_dir)))


@query
def written_summary(spark, sf_dir):
    return A.written_summary(_entry(spark, sf_dir))


# ---- derivation --------------------------------------------------------------------


@query
def derive_summary(spark, sf_dir):
    return G.derive_summary(L.clean_lines(spark, sf_dir), L.chart(spark, sf_dir), "E001")


@query
def expand_journals(spark, sf_dir):
    total = F.col("o_totalprice").cast("decimal(28,2)")
    part = (total * F.lit("0.6").cast("decimal(3,1)")).cast("decimal(28,2)")
    zero = F.lit(0).cast("decimal(28,2)")

    def entry(code, text, debit, credit):
        return F.struct(
            F.lit(code).alias("account_code"), F.lit(text).alias("description"),
            debit.cast("decimal(28,2)").alias("debit"), credit.cast("decimal(28,2)").alias("credit"),
        )

    two = F.array(entry("1100", "sale", total, zero), entry("4100", "revenue", zero, total))
    three = F.array(
        entry("1100", "sale", part, zero), entry("1000", "deposit", total - part, zero),
        entry("4100", "revenue", zero, total),
    )
    journals = L.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("journal_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("posting_date"),
        F.when(F.col("o_orderkey") % 2 == 0, two).otherwise(three).alias("entries"),
    )
    return G.expand_journals(journals)


@query
def two_sided_check(spark, sf_dir):
    return G.two_sided_lines(L.detail(spark, sf_dir)).select("row_index", "journal_id", "debit", "credit")


@query
def expectation_suite(spark, sf_dir):
    clean, delivered = L.clean_lines(spark, sf_dir), L.detail(spark, sf_dir)
    balances = L.summary(spark, sf_dir)
    count = F.count(F.lit(1)).alias("actual")

    def unbalanced(lines):
        by = lines.groupBy("journal_id").agg(F.sum("debit").alias("d"), F.sum("credit").alias("c"))
        return by.where("d <> c").agg(count)

    closing = F.sum("closing_balance").cast("decimal(38,2)").alias("actual")
    still = balances.select("account_code").join(delivered.select("account_code").distinct(), "account_code", "left_anti")
    checks = [
        G.Expectation("V1", "every clean journal balances", "0", unbalanced(clean)),
        G.Expectation(
            "V2", "the clean ledger balances", "0.00",
            clean.agg((F.sum("debit") - F.sum("credit")).cast("decimal(38,2)").alias("actual")),
        ),
        G.Expectation("V3", "summary closings sum to nil", "0.00", balances.agg(closing)),
        G.Expectation("V4", "every summary row follows", "0", C.tb_row_arithmetic(balances).agg(count)),
        G.Expectation("V5", "two accounts are without lines", "2", still.agg(count)),
        G.Expectation(
            "V7", "every clean posting is in the year", "0",
            C.out_of_period(clean, E.year_start, E.year_end).agg(count),
        ),
        G.Expectation("V8", "every delivered journal balances", "0", unbalanced(delivered)),
        G.Expectation(
            "V9", "no exact duplicates were delivered", "0",
            D.exact_groups(_candidates(spark, sf_dir)).agg(count),
        ),
        G.Expectation("V10", "summary closings sum to the moved amount", "1850.00", balances.agg(closing)),
        G.Expectation(
            "G3", "no suspected duplicates were delivered", "0",
            D.suspected_groups(_candidates(spark, sf_dir)).agg(count),
        ),
        G.Expectation("G10", "every clean line has one side", "0", G.two_sided_lines(clean).agg(count)),
    ]
    return G.expectation_suite(checks)


# ---- sources -----------------------------------------------------------------------


def _scan(spark, sf_dir) -> DataFrame:
    path = X.text_files(spark, sf_dir)
    header = delimited.header_of(spark, path, "utf-8", ",")
    return delimited.all_text_scan(spark, path, header, "utf-8", ",")


@query
def all_text_scan(spark, sf_dir):
    scanned = _scan(spark, sf_dir)
    return scanned.select(
        *(F.col(s).alias(c) for s, c in X.HEADER.items()), F.col("__extra__").isNull().alias("regular")
    )


@query
def row_position(spark, sf_dir):
    """Per file, whether its rows are numbered 1 to n without a gap."""
    # Sixty numbers to a group, a bit each: what a task holds is a sixtieth of its rows.
    number = F.col("row_number")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(60)).cast("int"))
    per_file = _scan(spark, sf_dir).groupBy("source_path", F.floor(number / 60).alias("_sixty")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_or(bit).alias("_bits"),
        F.min("row_number").alias("first"), F.max("row_number").alias("last"),
    ).groupBy("source_path").agg(
        F.sum("rows").alias("rows"), F.sum(F.bit_count("_bits")).alias("numbers"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    dense = (F.col("numbers") == F.col("rows")) & (F.col("first") == 1) & (F.col("last") == F.col("rows"))
    return per_file.agg(F.sum("rows").alias("rows"), F.sum(F.when(dense, F.col("rows"))).alias("well_numbered"))


@query
def format_audit(spark, sf_dir):
    audit = delimited.format_audit(spark, X.text_files(spark, sf_dir), E.encodings, E.delimiters)
    return audit.groupBy("encoding", "delimiter", "width").agg(
        (F.sum("lines") - F.count(F.lit(1))).alias("rows")
    )


@query("source_manifest")
def source_manifest_files(spark, sf_dir):
    path = X.text_files(spark, sf_dir)
    return source_manifest(spark, path, E).select(
        "filename", "sha256", "byte_size", "provider", "engagement", "period"
    )
