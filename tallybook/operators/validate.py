"""Validation: a row that breaks a rule is quarantined whole, never repaired.

The raw columns are text. ``check_rows`` parses each field and decides whether the
row holds; only a row that does not carries its raw values and the list of rules it
breaks. Accepted and quarantined rows are two filters over that one table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.errors import ControlTotalError
from tallybook.functions.parsing import (
    DECIMAL_NUMBER,
    date_from_formats,
    money,
    trimmed,
    whole_number,
)
from tallybook.functions.text import sentence

# The wording of structural failures.
NOT_TEXT = "Input should be a valid string"
TOO_SHORT = "String should have at least 1 character"
NEGATIVE = "Input should be greater than or equal to 0"
ABSENT = "Field required"
UNEXPECTED = "Extra inputs are not permitted"

SOURCE_COLUMNS = ("source_file", "source_sha256", "row_number")


def quoted(value: Column) -> Column:
    """The value as it is shown in a failure's detail; a missing one shows as None."""
    mark = F.when(value.contains("'") & ~value.contains('"'), '"').otherwise("'")
    return F.when(value.isNull(), "None").otherwise(F.concat(mark, value, mark))


def _failure(rule: str, field: str, detail: Column | str) -> Column:
    return F.struct(
        F.lit(rule).alias("rule_id"),
        F.lit(field).alias("field"),
        (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"),
    )


def _text_failure(field: str, value: Column, required: bool) -> Column:
    found = F.when(value.isNull(), _failure("V-TYPE", field, NOT_TEXT))
    if required:
        found = found.when(F.length(value) == 0, _failure("V-EMPTY", field, TOO_SHORT))
    return found


def _money_failure(field: str, value: Column, parsed: Column, unsigned: bool) -> Column:
    text = trimmed(value)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    not_a_number = text.rlike("(?i)^[+-]?nan$")
    infinite = text.rlike("(?i)^[+-]?inf(inity)?$")
    detail = (
        F.when(not_a_number, sentence(sign, "NaN is not a finite amount"))
        .when(infinite, sentence(sign, "Infinity is not a finite amount"))
        .when(
            text.rlike(DECIMAL_NUMBER),
            sentence(text, " carries more digits than a monetary amount can hold"),
        )
        .otherwise(sentence(quoted(value), " cannot be read as a monetary amount"))
    )
    found = F.when(parsed.isNull(), _failure("V-DECIMAL", field, detail))
    if unsigned:
        found = found.when(parsed < 0, _failure("V-SIGN", field, NEGATIVE))
    return found


def _date_failure(field: str, value: Column, parsed: Column, formats: Sequence[str]) -> Column:
    unread = (
        sentence(value, f" matches none of the configured formats: {', '.join(formats)}")
        if formats
        else sentence("no date formats are configured, so ", value, " cannot be read")
    )
    detail = F.when(
        value.isNull(), "a date must arrive as text; this arrived as NoneType"
    ).otherwise(unread)
    return F.when(parsed.isNull(), _failure("V-DATE", field, detail))


def _line_failure(field: str, value: Column, parsed: Column) -> Column:
    return F.when(
        parsed.isNull(), _failure("V-INTEGER", field, sentence(quoted(value), " is not a whole number"))
    ).when(
        parsed < 1,
        _failure("V-INTEGER", field, sentence("line numbers start at 1; this row carries ", parsed)),
    )


def field_failure(
    rule: str, field: str, value: Column, parsed: Column, date_formats: Sequence[str]
) -> Column:
    """The rule a field breaks, as a struct; NULL if it breaks none."""
    if rule in ("required", "text"):
        return _text_failure(field, value, rule == "required")
    if rule in ("money", "movement"):
        return _money_failure(field, value, parsed, rule == "movement")
    if rule == "date":
        return _date_failure(field, value, parsed, date_formats)
    return _line_failure(field, value, parsed)


def parsed_field(rule: str, value: Column, date_formats: Sequence[str]) -> Column:
    if rule in ("money", "movement"):
        return money(value)
    if rule == "date":
        return date_from_formats(value, date_formats)
    if rule == "line_no":
        return whole_number(value)
    return value


def field_holds(rule: str, parsed: Column) -> Column:
    """Whether a parsed field obeys its rule. Never NULL."""
    if rule == "required":
        return F.coalesce(F.length(parsed) > 0, F.lit(False))
    if rule == "movement":
        return F.coalesce(parsed >= 0, F.lit(False))
    if rule == "line_no":
        return F.coalesce(parsed >= 1, F.lit(False))
    return parsed.isNotNull()


def check_rows(
    raw: DataFrame,
    rules: Mapping[str, str],
    date_formats: Sequence[str],
    source_columns: Sequence[str] = SOURCE_COLUMNS,
) -> DataFrame:
    """Every raw row with its parsed fields and whether it holds.

    Out: source columns, the canonical fields (NULL where unreadable), ``holds``, and
    for rows that do not hold ``failures`` (in field order) and ``raw`` (the values as
    they arrived). The failure texts are only built for those rows.
    """
    kept = [c for c in source_columns if c in raw.columns]
    arrived = [c for c in raw.columns if c not in kept]
    unexpected = [c for c in arrived if c not in rules]
    absent = [f for f in rules if f not in arrived]

    whole = raw.select(*kept, *(F.col(f"`{c}`").alias(f"_raw_{i}") for i, c in enumerate(arrived)))
    value = {c: F.col(f"_raw_{i}") for i, c in enumerate(arrived)}
    parsed = whole.withColumns(
        {
            field: parsed_field(rule, value[field], date_formats)
            if field in value
            else F.lit(None).cast("string")
            for field, rule in rules.items()
        }
    )
    holds = F.lit(not unexpected and not absent)
    for field, rule in rules.items():
        holds = holds & field_holds(rule, F.col(field))
    judged = parsed.withColumn("holds", holds)

    failures = [
        field_failure(rule, field, value[field], F.col(field), date_formats)
        if field in value
        else _failure("V-REQUIRED", field, ABSENT)
        for field, rule in rules.items()
    ]
    failures += [_failure("V-UNEXPECTED-FIELD", field, UNEXPECTED) for field in unexpected]
    pairs = F.array(*(F.struct(F.lit(c).alias("k"), value[c].alias("v")) for c in arrived))
    broken = ~F.col("holds")
    return judged.select(
        *kept,
        *rules,
        "holds",
        F.when(broken, F.filter(F.array(*failures), lambda x: x.isNotNull())).alias("failures"),
        F.when(broken, F.map_from_entries(pairs)).alias("raw"),
    )


def accepted_rows(checked: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that break no rule, as canonical records with their source columns."""
    kept = [c for c in SOURCE_COLUMNS if c in checked.columns]
    return checked.where("holds").select(*kept, *rules)


def quarantined_rows(checked: DataFrame) -> DataFrame:
    """Rows that break a rule: the first at top level, all in ``failures``, raw kept."""
    kept = [c for c in SOURCE_COLUMNS if c in checked.columns]
    return checked.where(~F.col("holds")).select(
        *kept, F.col("failures")[0].alias("_first"), "failures", "raw"
    ).select(*kept, "_first.*", "failures", "raw")


def broken_rules(quarantined: DataFrame, rules: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """One row per failure of ``rules``, beside the columns ``kept``.

    Rules are chosen within the list, not above the exploded rows: there a filter has
    Catalyst derive what holds of every parsed field, which fills a driver's memory.
    """
    wanted = F.filter("failures", lambda f: f["rule_id"].isin(*rules))
    return quarantined.select(*kept, F.explode(wanted).alias("_f")).select(*kept, "_f.*")


def rule_counts(quarantined: DataFrame) -> DataFrame:
    """How often each rule broke, per field, counting every failure of every row."""
    return (
        quarantined.select(F.explode("failures").alias("_f"))
        .groupBy("_f.rule_id", "_f.field")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def control_total(received: DataFrame, checked: DataFrame, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Rows received, accepted and quarantined per source file, told apart by the columns ``by``.

    ``received`` is the scan itself, so that a row lost on the way shows.
    """
    arrived = received.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_received"))
    became = checked.groupBy(*by).agg(
        F.count_if("holds").alias("rows_accepted"), F.count_if(~F.col("holds")).alias("rows_quarantined")
    )
    counts = ("rows_received", "rows_accepted", "rows_quarantined")
    joined = arrived.join(became, list(by), "full_outer").select(
        *by, *(F.coalesce(c, F.lit(0)).alias(c) for c in counts)
    )
    return joined.withColumn(
        "holds", F.col("rows_received") == F.col("rows_accepted") + F.col("rows_quarantined")
    )


def assert_control_total(totals: DataFrame) -> None:
    """Stop the run unless received = accepted + quarantined for every file."""
    broken = totals.where(~F.col("holds")).orderBy("source_file").limit(20).collect()
    if broken:
        raise ControlTotalError(
            "control total failed: "
            + "; ".join(
                f"{r.source_file}: {r.rows_received} rows received, {r.rows_accepted} accepted plus "
                f"{r.rows_quarantined} quarantined"
                for r in broken
            )
        )
