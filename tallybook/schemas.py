"""Canonical schemas, the control register and its fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical fields in declaration order, with the rule each obeys.
#   required  text, at least one character      text      any text, not missing
#   date      one of the configured formats     line_no   whole number from 1
#   money     signed decimal, two places        movement  money, not negative
DETAIL_RULES: dict[str, str] = {
    "entity": "required",
    "account_code": "required",
    "account_name": "text",
    "posting_date": "date",
    "period": "required",
    "journal_id": "required",
    "line_no": "line_no",
    "description": "text",
    "debit": "movement",
    "credit": "movement",
    "currency": "required",
    "source_system": "text",
}
SUMMARY_RULES: dict[str, str] = {
    "entity": "required",
    "account_code": "required",
    "account_name": "text",
    "opening_balance": "money",
    "period_debits": "movement",
    "period_credits": "movement",
    "closing_balance": "money",
}
DATASET_RULES: dict[str, dict[str, str]] = {"gl": DETAIL_RULES, "tb": SUMMARY_RULES}

MONEY = T.DecimalType(28, 2)
TOTAL = T.DecimalType(38, 2)
_RULE_TYPES: dict[str, T.DataType] = {
    "required": T.StringType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "line_no": T.LongType(),
    "money": MONEY,
    "movement": MONEY,
}


def canonical_schema(rules: dict[str, str]) -> T.StructType:
    """The typed schema of a population, with its 0-based ``row_index``."""
    fields = [T.StructField(name, _RULE_TYPES[rule]) for name, rule in rules.items()]
    return T.StructType([*fields, T.StructField("row_index", T.LongType())])


DETAIL_SCHEMA = canonical_schema(DETAIL_RULES)
SUMMARY_SCHEMA = canonical_schema(SUMMARY_RULES)

# The register of controls, in reporting order.
CONTROLS = ("C1", "C2", "C3", "C4", "C5", "C6", "DEDUPE")
CONTROL_POSITION = {control: place for place, control in enumerate(CONTROLS)}

# The columns of the findings register, in writing order.
REGISTER_COLUMNS = (
    "run_id",
    "control_id",
    "severity",
    "entity",
    "account_code",
    "journal_id",
    "value",
    "record_count",
    "above_materiality",
    "evidence",
    "disposition",
)

# A finding also carries where it stands in the register.
ORDER_COLUMNS = ("control_pos", "block", "sort_code", "sort_row")

CONTROL_SUMMARY_COLUMNS = (
    "run_id",
    "control_id",
    "status",
    "rows_tested",
    "exceptions_raised",
    "reason",
    "detail",
)

# What makes two detail lines exact, or suspected, duplicates.
EXACT_KEY = (
    "entity",
    "account_code",
    "posting_date",
    "journal_id",
    "line_no",
    "debit",
    "credit",
    "description",
)
SUSPECTED_KEY = ("entity", "account_code", "posting_date", "debit", "credit")

HEADERS_SCHEMA = "provider string, dataset string, source_column string, position bigint"
FIELDS_SCHEMA = "dataset string, field string, field_position bigint"
SYNONYMS_SCHEMA = "dataset string, field string, term string, term_position bigint"
REGISTRY_SCHEMA = (
    "provider string, dataset string, source_column string, canonical_field string, "
    "source_tier int, confidence double, approved_by string, approved_at string, "
    "rationale string"
)
PROPOSALS_SCHEMA = (
    "dataset string, header_key string, canonical_field string, confidence double, "
    "rationale string"
)
RESOLUTION_SCHEMA = (
    "provider string, dataset string, source_column string, position bigint, "
    "canonical_field string, confidence double, source_tier int, rationale string, "
    "state string"
)
