"""Text to typed values: a value that cannot be read becomes NULL, never a guess."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strptime directives and the datetime pattern letters they mean.
# One-letter day and month patterns take one digit or two, as strptime does.
DATE_DIRECTIVES = {
    "%Y": "yyyy",
    "%m": "M",
    "%d": "d",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "D",
    "%%": "'%'",
}

# The shape each directive reads. Text of another shape is not tried,
# which spares a failed parse per format and keeps years at four digits.
DIRECTIVE_SHAPES = {
    "%Y": "[0-9]{4}",
    "%m": "[0-9]{1,2}",
    "%d": "( [1-9]|[0-9]{1,2})",
    "%b": "[A-Za-z]{3}",
    "%B": "[A-Za-z]+",
    "%j": "[0-9]{1,3}",
    "%%": "%",
}

# What a whole number and a finite decimal look like as text.
WHOLE_NUMBER = r"^[+-]?[0-9]+$"
DECIMAL_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
WHITESPACE = " \t\n\r\x0b\x0c"


def _format_parts(strptime_format: str) -> list[str]:
    """Directives and the text between them; refuse a directive with no equivalent."""
    parts = re.findall(r"%.|[^%]+", strptime_format)
    for part in parts:
        if part.startswith("%") and part not in DATE_DIRECTIVES:
            raise ValueError(f"date directive {part} in {strptime_format!r} is not supported")
    return parts


def datetime_pattern(strptime_format: str) -> str:
    """The Spark datetime pattern of a strptime format."""
    return "".join(
        DATE_DIRECTIVES[part] if part.startswith("%") else re.sub("([A-Za-z]+)", r"'\1'", part)
        for part in _format_parts(strptime_format)
    )


def date_shape(strptime_format: str) -> str:
    """A regular expression every text of a strptime format matches."""
    return "^" + "".join(
        DIRECTIVE_SHAPES[part] if part.startswith("%") else re.escape(part)
        for part in _format_parts(strptime_format)
    ) + "$"


def money(value: Column) -> Column:
    """DECIMAL(28,2) rounded half up; NULL for text, NaN, infinity or overflow."""
    return value.try_cast("decimal(28,2)")


def whole_number(value: Column) -> Column:
    return F.when(
        F.trim(value, F.lit(WHITESPACE)).rlike(WHOLE_NUMBER), value.try_cast("bigint")
    )


def date_from_formats(value: Column, formats: Sequence[str]) -> Column:
    """First configured format that reads the value; with no formats, NULL."""
    if not formats:
        return F.lit(None).cast("date")
    return F.coalesce(*(_date_of(value, f) for f in formats))


def _date_of(value: Column, strptime_format: str) -> Column:
    text = value
    if "%d" in strptime_format and " " not in strptime_format:
        # A day padded with a space is the only space the shape lets through.
        text = F.replace(value, F.lit(" "), F.lit(""))
    parsed = F.try_to_date(text, datetime_pattern(strptime_format))
    return F.when(value.rlike(date_shape(strptime_format)), parsed)


def trimmed(value: Column) -> Column:
    return F.trim(value, F.lit(WHITESPACE))
