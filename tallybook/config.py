"""Engagement settings: scalars that become literals in the plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from typing import Any

UNIDENTIFIED_RUN = "UNIDENTIFIED-RUN"


def as_date(value: Any) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def as_money(value: Any) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@dataclass(frozen=True)
class Engagement:
    """One provider's settings. None of them has a default worth assuming."""

    provider: str
    engagement: str
    period: str
    year_start: dt.date
    year_end: dt.date
    tolerance: Decimal
    currency: str
    encodings: tuple[str, ...]
    delimiters: tuple[str, ...]
    date_formats: tuple[str, ...]
    confidence_gate: float

    @classmethod
    def from_mapping(cls, raw: Mapping[str, Any]) -> "Engagement":
        """Read the nested per-provider mapping (as loaded from its YAML file)."""
        return cls(
            provider=raw["client_id"],
            engagement=raw["engagement_id"],
            period=raw["period"],
            year_start=as_date(raw["financial_year"]["start"]),
            year_end=as_date(raw["financial_year"]["end"]),
            tolerance=as_money(raw["materiality"]["tolerance"]),
            currency=raw["materiality"]["currency"],
            encodings=tuple(raw["parsing"]["encodings"]),
            delimiters=tuple(raw["parsing"]["delimiters"]),
            date_formats=tuple(raw["parsing"]["date_formats"]),
            confidence_gate=float(raw["mapping"]["confidence_gate"]),
        )
