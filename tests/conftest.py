import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallybook.config import Engagement  # noqa: E402

ENGAGEMENT = Engagement(
    provider="CLIENT_A",
    engagement="FY2026-AUDIT",
    period="FY2026",
    year_start=dt.date(2025, 7, 1),
    year_end=dt.date(2026, 6, 30),
    tolerance=Decimal("1000.00"),
    currency="AUD",
    encodings=("utf-8", "latin-1"),
    delimiters=(",", "\t", "|"),
    date_formats=("%Y-%m-%d", "%d/%m/%Y", "%d-%b-%Y"),
    confidence_gate=0.85,
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallybook-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def engagement():
    return ENGAGEMENT
