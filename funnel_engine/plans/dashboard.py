"""Data behind each dashboard panel, built from the pipeline's written outputs.

Each panel is a small DataFrame derived from one KPI table and the user's
selections (months, wallet-share dimension); rendering is left to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import currency_text, pct_text
from ..operators.views import (
    campaign_scatter,
    churn_bands,
    kpi_strip,
    monthly_long,
    require_rows,
    select_months,
    top_campaigns,
    wallet_view,
)
from ..schema import DIMENSIONS, RETENTION_HORIZONS
from ..sinks.published import OutputMemo

#: Outputs that panels have read; a further look at them scans nothing until they change.
MEMO = OutputMemo()

PANEL_SOURCES = [
    "funnel_summary",
    "monthly_growth_kpis",
    "segment_wallet_share",
    "campaign_performance",
    "retention_summary",
    "customer_retention_churn",
]


def kpi_strip_text(strip: DataFrame) -> DataFrame:
    """The KPI strip as shown: thousands separators, currency without decimals, one-decimal percent."""
    return strip.select(
        F.format_number("sessions", 0).alias("sessions"),
        F.format_number("orders", 0).alias("orders"),
        currency_text("revenue").alias("revenue"),
        pct_text("visit_to_order_rate", 1).alias("visit_to_order"),
        currency_text("aov").alias("aov"),
    )


def _rates(horizons: Sequence[int]) -> list[str]:
    return ["first_to_second_order_rate", *[f"d{h}_retention" for h in horizons], "high_churn_risk_rate"]


def retention_text(retention: DataFrame, horizons: Sequence[int] = RETENTION_HORIZONS) -> DataFrame:
    """The retention tiles as shown: one-decimal percent."""
    return retention.select(*[pct_text(c, 1).alias(c) for c in _rates(horizons)])


def panels(
    outputs: dict[str, DataFrame],
    months: Sequence[str] | None = None,
    dimension: str = DIMENSIONS[0],
    top_n: int = 20,
    horizons: Sequence[int] = RETENTION_HORIZONS,
) -> dict[str, DataFrame]:
    """KPI strip, funnel, monthly sessions/orders, retention tiles, campaign
    scatter, wallet share, churn bands and the top campaign table.

    Raises ``ValueError`` when the month selection is empty (checked on the
    monthly table, at most one row per month)."""
    monthly = outputs["monthly_growth_kpis"]
    require_rows(select_months(monthly, months), "Select at least one month.")
    strip = kpi_strip(monthly, months)
    retention = outputs["retention_summary"]
    return {
        "kpi_strip": strip,
        "kpi_strip_text": kpi_strip_text(strip),
        "funnel": outputs["funnel_summary"].select("stage_order", "stage", "sessions", "conversion_from_visit"),
        "monthly_long": monthly_long(monthly, months),
        "retention": retention.select(*_rates(horizons)),
        "retention_text": retention_text(retention, horizons),
        "campaign_scatter": campaign_scatter(outputs["campaign_performance"]),
        "wallet_share": wallet_view(outputs["segment_wallet_share"], dimension),
        "churn_bands": churn_bands(outputs["customer_retention_churn"]),
        "top_campaigns": top_campaigns(outputs["campaign_performance"], top_n),
    }


def load_panels(
    spark: SparkSession,
    out_dir: str,
    months: Sequence[str] | None = None,
    dimension: str = DIMENSIONS[0],
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Read the written outputs (CSV with its typed schemas; once, until they change) and build every panel."""
    return panels(MEMO.read(spark, out_dir, PANEL_SOURCES, fmt), months, dimension)
