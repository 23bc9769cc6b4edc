"""The shared base table ``funnel_events`` every KPI reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import flag_exact
from ..schema import DISCOUNT, STAGES

BASE_COLUMNS = [
    "user_id", "session_id", "event_date", "month",
    "channel", "campaign_type", "device", "user_type", "region",
    "order_value", "revenue",
    *[flag for _, flag, _ in STAGES], DISCOUNT[1],
]


def funnel_events(sessions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Project a (clean or typed) session table to the base table.

    ``date`` becomes ``event_date`` (DATE); money is DOUBLE at the surface;
    the six flags are exact ``'Yes'`` matches (case-sensitive, untrimmed),
    which is what every KPI query counts. It is a narrow projection, so
    Catalyst fuses it into each consumer's scan stage; a pipeline that reuses
    it many times reads it back from a written table instead. Text ids stay
    text; other id types become bigint. ``keep`` names further columns to carry.
    """
    kinds = dict(sessions.dtypes)
    ids = [F.col(c) if kinds[c] == "string" else F.col(c).cast("long") for c in ("user_id", "session_id")]
    cols = [
        ids[0].alias("user_id"),
        ids[1].alias("session_id"),
        F.col("date").cast("date").alias("event_date"),
        F.col("month").cast("string").alias("month"),
        *[F.col(c).cast("string").alias(c) for c in ["channel", "campaign_type", "device", "user_type", "region"]],
        F.col("order_value").cast("double").alias("order_value"),
        F.col("revenue").cast("double").alias("revenue"),
        *[flag_exact(raw).alias(flag) for raw, flag, _ in STAGES],
        flag_exact(DISCOUNT[0]).alias(DISCOUNT[1]),
        *keep,
    ]
    return sessions.select(*cols)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``path`` (shared storage) and return
    the table read back: later queries scan it with column pruning and
    pushed-down filters, and its lineage is cut, so a lost executor costs a
    re-read rather than a re-run of the upstream joins."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def register_views(events: DataFrame, name: str = "funnel_events") -> DataFrame:
    """Expose the base table to ``spark.sql`` under ``name``."""
    events.createOrReplaceTempView(name)
    return events


def register_kpi_views(sessions: DataFrame, raw_name: str = "sessions") -> dict[str, DataFrame]:
    """Register the raw session table, the base table and every KPI as temp
    views, so SQL users can query them with ``spark.sql`` (each view is a lazy
    plan; nothing runs until a query reads it). Returns the registered frames."""
    from ..operators import (
        campaign_basic,
        campaign_performance,
        customer_retention_churn,
        executive_kpis,
        funnel_summary,
        monthly_kpis,
        monthly_kpis_basic,
        retention_asof,
        retention_summary,
        segment_wallet_share,
        stage_counts,
    )

    events = funnel_events(sessions)
    customers = customer_retention_churn(events)
    views = {
        raw_name: sessions,
        "funnel_events": events,
        "executive_kpis": executive_kpis(events),
        "funnel_stage_counts": stage_counts(events),
        "funnel_summary": funnel_summary(events),
        "monthly_growth_kpis": monthly_kpis(events),
        "monthly_kpis_basic": monthly_kpis_basic(events),
        "segment_wallet_share": segment_wallet_share(events),
        "segment_wallet_share_rows": segment_wallet_share(events, session_count_mode="rows"),
        "campaign_performance": campaign_performance(events),
        "campaign_basic": campaign_basic(sessions),
        "customer_retention_churn": customers,
        "retention_summary": retention_summary(customers),
        "retention_asof": retention_asof(sessions),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
