"""Report views over the KPI tables (the dashboard's data, without the UI).

Every input here is an aggregated KPI table (months, segments, campaigns,
churn bands), except ``churn_bands`` which folds the per-customer table with
one partial/final aggregate on the three band labels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, mean, money_terms, money_value, ratio_or_zero
from ..schema import DIMENSIONS
from .funnel import top_dropoff  # noqa: F401  (re-exported view)
from .segments import segment_wallet_share


def select_months(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Keep the chosen months (all when ``months`` is None)."""
    return monthly if months is None else monthly.where(F.col("month").isin(list(months)))


def require_rows(df: DataFrame, message: str = "Select at least one month.") -> DataFrame:
    """API-edge guard: raise ``ValueError`` when the selection is empty."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def kpi_strip(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Totals over the selected months: sessions, orders, revenue, and
    conversion / AOV that are 0 (not NULL) on a zero denominator.
    Users are not additive across months and are deliberately not summed."""
    agg = select_months(monthly, months).agg(
        bigint_sum("sessions").alias("sessions"),
        bigint_sum("orders").alias("orders"),
        *money_terms("revenue"),
    )
    revenue = money_value()
    return agg.select(
        "sessions", "orders", revenue.alias("revenue"),
        ratio_or_zero("orders", "sessions").alias("visit_to_order_rate"),
        ratio_or_zero(revenue, "orders").alias("aov"),
    )


def monthly_long(monthly: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Unpivot sessions and orders per month to ``month, metric, value``."""
    m = select_months(monthly, months).select(
        "month", F.col("sessions").cast("long").alias("sessions"), F.col("orders").cast("long").alias("orders")
    )
    return m.unpivot(["month"], ["sessions", "orders"], "metric", "value")


def wallet_view(segments: DataFrame, dimension: str = DIMENSIONS[0], dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One dimension's segments of a written rollup, largest revenue share first.

    ``dimensions`` are the ones that were rolled up. From the base table,
    ``dimension_wallet`` folds one dimension alone."""
    if dimension not in dimensions:
        raise ValueError(f"dimension must be one of {list(dimensions)}, got {dimension!r}")
    return _by_share(segments.where(F.col("dimension") == F.lit(dimension)))


def dimension_wallet(events: DataFrame, dimension: str = DIMENSIONS[0], session_count_mode: str = "ids") -> DataFrame:
    """``wallet_view`` from the base table: groups by the one dimension only."""
    if dimension not in events.columns:
        raise ValueError(f"no column {dimension!r} to group by")
    return _by_share(segment_wallet_share(events, [dimension], session_count_mode, ordered=False))


def _by_share(segments: DataFrame) -> DataFrame:
    return segments.orderBy(F.col("wallet_share").desc_nulls_last(), F.col("segment").asc_nulls_last())


def churn_bands(customers: DataFrame) -> DataFrame:
    """Per churn band: customers, revenue, average orders, average days since
    last order; largest band first. Customers are distinct ids, whether or not the
    table has one row for each."""
    agg = customers.where(F.col("churn_risk").isNotNull()).groupBy("churn_risk").agg(
        F.countDistinct("user_id").alias("customers"),
        *money_terms("customer_revenue"),
        mean("order_count").alias("avg_orders"),
        mean("days_since_last_order").alias("avg_days_since_last_order"),
    )
    return agg.select(
        "churn_risk", "customers", money_value().alias("revenue"), "avg_orders", "avg_days_since_last_order"
    ).orderBy(F.col("customers").desc(), F.col("churn_risk").asc())


def campaign_scatter(campaigns: DataFrame) -> DataFrame:
    """Scatter data: x conversion, y revenue per session, size sessions,
    colour channel, hover campaign type / orders / revenue."""
    return campaigns.select(
        "conversion_rate", "revenue_per_session", "sessions", "channel", "campaign_type", "orders", "revenue"
    )


def _by_revenue(campaigns: DataFrame) -> DataFrame:
    return campaigns.orderBy(
        F.col("revenue").desc_nulls_last(), F.col("channel").asc_nulls_last(), F.col("campaign_type").asc_nulls_last()
    )


def top_campaign(campaigns: DataFrame) -> DataFrame:
    """Highest-revenue campaign (ties broken by the key columns)."""
    return _by_revenue(campaigns).limit(1).select("channel", "campaign_type", "revenue")


def top_campaigns(campaigns: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest-revenue campaigns (a top-k: ``TakeOrderedAndProject``)."""
    return _by_revenue(campaigns).limit(n)
