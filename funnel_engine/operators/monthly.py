"""Monthly growth KPIs (one group-by on ``month``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, money_value, ratio
from .cells import cell_sums, event_sums, session_count  # noqa: F401  (session_count is part of this module's interface)
from .grouping import sums_and_distinct

_SUMS = ["views", "carts", "checkouts", "orders", "discounted_sessions"]


def _finish(agg: DataFrame, ordered: bool) -> DataFrame:
    revenue = money_value()
    out = agg.select(
        "month", "sessions", *[c for c in ["users"] if c in agg.columns],
        F.col("views").alias("product_views"), F.col("carts").alias("cart_adds"), "checkouts", "orders",
        revenue.alias("revenue"),
        "discounted_sessions",
        ratio("orders", "sessions").alias("visit_to_order_rate"),
        ratio(revenue, "orders").alias("aov"),
        ratio("discounted_sessions", "sessions").alias("discount_usage_rate"),
    )
    return out.orderBy(F.col("month").asc_nulls_last()) if ordered else out


def monthly_kpis(
    events: DataFrame, session_count_mode: str = "ids", ordered: bool = True, split_distinct: bool = True, users: bool = True
) -> DataFrame:
    """Per month: sessions, distinct users, stage counts, orders, revenue,
    discounted sessions, visit-to-order rate, AOV and discount usage rate.

    The sums fold map-side to one row per month and task; distinct users
    shuffle only de-duplicated ``(month, user_id)`` pairs, so a hot month is
    spread over partitions by user and a hot user is collapsed per task
    (see ``grouping.sums_and_distinct``). ``users=False`` leaves the distinct
    count out, and with it the second read.
    """
    aggs = event_sums(session_count_mode, _SUMS)
    if not users:
        return _finish(events.groupBy("month").agg(*aggs), ordered)
    return _finish(sums_and_distinct(events, ["month"], aggs, split=split_distinct), ordered)


def monthly_from_cells(cells: DataFrame, session_count_mode: str = "ids", ordered: bool = True) -> DataFrame:
    """``monthly_kpis`` from folded cells."""
    return _finish(cells.groupBy("month").agg(*cell_sums(session_count_mode, _SUMS), bigint_sum("users_month").alias("users")), ordered)


def monthly_kpis_basic(
    events: DataFrame, session_count_mode: str = "ids", ordered: bool = True, split_distinct: bool = True
) -> DataFrame:
    """Script variant: no discount columns, no AOV, the rate is ``conversion_rate``."""
    full = monthly_kpis(events, session_count_mode, ordered=False, split_distinct=split_distinct)
    out = full.select(
        "month", "sessions", "users", "product_views", "cart_adds", "checkouts", "orders", "revenue",
        F.col("visit_to_order_rate").alias("conversion_rate"),
    )
    return out.orderBy(F.col("month").asc_nulls_last()) if ordered else out
