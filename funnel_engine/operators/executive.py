"""Executive KPIs: one global aggregate over the base table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, money_terms, money_value, ratio
from .grouping import sums_and_distinct


def executive_kpis(events: DataFrame, split_distinct: bool = True) -> DataFrame:
    """sessions (``COUNT(*)``), distinct users, orders, revenue, visit-to-order rate, AOV."""
    agg = sums_and_distinct(
        events,
        [],
        [F.count(F.lit(1)).alias("sessions"), bigint_sum("order_flag").alias("orders"), *money_terms("revenue")],
        split=split_distinct,
    )
    revenue = money_value()
    return agg.select(
        "sessions", "users", "orders",
        revenue.alias("revenue"),
        ratio("orders", "sessions").alias("visit_to_order_rate"),
        ratio(revenue, "orders").alias("aov"),
    )
