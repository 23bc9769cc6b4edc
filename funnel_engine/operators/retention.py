"""Retention summaries (global aggregates over the customer table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, ratio
from ..schema import CHURN_LABELS, RETENTION_HORIZONS, SCRIPT_AS_OF
from .customers import customer_orders, raw_purchases


def retention_summary(
    customers: DataFrame, horizons: Sequence[int] = RETENTION_HORIZONS, avg_digits: int | None = None
) -> DataFrame:
    """purchasers, repeat buyers, first-to-second rate, dN retention, average
    purchase frequency and the high-churn-risk count and rate.

    The average adds up doubles, so its last digits depend on the order in which
    partial sums meet; ``avg_digits`` rounds it where results are compared."""
    average = F.avg("repeat_purchase_frequency")
    high = F.when(F.col("churn_risk") == F.lit(CHURN_LABELS[2]), F.lit(1)).otherwise(F.lit(0))
    agg = customers.agg(
        F.count(F.lit(1)).alias("purchasers"),
        bigint_sum("repeat_buyer_flag").alias("repeat_buyers"),
        *[bigint_sum(f"retained_d{h}").alias(f"_r{h}") for h in horizons],
        (average if avg_digits is None else F.round(average, avg_digits)).alias("avg_repeat_purchase_frequency"),
        bigint_sum(high).alias("high_churn_risk_customers"),
    )
    return agg.select(
        "purchasers",
        "repeat_buyers",
        ratio("repeat_buyers", "purchasers").alias("first_to_second_order_rate"),
        *[ratio(f"_r{h}", "purchasers").alias(f"d{h}_retention") for h in horizons],
        "avg_repeat_purchase_frequency",
        "high_churn_risk_customers",
        ratio("high_churn_risk_customers", "purchasers").alias("high_churn_risk_rate"),
    )


def retention_asof(
    sessions: DataFrame,
    as_of: str = SCRIPT_AS_OF,
    horizons: Sequence[int] = RETENTION_HORIZONS,
    churn_after_days: int = 30,
) -> DataFrame:
    """Script variant over the raw table: purchases by exact ``'Yes'``, the
    raw ``date``, a fixed analysis date; dN = share of customers whose second
    order is within N days of the first; high churn = more than
    ``churn_after_days`` days from the last order to ``as_of``."""
    co = customer_orders(raw_purchases(sessions), flag_col="_purchase", date_col="date")
    first, second = F.col("first_order_date"), F.col("second_order_date")
    end = F.lit(str(as_of)).cast("date")
    agg = co.agg(
        F.count(F.lit(1)).alias("purchasers"),
        bigint_sum(F.when(F.col("order_count") > 1, F.lit(1)).otherwise(F.lit(0))).alias("repeat_buyers"),
        *[
            bigint_sum(F.when(second <= F.date_add(first, h), F.lit(1)).otherwise(F.lit(0))).alias(f"_r{h}")
            for h in horizons
        ],
        bigint_sum(
            F.when(F.datediff(end, F.col("last_order_date")) > churn_after_days, F.lit(1)).otherwise(F.lit(0))
        ).alias("_high"),
    )
    return agg.select(
        "purchasers",
        "repeat_buyers",
        ratio("repeat_buyers", "purchasers").alias("first_to_second_order_rate"),
        *[ratio(f"_r{h}", "purchasers").alias(f"d{h}_retention") for h in horizons],
        ratio("_high", "purchasers").alias("high_churn_risk_rate"),
    )
