"""Per-customer order sequences, order folds and retention / churn columns.

Skew: one customer may own a large share of all orders, so no step puts all
of one customer's order rows into a single task.

* ``customer_orders`` never numbers individual orders. It first folds orders
  per ``(user_id, order_date)`` (map-side partial aggregation, shuffled on
  both keys, so a heavy customer is spread over tasks by day), and then runs a
  running count per customer over those per-day rows -- at most one row per
  calendar day per customer. The second order's date is the first day on which
  the running count reaches 2, exactly the date of ``ROW_NUMBER() = 2`` in the
  order (date, session).
* ``order_sequence`` (the explicit ``ROW_NUMBER``) numbers orders within the user, day
  and block of neighbouring session ids, hashed on all three, and adds the user's orders
  in earlier days and blocks: a running count over one row per user, day and block. A
  customer with a third of all orders is spread by day, and a day with very many by the
  blocks. The orders move once, nothing runs before the result is asked for, and a lost
  executor changes nothing, for no step depends on where rows happen to lie.
* The analysis end date reaches the customer rows as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import day_diff, flag_exact, money_terms, money_value, terms_sum
from ..schema import CHURN_DAYS, CHURN_LABELS, RETENTION_HORIZONS

# Session ids in a block of ``order_sequence``: of one user and day, so many meet in one task at most.
BLOCK_BITS = 16
BLOCK_CHARS = 8


def purchases(events: DataFrame, flag_col: str = "order_flag", date_col: str = "event_date") -> DataFrame:
    """Purchase sessions ``user_id, session_id, order_date, revenue`` (filter pushed to the scan)."""
    return events.where(F.col(flag_col) == 1).select(
        "user_id", "session_id", F.col(date_col).alias("order_date"), "revenue"
    )


def _block(session_id: str, kind: str) -> Column:
    """Neighbouring ids in one block, in order: ids that share all but the last ``BLOCK_BITS`` bits, texts their first ``BLOCK_CHARS`` characters."""
    if kind == "string":
        return F.substring(session_id, 1, BLOCK_CHARS)
    return F.shiftright(F.col(session_id).cast("long"), BLOCK_BITS)


def order_sequence(
    events: DataFrame,
    num_partitions: int | None = None,
    flag_col: str = "order_flag",
    date_col: str = "event_date",
) -> DataFrame:
    """Purchase rows numbered per customer by ``(order_date, session_id)``,
    NULLs last: ``user_id, session_id, order_date, revenue, order_number``.

    Lazy. ``num_partitions`` sets the partitions of the orders' one shuffle (default: the session's)."""
    orders = purchases(events, flag_col, date_col)
    block = _block("session_id", dict(orders.dtypes)["session_id"])
    # One struct as the key: its NULL fields are equal to each other, in a join too.
    orders = orders.withColumn("_k", F.struct("user_id", "order_date", block.alias("block")))
    per_block = orders.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy("_k.user_id")
        .orderBy(F.col("_k.order_date").asc_nulls_last(), F.col("_k.block").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = per_block.select(F.col("_k").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    moved = orders.repartition(num_partitions, "_k") if num_partitions else orders
    inside = F.row_number().over(Window.partitionBy("_k").orderBy(F.col("session_id").asc_nulls_last()))
    numbered = moved.withColumn("_at", inside).join(before, F.col("_k") == F.col("_b"))
    return numbered.select("user_id", "session_id", "order_date", "revenue", (F.col("_before") + F.col("_at")).cast("long").alias("order_number"))


def customer_orders(events: DataFrame, flag_col: str = "order_flag", date_col: str = "event_date") -> DataFrame:
    """Per customer: first, second and last order date, order count, revenue."""
    per_day = purchases(events, flag_col, date_col).groupBy("user_id", "order_date").agg(
        F.count(F.lit(1)).alias("_n"),
        *money_terms("revenue"),
    )
    running = Window.partitionBy("user_id").orderBy(F.col("order_date").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    per_day = per_day.withColumn("_cum", F.sum("_n").over(running))
    return per_day.groupBy("user_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.min(F.when(F.col("_cum") >= 2, F.col("order_date"))).alias("second_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("_n").cast("long").alias("order_count"),
        *terms_sum(),
    ).select(
        "user_id", "first_order_date", "second_order_date", "last_order_date", "order_count", money_value().alias("customer_revenue")
    )


def analysis_window(events: DataFrame, date_col: str = "event_date") -> DataFrame:
    """One row: ``analysis_end_date`` = the latest event date."""
    return events.agg(F.max(date_col).alias("analysis_end_date"))


def retained(days_to_second: Column, second: Column, horizon: int) -> Column:
    """1 if a second order exists 0..horizon days after the first (inclusive)."""
    return F.when(second.isNotNull() & days_to_second.between(0, horizon), F.lit(1)).otherwise(F.lit(0))


def churn_band(days_since_last: Column, churn_days: Sequence[int] = CHURN_DAYS) -> Column:
    low, medium = churn_days
    lo, mid, hi = CHURN_LABELS
    return (
        F.when(days_since_last <= low, F.lit(lo))
        .when(days_since_last <= medium, F.lit(mid))
        .otherwise(F.lit(hi))
    )


def repeat_purchase_frequency(order_count: Column, first: Column, last: Column) -> Column:
    """Orders per 30-day period between first and last order (periods at least 1); 0 for single buyers."""
    months = F.greatest(day_diff(first, last).cast("double") / F.lit(30.0), F.lit(1.0))
    return F.when(order_count > 1, order_count.cast("double") / months).otherwise(F.lit(0.0))


def customer_retention_churn(
    events: DataFrame,
    horizons: Sequence[int] = RETENTION_HORIZONS,
    churn_days: Sequence[int] = CHURN_DAYS,
    as_of=None,
    ordered: bool = False,
) -> DataFrame:
    """One row per purchasing customer with retention flags, purchase
    frequency and churn-risk band relative to the analysis end date (the
    latest event date, or ``as_of``). The end date is a scalar subquery: a
    one-row global aggregate evaluated once and attached to every customer
    row as a value, so no join is planned.
    """
    end = analysis_window(events).scalar() if as_of is None else F.lit(str(as_of)).cast("date")
    first, second, last = F.col("first_order_date"), F.col("second_order_date"), F.col("last_order_date")
    # The end date enters one projection only; later expressions read the column.
    co = customer_orders(events).withColumn("days_since_last_order", day_diff(last, end))
    to_second = day_diff(first, second)
    since_last = F.col("days_since_last_order")
    out = co.select(
        "user_id", "first_order_date", "last_order_date", "order_count", "customer_revenue", "second_order_date",
        to_second.alias("days_to_second_order"),
        since_last,
        F.when(F.col("order_count") > 1, F.lit(1)).otherwise(F.lit(0)).alias("repeat_buyer_flag"),
        *[retained(to_second, second, h).alias(f"retained_d{h}") for h in horizons],
        repeat_purchase_frequency(F.col("order_count"), first, last).alias("repeat_purchase_frequency"),
        churn_band(since_last, churn_days).alias("churn_risk"),
    )
    return out.orderBy(F.col("user_id").asc_nulls_last()) if ordered else out


def raw_purchases(sessions: DataFrame) -> DataFrame:
    """Raw session table with the exact-match purchase flag (script variant)."""
    return sessions.withColumn("_purchase", flag_exact("purchase_completed"))
