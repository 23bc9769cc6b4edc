"""Campaign matrix (channel x campaign type) and its script variant.

The share of total revenue is ``SUM(SUM(revenue)) OVER ()``: a window over the
already grouped rows (one per channel x campaign type pair), so the grouped
aggregate is computed once. (A separately computed one-row total would be
column-pruned differently from the grouped branch, defeating exchange reuse,
and re-run the whole scan and aggregation.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, flag_exact, money_terms, money_value, ratio
from .cells import cell_sums, event_sums
from .grouping import sums_and_distinct

KEYS = ["channel", "campaign_type"]
_SUMS = ["carts", "checkouts", "orders", "discounted_sessions"]


def share_of_total(grouped: DataFrame, money: str = "_revenue", out_col: str = "wallet_share") -> DataFrame:
    """Attach ``value / SUM(value) OVER ()`` to an aggregated frame (two-term total, double ratio)."""
    return grouped.withColumn(out_col, ratio(money_value(money), money_value(money, Window.partitionBy())))


def _order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("revenue").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in KEYS])


def _finish(grouped: DataFrame, ordered: bool) -> DataFrame:
    shared = share_of_total(grouped)
    revenue = money_value()
    out = shared.select(
        *KEYS, "sessions", *[c for c in ["users"] if c in grouped.columns], "carts", "checkouts", "orders",
        revenue.alias("revenue"),
        "discounted_sessions",
        ratio("orders", "sessions").alias("conversion_rate"),
        ratio(revenue, "sessions").alias("revenue_per_session"),
        ratio("discounted_sessions", "sessions").alias("discount_usage_rate"),
        "wallet_share",
    )
    return _order(out) if ordered else out


def campaign_performance(events: DataFrame, ordered: bool = True, split_distinct: bool = True, users: bool = True) -> DataFrame:
    """Per channel and campaign type; ``users=False`` leaves the distinct count out, and with it the second read."""
    aggs = event_sums("ids", _SUMS)
    grouped = sums_and_distinct(events, KEYS, aggs, split=split_distinct) if users else events.groupBy(*KEYS).agg(*aggs)
    return _finish(grouped, ordered)


def campaigns_from_cells(cells: DataFrame, ordered: bool = True) -> DataFrame:
    """``campaign_performance`` from folded cells."""
    return _finish(cells.groupBy(*KEYS).agg(*cell_sums("ids", _SUMS), bigint_sum("users_campaign").alias("users")), ordered)


def campaign_rank(revenue: str = "revenue") -> Column:
    """A struct whose least value is the top campaign's: most revenue (NaN above all, null last), then the keys, null last."""
    value = F.col(revenue)
    keys = [x for k in KEYS for x in (F.col(k).isNull().alias(f"no_{k}"), F.col(k))]
    return F.struct(value.isNull().alias("none"), (~F.isnan(value)).alias("number"), (-value).alias("less"), *keys, value.alias(revenue))


def campaign_basic(sessions: DataFrame, ordered: bool = True, split_distinct: bool = True) -> DataFrame:
    """Script variant over the raw table: sessions = ``COUNT(*)``, orders from
    the raw purchase text, conversion, revenue per session, wallet share."""
    grouped = sums_and_distinct(
        sessions,
        KEYS,
        [F.count(F.lit(1)).alias("sessions"), bigint_sum(flag_exact("purchase_completed")).alias("orders"), *money_terms("revenue")],
        split=split_distinct,
    )
    shared = share_of_total(grouped)
    revenue = money_value()
    out = shared.select(
        *KEYS, "sessions", "users", "orders",
        revenue.alias("revenue"),
        ratio("orders", "sessions").alias("conversion_rate"),
        ratio(revenue, "sessions").alias("revenue_per_session"),
        "wallet_share",
    )
    return _order(out) if ordered else out
