"""Segment rollup over several single-column groupings and wallet share.

All groupings come from ``GROUPING SETS`` (an ``Expand`` that emits each row
once per dimension, narrow projection only) instead of one aggregate per
dimension. The sums fold map-side to one row per segment and task; distinct
users shuffle only de-duplicated ``(segment, user_id)`` pairs (see
``grouping.sets_and_distinct``). The dimension label is decoded from
``grouping_id()``, so a genuinely NULL segment value stays its own group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, money_value, ratio
from ..schema import DIMENSIONS
from .cells import cell_sums, event_sums
from .grouping import sets_and_distinct

ROLLUP_COLUMNS = [
    "dimension", "segment", "sessions", "users", "views", "carts", "checkouts", "orders", "revenue",
    "discounted_sessions",
]
_SUMS = ["views", "carts", "checkouts", "orders", "discounted_sessions"]


def _labelled(agg: DataFrame, dims: Sequence[str], gid: str = "_gid") -> DataFrame:
    """Replace the dimension columns of grouping sets by ``dimension, segment``."""
    # grouping_id() has a 1-bit for every column NOT in the set (first column = highest bit).
    n = len(dims)
    number = {d: (2**n - 1) ^ (1 << (n - 1 - i)) for i, d in enumerate(dims)}
    dimension = F.lit(None).cast("string")
    segment = F.lit(None).cast("string")
    for d in reversed(dims):
        dimension = F.when(F.col(gid) == number[d], F.lit(d)).otherwise(dimension)
        segment = F.when(F.col(gid) == number[d], F.col(d)).otherwise(segment)
    return agg.select(dimension.alias("dimension"), segment.alias("segment"), *[c for c in agg.columns if c != gid and c not in dims])


def _rollup(events: DataFrame, dimensions: Sequence[str], session_count_mode: str, split: bool = True) -> DataFrame:
    dims = list(dimensions)
    if not dims:
        raise ValueError("at least one dimension is required")
    narrow = events.select(
        *[F.col(d).cast("string").alias(d) for d in dims],
        "user_id", "session_id", "viewed_flag", "cart_flag", "checkout_flag", "order_flag", "revenue", "discount_flag",
    )
    return _labelled(sets_and_distinct(narrow, dims, event_sums(session_count_mode, _SUMS), split=split), dims)


def segment_rollup(
    events: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    session_count_mode: str = "ids",
    split_distinct: bool = True,
) -> DataFrame:
    """``dimension, segment`` plus session, user, stage, order and revenue totals."""
    r = _rollup(events, dimensions, session_count_mode, split_distinct)
    return r.select(*[money_value().alias("revenue") if c == "revenue" else F.col(c) for c in ROLLUP_COLUMNS])


def _finish(rollup: DataFrame, ordered: bool) -> DataFrame:
    revenue = money_value()
    out = rollup.select(
        *[revenue.alias("revenue") if c == "revenue" else F.col(c) for c in ROLLUP_COLUMNS],
        ratio("orders", "sessions").alias("conversion_rate"),
        ratio("carts", "views").alias("view_to_cart_rate"),
        ratio("orders", "checkouts").alias("checkout_to_order_rate"),
        ratio(revenue, "orders").alias("aov"),
        ratio(revenue, money_value(over=Window.partitionBy("dimension"))).alias("wallet_share"),
    )
    if ordered:
        out = out.orderBy(F.col("dimension").asc_nulls_last(), F.col("revenue").desc_nulls_last(), F.col("segment").asc_nulls_last())
    return out


def segment_wallet_share(
    events: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    session_count_mode: str = "ids",
    ordered: bool = True,
    split_distinct: bool = True,
) -> DataFrame:
    """Rollup plus conversion, view-to-cart, checkout-to-order, AOV and the
    segment's share of its dimension's revenue.

    The share's denominator is a window partitioned by dimension over the
    already aggregated rollup (a handful of rows per dimension).
    """
    return _finish(_rollup(events, dimensions, session_count_mode, split_distinct), ordered)


def segments_from_cells(cells: DataFrame, session_count_mode: str = "ids", ordered: bool = True) -> DataFrame:
    """``segment_wallet_share`` over all dimensions from folded cells."""
    counts = [bigint_sum(f"users_{d}").alias(f"_users_{d}") for d in DIMENSIONS]
    sums = cells.groupingSets([[d] for d in DIMENSIONS], *DIMENSIONS).agg(F.grouping_id().alias("_gid"), *cell_sums(session_count_mode, _SUMS), *counts)
    rollup = _labelled(sums, DIMENSIONS)
    users = F.coalesce(*[F.when(F.col("dimension") == d, F.col(f"_users_{d}")) for d in DIMENSIONS])
    return _finish(rollup.withColumn("users", users), ordered)
