"""Additive sums of the session table, from its rows or from cells folded once.

``cells`` folds the base table, in one scan, to one row per month and combination of
the five dimensions, with every sum that the KPIs add up. Distinct users are made
additive too: sessions are first folded to one row per user and cell, and for each
grouping that counts users a user is counted in one of their cells of each group, the
first in key order. A group's distinct users are then the sum over its cells. The cells
are few, whatever the table's size, so a pipeline writes them once and builds all its
KPIs but the customers' from them.

A user with a third of all sessions is folded per task and then per cell, on all keys,
before the user's cells (at most one per combination) meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, money_terms, terms_sum
from ..schema import DIMENSIONS, DISCOUNT, STAGES

#: KPI name of each flag's sum.
FLAG_SUMS = dict(zip(["visits", "views", "carts", "checkouts", "orders"], [flag for _, flag, _ in STAGES], strict=True)) | {
    "discounted_sessions": DISCOUNT[1]
}
CELL_KEYS = ["month", *DIMENSIONS]
#: The cells' counts of users, each additive over the groups of its keys.
USER_COUNTS = {"users_all": [], "users_channel": ["channel"], "users_campaign": ["channel", "campaign_type"], "users_month": ["month"]} | {
    f"users_{d}": [d] for d in DIMENSIONS if d != "channel"
}
#: Groupings of the KPIs that count distinct users.
USER_SETS = [["month"], *[[d] for d in DIMENSIONS], ["channel", "campaign_type"], []]


def session_count(mode: str = "ids") -> Column:
    """Sessions as ``COUNT(session_id)`` (``'ids'``) or ``COUNT(*)`` (``'rows'``)."""
    if mode == "ids":
        return F.count("session_id")
    if mode == "rows":
        return F.count(F.lit(1))
    raise ValueError(f"session_count must be 'ids' or 'rows', got {mode!r}")


def event_sums(mode: str = "ids", names: Sequence[str] = tuple(FLAG_SUMS)) -> list[Column]:
    """Aggregates over base-table rows: sessions, the named flag sums and the two revenue terms."""
    return [session_count(mode).alias("sessions"), *[bigint_sum(FLAG_SUMS[n]).alias(n) for n in names], *money_terms("revenue")]


def cell_sums(mode: str = "ids", names: Sequence[str] = tuple(FLAG_SUMS)) -> list[Column]:
    """The same aggregates over cells."""
    return [bigint_sum({"ids": "session_ids", "rows": "session_rows"}[mode]).alias("sessions"), *[bigint_sum(n).alias(n) for n in names], *terms_sum()]


def cells(events: DataFrame, flagged: str | None = None) -> DataFrame:
    """One row per month and combination of dimensions: sums, first and last date and the additive user counts
    (``USER_COUNTS``). ``flagged`` names a further flag column, summed as ``flagged_orders``."""
    counts = {"session_ids": session_count("ids"), "session_rows": session_count("rows")}
    counts |= {n: bigint_sum(flag) for n, flag in FLAG_SUMS.items()} | ({"flagged_orders": bigint_sum(flagged)} if flagged else {})
    per_user = events.groupBy(*CELL_KEYS, "user_id").agg(
        *[c.alias(n) for n, c in counts.items()],
        *money_terms("revenue"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )
    # Every window below holds its users together, so this is the only move they need.
    per_user = per_user.repartition("user_id")
    for name, keys in USER_COUNTS.items():
        # Rows of nested key lists lie in one order, so that they share a sort.
        rest = [k for k in ["channel", "campaign_type", *CELL_KEYS] if k not in keys]
        first = F.row_number().over(Window.partitionBy("user_id", *keys).orderBy(*dict.fromkeys(rest))) == 1
        per_user = per_user.withColumn(name, (first & F.col("user_id").isNotNull()).cast("int"))
    return per_user.groupBy(*CELL_KEYS).agg(
        *[bigint_sum(n).alias(n) for n in [*counts, *USER_COUNTS]],
        *terms_sum(),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def _number(keys: Sequence[str]) -> int:
    """``grouping_id()`` of a set: a 1-bit for every cell key that is not in it, the first key highest."""
    return sum(1 << (len(CELL_KEYS) - 1 - i) for i, k in enumerate(CELL_KEYS) if k not in keys)


def distinct_users(events: DataFrame) -> DataFrame:
    """``set`` (grouping id), the cell keys and ``users`` for every grouping in ``USER_SETS``."""
    return (
        events.select(*CELL_KEYS, "user_id")
        .groupingSets(USER_SETS, *CELL_KEYS)
        .agg(F.grouping_id().alias("set"), F.countDistinct("user_id").alias("users"))
    )
