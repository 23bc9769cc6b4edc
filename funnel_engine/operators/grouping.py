"""Group-bys that combine plain sums with a distinct count.

Spark plans ``COUNT(DISTINCT user_id)`` next to ordinary aggregates by first
grouping on ``(keys, user_id)`` and carrying every partial sum through that
shuffle -- roughly one entry per input row, each with all sum buffers
(including an exact decimal). Here the two are computed separately:

* the sums fold map-side to a few rows per task (one per group), and
* the distinct count shuffles only ``(keys, user_id)`` pairs, after a
  map-side de-duplication,

and the two small results are combined per group key by a union and a
final group-by (``max`` of each column: every group has exactly one row from
each side). A group-by treats a NULL key as one group, and a filter on the
keys (a month selection, a dimension) is pushed through the union and both
aggregates into both scans -- a NULL-safe join would block that inference.
The input is read twice, so it should be a table scan (the pipeline's written
base table), not an expensive lazy plan; ``split=False`` gives Spark's
combined one-read plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL matches NULL; the keys appear once."""
    renamed = right.select(*[F.col(k).alias(f"_rk{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_rk{i}"]) for i, k in enumerate(keys)])
    return left.join(renamed, cond).drop(*[f"_rk{i}" for i in range(len(keys))])


def combine_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from two frames that each hold one row per key and
    disjoint value columns (NULL keys match NULL keys)."""
    keys = list(keys)
    values = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def sums_and_distinct(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    distinct: str = "user_id",
    alias: str = "users",
    split: bool = True,
) -> DataFrame:
    """``GROUP BY keys`` with ``aggs`` plus ``COUNT(DISTINCT distinct) AS alias``.

    With no keys this is a global aggregate; the distinct count is attached
    as a scalar subquery. ``split=False`` uses Spark's combined plan (one read
    of ``df``), for inputs that are expensive to compute twice."""
    keys = list(keys)
    if not split:
        return df.groupBy(*keys).agg(*aggs, F.countDistinct(distinct).alias(alias))
    if not keys:
        return df.agg(*aggs).withColumn(alias, df.agg(F.countDistinct(distinct)).scalar())
    sums = df.groupBy(*keys).agg(*aggs)
    users = df.select(*keys, distinct).groupBy(*keys).agg(F.countDistinct(distinct).alias(alias))
    return combine_on_keys(sums, users, keys)


def sets_and_distinct(
    df: DataFrame,
    dims: Sequence[str],
    aggs: Sequence[Column],
    distinct: str = "user_id",
    alias: str = "users",
    gid: str = "_gid",
    split: bool = True,
) -> DataFrame:
    """``GROUPING SETS ((d1), (d2), ...)`` with ``aggs`` and a distinct count;
    each row carries ``grouping_id()`` as ``gid``."""
    dims = list(dims)
    sets = [[d] for d in dims]
    if not split:
        return df.groupingSets(sets, *dims).agg(F.grouping_id().alias(gid), *aggs, F.countDistinct(distinct).alias(alias))
    sums = df.groupingSets(sets, *dims).agg(F.grouping_id().alias(gid), *aggs)
    users = (
        df.select(*dims, distinct)
        .groupingSets(sets, *dims)
        .agg(F.grouping_id().alias(gid), F.countDistinct(distinct).alias(alias))
    )
    return combine_on_keys(sums, users, [gid, *dims])
