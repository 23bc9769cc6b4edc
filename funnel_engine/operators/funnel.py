"""Funnel stage counts and the funnel summary.

The five stage sums come from ONE aggregate over the base table (one scan,
partial sums per task, a single-row final merge) and are turned into five rows
afterwards. The reference's ``LAG`` / ``FIRST_VALUE`` over the stage order are
evaluated on that single wide row: the previous stage is the previous column
and the entry stage is the first column, so no window exchange is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import ratio
from ..schema import STAGES
from .cells import FLAG_SUMS


def _stage_sums(events: DataFrame) -> DataFrame:
    return events.agg(*[F.sum(flag).cast("long").alias(f"_s{i}") for i, (_, flag, _) in enumerate(STAGES, 1)])


def _rows(sums: DataFrame, row_for) -> DataFrame:
    structs = [row_for(i, label) for i, (_, _, label) in enumerate(STAGES, 1)]
    return sums.select(F.inline(F.array(*structs)))


def stage_counts(events: DataFrame) -> DataFrame:
    """``stage_order, stage, sessions`` -- one row per funnel stage."""

    def row(i: int, label: str) -> Column:
        return F.struct(
            F.lit(i).alias("stage_order"),
            F.lit(label).alias("stage"),
            F.col(f"_s{i}").alias("sessions"),
        )

    return _rows(_stage_sums(events), row)


def conversion_from_previous(sessions: Column, previous: Column) -> Column:
    """Sessions over the previous stage; over itself when there is no
    previous stage or it is 0 (so the entry stage gives 1.0)."""
    return ratio(sessions, F.coalesce(F.nullif(previous, F.lit(0)), sessions))


def funnel_summary(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Stage counts with conversion from the previous stage, conversion from
    the entry stage and drop-off from the previous stage."""
    return _summary(_stage_sums(events), ordered)


def funnel_from_cells(cells: DataFrame, ordered: bool = True) -> DataFrame:
    """``funnel_summary`` from folded cells."""
    return _summary(cells.agg(*cell_stage_sums()), ordered)


def _stage_row(i: int, label: str) -> Column:
    s = F.col(f"_s{i}")
    prev = F.col(f"_s{i - 1}") if i > 1 else F.lit(None).cast("long")
    conv_prev = conversion_from_previous(s, prev)
    return F.struct(
        F.lit(i).alias("stage_order"),
        F.lit(label).alias("stage"),
        s.alias("sessions"),
        conv_prev.alias("conversion_from_previous"),
        ratio(s, F.col("_s1")).alias("conversion_from_visit"),
        (F.lit(1.0) - conv_prev).alias("dropoff_from_previous"),
    )


def _summary(sums: DataFrame, ordered: bool) -> DataFrame:
    out = _rows(sums, _stage_row)
    return out.orderBy("stage_order") if ordered else out


def cell_stage_sums() -> list[Column]:
    """Aggregates over cells, ``_s1`` to ``_s5``, that ``biggest_dropoff`` reads."""
    name = {flag: n for n, flag in FLAG_SUMS.items()}
    return [F.sum(name[flag]).cast("long").alias(f"_s{i}") for i, (_, flag, _) in enumerate(STAGES, 1)]


def biggest_dropoff() -> Column:
    """The stage that ``top_dropoff`` finds, within the one row of ``cell_stage_sums``."""
    rows = F.array(*[_stage_row(i, label) for i, (_, _, label) in enumerate(STAGES, 1)])
    ranked = F.transform(
        rows, lambda r: F.struct(r.dropoff_from_previous.isNull().alias("none"), (-r.dropoff_from_previous).alias("less"), r.stage_order, r.stage.alias("stage"))
    )
    return F.array_min(ranked).stage


def top_dropoff(funnel: DataFrame) -> DataFrame:
    """The stage with the largest drop-off from its previous stage (ties: earlier stage)."""
    return (
        funnel.orderBy(F.col("dropoff_from_previous").desc_nulls_last(), F.col("stage_order").asc())
        .limit(1)
        .select("stage_order", "stage", "dropoff_from_previous")
    )
