"""Run summary: one typed row and its 12-line text rendering.

The row comes from the folded cells and the retention summary alone; nothing is
collected until the text is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bigint_sum, money_terms, money_text, money_value, pct_text, ratio, terms_sum
from ..operators.campaigns import KEYS as CAMPAIGN_KEYS
from ..operators.campaigns import campaign_rank
from ..operators.cells import FLAG_SUMS
from ..operators.funnel import biggest_dropoff, cell_stage_sums
from ..operators.grouping import sums_and_distinct
from ..schema import RETENTION_HORIZONS

TITLE = "Funnel Analytics Run Summary"
MISSING = "n/a"


def run_totals(clean: DataFrame) -> DataFrame:
    """Date range, sessions (rows), distinct users, case-insensitive orders, revenue."""
    agg = sums_and_distinct(
        clean,
        [],
        [
            F.min("date").alias("_min"),
            F.max("date").alias("_max"),
            F.count(F.lit(1)).alias("sessions"),
            bigint_sum("purchase_completed_flag").alias("orders"),
            *money_terms("revenue"),
        ],
    )
    return _totals(agg)


def _cell_totals() -> list[Column]:
    """``run_totals``'s aggregates over cells that have ``flagged_orders``."""
    return [
        F.min("first_date").alias("_min"),
        F.max("last_date").alias("_max"),
        # No rows, no cells: the counts are 0 then, as over the table.
        F.coalesce(bigint_sum("session_rows"), F.lit(0)).alias("sessions"),
        F.coalesce(bigint_sum("users_all"), F.lit(0)).alias("users"),
        bigint_sum("flagged_orders").alias("orders"),
        *terms_sum(),
    ]


def totals_from_cells(cells: DataFrame) -> DataFrame:
    """``run_totals`` from folded cells (with ``flagged_orders``)."""
    return _totals(cells.agg(*_cell_totals()))


def _total_columns() -> list[Column | str]:
    return [
        F.col("_min").cast("date").alias("start_date"),
        F.col("_max").cast("date").alias("end_date"),
        "sessions", "users", "orders",
        money_value().alias("revenue"),
        ratio("orders", "sessions").alias("visit_to_order_rate"),
    ]


def _totals(agg: DataFrame) -> DataFrame:
    return agg.select(*_total_columns())


def run_summary(cells: DataFrame, retention: DataFrame, horizons: Sequence[int] = RETENTION_HORIZONS) -> DataFrame:
    """One row: totals, retention rates, top campaign, biggest drop-off stage.

    Everything but the rates comes from one pass over the cells (with
    ``flagged_orders``): they are folded to campaigns, and one global aggregate of
    those gives the totals, the stage sums and, as the least rank, the top campaign.
    The one row of ``retention`` is attached as a scalar subquery.
    """
    rates = ["first_to_second_order_rate", *[f"d{h}_retention" for h in horizons]]
    campaigns = cells.groupBy(*CAMPAIGN_KEYS).agg(
        *[F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")],
        *[bigint_sum(c).alias(c) for c in ["session_rows", "users_all", "flagged_orders", *FLAG_SUMS]],
        *terms_sum(),
    )
    campaigns = campaigns.withColumn("revenue", money_value())
    pieces = campaigns.agg(*_cell_totals(), *cell_stage_sums(), F.min(campaign_rank()).alias("_t"))
    # The subquery enters one projection; the fields are read from its column.
    pieces = pieces.withColumn("_r", retention.select(F.struct(*rates).alias("r")).scalar())
    return pieces.select(
        *_total_columns(),
        *[F.col("_r").getField(c).alias(c) for c in rates],
        F.col("_t").getField("channel").alias("top_channel"),
        F.col("_t").getField("campaign_type").alias("top_campaign_type"),
        F.col("_t").getField("revenue").alias("top_campaign_revenue"),
        biggest_dropoff().alias("biggest_dropoff_stage"),
    )


def run_summary_lines(
    summary: DataFrame, source: str = "", title: str = TITLE, horizons: Sequence[int] = RETENTION_HORIZONS
) -> DataFrame:
    """The 12-line text report as ``line_no, value``, in order. A missing value shows as ``n/a``, so that no line is lost."""
    s = summary

    def line(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(MISSING)) for p in parts])

    retained = [x for h in horizons for x in (" / ", pct_text(s[f"d{h}_retention"]))][1:]
    lines = [
        line(title),
        line("Source: ", str(source)),
        line("Date range: ", s.start_date, " to ", s.end_date),
        line("Sessions: ", F.format_number(s.sessions, 0)),
        line("Users: ", F.format_number(s.users, 0)),
        line("Orders: ", F.format_number(s.orders, 0)),
        line("Revenue: ", money_text(s.revenue)),
        line("Visit-to-order conversion: ", pct_text(s.visit_to_order_rate)),
        line("First-to-second order rate: ", pct_text(s.first_to_second_order_rate)),
        line("/".join(f"D{h}" for h in horizons), " retention: ", *retained),
        line("Highest revenue campaign: ", s.top_channel, " - ", s.top_campaign_type, " (", money_text(s.top_campaign_revenue), ")"),
        line("Biggest funnel dropoff: ", s.biggest_dropoff_stage),
    ]
    rows = F.array(*[F.struct(F.lit(i).alias("line_no"), text.alias("value")) for i, text in enumerate(lines, 1)])
    return s.select(F.inline(rows)).orderBy("line_no")
