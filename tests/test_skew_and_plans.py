"""Skew handling and physical-plan shape."""

from __future__ import annotations

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F
from pyspark.sql import Window

from funnel_engine import operators as ops
from funnel_engine.plans.base import funnel_events
from funnel_engine.sources.testtables import sessions


def _skewed_events(spark, n=30000):
    """One user owns a third of all purchase rows, spread over many days."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).cast("long").alias("user_id"),
        (F.col("id") * 7 + 11).alias("session_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("event_date"),
        F.lit(1.5).alias("revenue"),
        F.lit(1).alias("order_flag"),
    )


def test_order_sequence_under_skew(spark):
    ev = _skewed_events(spark)
    got = ops.order_sequence(ev, num_partitions=8)
    want = ev.select(
        "user_id", "session_id",
        F.row_number().over(Window.partitionBy("user_id").orderBy("event_date", "session_id")).cast("long").alias("order_number"),
    )
    diff = got.select("user_id", "session_id", "order_number").exceptAll(want)
    assert diff.count() == 0
    assert got.count() == ev.count()


def _numbers(df):
    return df.select(
        "user_id", "session_id",
        F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("event_date").asc_nulls_last(), F.col("session_id").asc_nulls_last())).cast("long").alias("order_number"),
    )


def test_order_sequence_of_one_hot_day(spark):
    # One user's one day holds nearly everything; a few other days, users, unknown users, dates and sessions.
    ev = spark.range(200_000).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.lit(3)).cast("long").alias("user_id"),
        F.when(F.col("id") == 777, F.lit(None)).otherwise((F.col("id") - 60_000) * 3).alias("session_id"),
        F.when(F.col("id") % 90 == 5, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")))
        .when(F.col("id") % 90 == 7, F.lit(None).cast("date"))
        .otherwise(F.lit("2024-01-02").cast("date")).alias("event_date"),
        F.lit(1.5).alias("revenue"),
        F.lit(1).alias("order_flag"),
    )
    got = ops.order_sequence(ev)
    assert got.select("user_id", "session_id", "order_number").exceptAll(_numbers(ev)).count() == 0 and got.count() == 200_000
    # The hot day is cut into blocks of ids, each with a key of its own.
    blocks = ev.where("user_id = 3 AND event_date = '2024-01-02'").groupBy(F.shiftright("session_id", 16)).count().collect()
    assert len(blocks) >= 9 and max(r[1] for r in blocks) <= 1 << 16


def test_order_sequence_of_text_ids(spark):
    ev = _skewed_events(spark, 5000).withColumn("session_id", F.concat(F.lit("S"), F.col("session_id").cast("string")))
    got = ops.order_sequence(ev).select("user_id", "session_id", "order_number")
    assert got.exceptAll(_numbers(ev)).count() == 0 and got.count() == 5000


def test_order_sequence_is_lazy_and_moves_orders_once(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "order_sequence")
    plan = _plan(ops.order_sequence(_skewed_events(spark)))
    assert not jobs.getJobIdsForGroup("plan")
    spark.sparkContext.setJobGroup("other", "")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Orders, then the counts: per task and block, per user, back to blocks.
    assert len(exchanges) + plan.count("BroadcastExchange") == 4, plan
    assert "RangePartitioning" not in plan and "Checkpoint" not in plan and "Scan ExistingRDD" not in plan


def test_customer_orders_under_skew(spark):
    ev = _skewed_events(spark)
    co = {r.user_id: r for r in ops.customer_orders(ev).collect()}
    assert co[0].order_count == 10000
    assert co[0].second_order_date == co[0].first_order_date  # many orders on the first day


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return funnel_events(sessions(spark, SMOKE))


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _shuffles(tree: str) -> int:
    import re

    return len(re.findall(r"(?<!Broadcast)Exchange \(", tree))


def _tree(df) -> str:
    return _formatted(df).split("\n\n\n")[0]


def test_funnel_is_one_aggregate(events):
    plan = _tree(ops.funnel_summary(events, ordered=False))
    assert "Window" not in plan
    assert plan.count("Scan parquet") == 4  # orders, customer, nation, region: each once
    assert _shuffles(plan) == 1  # only the single-row final merge


def test_segments_grouping_sets(events):
    # sums and distinct pairs each read the input once (not once per dimension)
    plan = _tree(ops.segment_wallet_share(events))
    assert plan.count("Expand") == 2
    assert plan.count("Scan parquet") == 8


def test_distinct_shuffle_carries_only_keys(spark):
    import __spark_entry__ as entry

    plan = _formatted(entry.queries()["monthly_kpis"](spark, SMOKE))
    # the (month, user_id) de-duplication carries no aggregate buffers
    dedup = [b for b in plan.split("\n\n") if "HashAggregate" in b and "Keys [2]: [month" in b and "user_id" in b]
    assert dedup and all("Functions: []" in b for b in dedup)


def test_scan_prunes_columns(events):
    plan = _formatted(ops.monthly_kpis(events))
    orders_schema = [line for line in plan.splitlines() if line.strip().startswith("ReadSchema") and "o_orderkey" in line]
    assert orders_schema and "o_totalprice" in orders_schema[0]
    assert "o_comment" not in plan


def test_customer_window_reuses_partitioning(events):
    tree = _tree(ops.customer_orders(events))
    # (user, date) for the per-day fold, then user for the window; the final
    # per-user aggregate reuses the window's partitioning (no third exchange).
    above_window = tree.split("Window")[0]
    assert _shuffles(above_window) == 0
    assert _shuffles(tree) == 2


def test_campaign_share_single_pass(events):
    tree = _tree(ops.campaign_performance(events))
    assert tree.count("Scan parquet") == 8  # sums + distinct pairs; no third pass for the grand total
    assert tree.count("Window") == 1


def test_registered_queries_scan_written_table(spark):
    import __spark_entry__ as entry

    for name in ["monthly_kpis", "customer_retention_churn", "campaign_basic"]:
        plan = _formatted(entry.queries()[name](spark, SMOKE))
        assert "orders.parquet" not in plan and "customer.parquet" not in plan, name
        assert "funnel_tables" in plan, name


def test_purchase_filter_reaches_parquet(spark):
    import __spark_entry__ as entry

    plan = _formatted(entry.queries()["customer_orders"](spark, SMOKE))
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert any("purchase_completed" in line for line in pushed)


@pytest.mark.parametrize("name", ["top_campaign", "campaign_scatter", "kpi_strip", "monthly_long"])
def test_views_without_users_scan_once(spark, name):
    import __spark_entry__ as entry

    assert _tree(entry.queries()[name](spark, SMOKE)).count("Scan parquet") == 1


def test_wallet_view_groups_by_its_dimension_alone(spark):
    import __spark_entry__ as entry

    plan = _formatted(entry.queries()["wallet_view_device"](spark, SMOKE))
    assert all(d not in line for line in plan.splitlines() if line.startswith("ReadSchema") for d in ("channel", "region", "user_type"))
    expands = [b for b in plan.split("\n\n") if b.lstrip().split("\n")[0].find("Expand") >= 0 and "Arguments" in b]
    assert all(b.count("], [") == b.count("]], [") for b in expands)  # each row once: one projection


def test_month_selection_reaches_every_scan(spark):
    import __spark_entry__ as entry

    monthly = entry.queries()["monthly_kpis"](spark, SMOKE)
    plan = _formatted(ops.kpi_strip(monthly, ["1995-01", "1995-02"]))
    scans = [b for b in plan.split("\n\n") if "Scan parquet" in b and "ReadSchema" in b]
    assert scans and all("In(month, [1995-01,1995-02])" in b for b in scans), scans
