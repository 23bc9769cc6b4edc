"""Invariants that hold for any input, checked on the test tables."""

from __future__ import annotations

import pytest
from conftest import SMOKE

from funnel_engine import operators as ops
from funnel_engine.plans.base import funnel_events
from funnel_engine.sources.testtables import sessions


@pytest.fixture(scope="module")
def events(spark):
    df = funnel_events(sessions(spark, SMOKE)).cache()
    yield df
    df.unpersist()


def test_totals_are_additive(events):
    ex = ops.executive_kpis(events).first()
    for df, key in [
        (ops.monthly_kpis(events), None),
        (ops.campaign_performance(events), None),
    ]:
        rows = df.collect()
        assert sum(r.sessions for r in rows) == ex.sessions
        assert sum(r.orders for r in rows) == ex.orders
        assert sum(r.revenue for r in rows) == pytest.approx(ex.revenue, rel=1e-12)
    seg = ops.segment_wallet_share(events).collect()
    for dim in {r.dimension for r in seg}:
        rows = [r for r in seg if r.dimension == dim]
        assert sum(r.sessions for r in rows) == ex.sessions
        assert sum(r.wallet_share for r in rows) == pytest.approx(1.0, abs=1e-12)
    camp = ops.campaign_performance(events).collect()
    assert sum(r.wallet_share for r in camp) == pytest.approx(1.0, abs=1e-12)


def test_users_not_additive(events):
    ex = ops.executive_kpis(events).first()
    monthly = ops.monthly_kpis(events).collect()
    assert sum(r.users for r in monthly) >= ex.users


def test_funnel_chain(events):
    rows = ops.funnel_summary(events).collect()
    assert [r.stage_order for r in rows] == [1, 2, 3, 4, 5]
    for prev, cur in zip(rows, rows[1:]):
        assert cur.conversion_from_previous == pytest.approx(cur.sessions / prev.sessions)
        assert cur.sessions <= prev.sessions


def test_retention_ordering(events):
    r = ops.retention_summary(ops.customer_retention_churn(events)).first()
    assert r.d7_retention <= r.d14_retention <= r.d30_retention <= r.first_to_second_order_rate


def test_grouping_sets_equal_union(events):
    from functools import reduce

    from funnel_engine.schema import DIMENSIONS

    rollup = ops.segment_rollup(events)
    parts = [ops.segment_rollup(events, [d]) for d in DIMENSIONS]
    union = reduce(lambda a, b: a.unionByName(b), parts)
    assert sorted(map(tuple, rollup.collect())) == sorted(map(tuple, union.collect()))


def test_customer_orders_match_order_sequence(events):
    seq = ops.order_sequence(events)
    from pyspark.sql import functions as F

    fold = seq.groupBy("user_id").agg(
        F.min(F.when(F.col("order_number") == 1, F.col("order_date"))).alias("first_order_date"),
        F.min(F.when(F.col("order_number") == 2, F.col("order_date"))).alias("second_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("order_count"),
    )
    co = ops.customer_orders(events).select(*fold.columns)
    assert sorted(map(tuple, fold.collect())) == sorted(map(tuple, co.collect()))


def test_split_and_combined_distinct_plans_agree(events):
    pairs = [
        (ops.monthly_kpis(events), ops.monthly_kpis(events, split_distinct=False)),
        (ops.segment_wallet_share(events), ops.segment_wallet_share(events, split_distinct=False)),
        (ops.campaign_performance(events), ops.campaign_performance(events, split_distinct=False)),
        (ops.executive_kpis(events), ops.executive_kpis(events, split_distinct=False)),
    ]
    for split, combined in pairs:
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, combined.collect()))
