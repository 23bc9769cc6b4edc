"""Randomised check of the split sums / distinct-count aggregates (NULL keys
included) against a brute-force pandas group-by."""

from __future__ import annotations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from funnel_engine import operators as ops
from funnel_engine.schema import DIMENSIONS

VAL = st.one_of(st.none(), st.sampled_from(["a", "b"]))
ROW = st.tuples(
    st.one_of(st.none(), st.integers(1, 5)),  # user_id
    VAL, VAL, VAL, VAL, VAL,  # the five dimensions
    st.one_of(st.none(), st.sampled_from(["2025-01", "2025-02"])),  # month
    st.integers(0, 1),  # order flag
    st.integers(0, 999),  # revenue cents
)
SCHEMA = (
    "user_id BIGINT, channel STRING, campaign_type STRING, device STRING, region STRING, user_type STRING, "
    "month STRING, order_flag INT, revenue DOUBLE"
)


def _events(spark, rows):
    data = [(u, *dims, m, f, c / 100.0) for (u, *dims, m, f, c) in rows]
    df = spark.createDataFrame(data, SCHEMA)
    df = df.selectExpr(
        "*", "monotonically_increasing_id() AS session_id", "1 AS viewed_flag", "order_flag AS cart_flag",
        "order_flag AS checkout_flag", "0 AS discount_flag",
    )
    cols = ["user_id", "channel", "campaign_type", "device", "region", "user_type", "month", "order_flag", "revenue"]
    return df, pd.DataFrame(data, columns=cols)


def _key(v):
    return None if v is None or (isinstance(v, float) and pd.isna(v)) else v


def _brute(pdf: pd.DataFrame, key: str):
    out = {}
    for k, g in pdf.groupby(pdf[key].map(lambda v: "<null>" if _key(v) is None else v)):
        users = {u for u in g.user_id if _key(u) is not None}
        out[None if k == "<null>" else k] = (len(g), len(users), int(g.order_flag.sum()), round(g.revenue.sum(), 2))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=30))
def test_rollup_and_monthly(spark, rows):
    sdf, pdf = _events(spark, rows)
    got = {}
    for r in ops.segment_rollup(sdf).collect():
        got[(r.dimension, r.segment)] = (r.sessions, r.users, r.orders, round(r.revenue, 2))
    want = {(d, k): v for d in DIMENSIONS for k, v in _brute(pdf, d).items()}
    assert got == want
    got_m = {r.month: (r.sessions, r.users, r.orders, round(r.revenue, 2)) for r in ops.monthly_kpis(sdf).collect()}
    assert got_m == _brute(pdf, "month")
    ex = ops.executive_kpis(sdf).first()
    assert (ex.sessions, ex.users) == (len(pdf), len({u for u in pdf.user_id if _key(u) is not None}))


def test_null_keys_without_broadcast_or_aqe(spark):
    """NULL group keys stay their own group when nothing is broadcast and AQE
    is off (the plan shape at cluster scale)."""
    rows = [
        (1, None, "a", "a", "a", "a", None, 1, 100),
        (2, None, "b", "a", None, "a", "2025-01", 0, 0),
        (2, "a", None, None, "a", None, "2025-01", 1, 250),
        (None, "a", "a", "b", "b", "b", None, 1, 50),
        (3, "b", "b", "b", None, None, "2025-02", 0, 0),
    ]
    sdf, pdf = _events(spark, rows)
    saved = {k: spark.conf.get(k) for k in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rollup = ops.segment_rollup(sdf)
        got = {(r.dimension, r.segment): (r.sessions, r.users, r.orders, round(r.revenue, 2)) for r in rollup.collect()}
        got_m = {r.month: (r.sessions, r.users, r.orders, round(r.revenue, 2)) for r in ops.monthly_kpis(sdf).collect()}
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert got == {(d, k): v for d in DIMENSIONS for k, v in _brute(pdf, d).items()}
    assert got_m == _brute(pdf, "month")
