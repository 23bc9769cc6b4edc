"""Randomised check of the order numbering and the customer fold against a
brute-force pandas implementation of ROW_NUMBER (nulls last) + conditional MIN."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from funnel_engine import operators as ops

ROW = st.tuples(
    st.one_of(st.none(), st.integers(1, 4)),  # user_id (nullable, few users -> heavy groups)
    st.one_of(st.none(), st.integers(0, 6)),  # day offset (nullable date)
    st.integers(0, 1),  # purchase flag
    st.integers(0, 500),  # revenue in cents
)


def _frame(spark, rows):
    base = dt.date(2025, 1, 1)
    data = [
        (u, i + 1, None if d is None else base + dt.timedelta(days=d), f, c / 100.0)
        for i, (u, d, f, c) in enumerate(rows)
    ]
    schema = "user_id BIGINT, session_id BIGINT, event_date DATE, order_flag INT, revenue DOUBLE"
    return spark.createDataFrame(data, schema), pd.DataFrame(data, columns=["user_id", "session_id", "event_date", "order_flag", "revenue"])


def _brute(pdf: pd.DataFrame):
    o = pdf[pdf.order_flag == 1].copy()
    o["_u"] = o.user_id.map(lambda x: -1 if pd.isna(x) else int(x))
    o["_d"] = o.event_date.map(lambda d: (0, d) if d is not None else (1, dt.date.min))
    o = o.sort_values(["_u", "_d", "session_id"], key=lambda s: s if s.name != "_d" else s.map(lambda x: x))
    o["order_number"] = o.groupby("_u").cumcount() + 1
    seq = {(None if pd.isna(r.user_id) else int(r.user_id), int(r.session_id)): int(r.order_number) for r in o.itertuples()}
    fold = {}
    for u, g in o.groupby("_u"):
        first = g[g.order_number == 1].event_date.dropna()
        second = g[g.order_number == 2].event_date.dropna()
        key = None if u == -1 else int(u)
        fold[key] = (
            first.iloc[0] if len(first) else None,
            second.iloc[0] if len(second) else None,
            max([d for d in g.event_date if d is not None], default=None),
            len(g),
        )
    return seq, fold


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=40))
def test_sequence_and_fold(spark, rows):
    sdf, pdf = _frame(spark, rows)
    want_seq, want_fold = _brute(pdf)
    got_seq = {(r.user_id, r.session_id): r.order_number for r in ops.order_sequence(sdf, num_partitions=3).collect()}
    assert got_seq == want_seq
    got_fold = {
        r.user_id: (r.first_order_date, r.second_order_date, r.last_order_date, r.order_count)
        for r in ops.customer_orders(sdf).collect()
    }
    assert got_fold == want_fold
