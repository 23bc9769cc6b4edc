"""Boundary semantics on the hand-computed micro fixture (FIXTURES §3, §4)."""

from __future__ import annotations

import datetime as dt

import pytest
from fixtures import dirty_raw, micro_raw

from funnel_engine import operators as ops
from funnel_engine.plans.base import funnel_events
from funnel_engine.sources.ingest import clean_sessions

EXPECTED = {
    # user: orders, days_to_second, days_since_last, d7, d14, d30, frequency, band
    1: (2, 7, 19, 1, 1, 1, 2.0, "Medium"),
    2: (2, 8, 48, 0, 1, 1, 2.0, "High"),
    3: (3, 30, 14, 0, 0, 1, 1.232877, "Low"),
    4: (2, 31, 86, 0, 0, 0, 1.935484, "High"),
    5: (1, None, 30, 0, 0, 0, 0.0, "Medium"),
    7: (2, 0, 31, 1, 1, 1, 2.0, "High"),
}


@pytest.fixture(scope="module")
def events(spark):
    df = funnel_events(clean_sessions(micro_raw(spark))).cache()
    yield df
    df.unpersist()


def test_customer_rows(events):
    rows = {r.user_id: r for r in ops.customer_retention_churn(events).collect()}
    assert set(rows) == set(EXPECTED)
    for user, (n, d2, since, r7, r14, r30, freq, band) in EXPECTED.items():
        r = rows[user]
        assert r.order_count == n
        assert r.days_to_second_order == d2
        assert r.days_since_last_order == since
        assert (r.retained_d7, r.retained_d14, r.retained_d30) == (r7, r14, r30)
        assert r.repeat_purchase_frequency == pytest.approx(freq, abs=1e-6)
        assert r.churn_risk == band
        assert r.customer_revenue == pytest.approx(100.0 * n)
    assert rows[7].second_order_date == dt.date(2025, 11, 26)
    assert rows[3].second_order_date == dt.date(2025, 10, 31)


def test_retention_summary(events):
    r = ops.retention_summary(ops.customer_retention_churn(events)).collect()[0]
    assert (r.purchasers, r.repeat_buyers) == (6, 5)
    assert r.d7_retention == pytest.approx(2 / 6)
    assert r.d14_retention == pytest.approx(3 / 6)
    assert r.d30_retention == pytest.approx(4 / 6)
    assert r.first_to_second_order_rate == pytest.approx(5 / 6)
    assert r.avg_repeat_purchase_frequency == pytest.approx(1.528060, abs=1e-6)
    assert (r.high_churn_risk_customers, r.high_churn_risk_rate) == (3, 0.5)


def test_order_sequence_matches_row_number(events):
    seq = {(r.user_id, r.session_id): r.order_number for r in ops.order_sequence(events).collect()}
    assert seq[(3, 5)] == 1 and seq[(3, 6)] == 2 and seq[(3, 7)] == 3
    assert seq[(7, 12)] == 1 and seq[(7, 13)] == 2
    assert len(seq) == 12


def test_customer_orders_as_of(events):
    rows = {r.user_id: r for r in ops.customer_retention_churn(events, as_of="2025-12-31").collect()}
    assert rows[1].days_since_last_order == 23


def test_retention_asof_script_variant(spark):
    raw = micro_raw(spark).selectExpr(
        "cast(user_id as bigint) user_id", "cast(session_id as bigint) session_id", "cast(date as date) date",
        "purchase_completed", "cast(revenue as double) revenue",
    )
    r = ops.retention_asof(raw, "2025-12-27").collect()[0]
    assert (r.purchasers, r.repeat_buyers) == (6, 5)
    assert r.d7_retention == pytest.approx(2 / 6)
    assert r.d30_retention == pytest.approx(4 / 6)
    assert r.high_churn_risk_rate == pytest.approx(3 / 6)


def test_churn_bands(events):
    bands = {r.churn_risk: r for r in ops.churn_bands(ops.customer_retention_churn(events)).collect()}
    assert bands["High"].customers == 3 and bands["Medium"].customers == 2 and bands["Low"].customers == 1
    assert bands["High"].avg_orders == pytest.approx(2.0)
    assert bands["Medium"].avg_days_since_last_order == pytest.approx((19 + 30) / 2)


def test_cleaning_rules(spark):
    clean = clean_sessions(dirty_raw(spark))
    assert clean.columns[0] == "user_id"
    rows = {r.user_id: r for r in clean.collect()}
    assert set(rows) == {1, 4}  # bad and empty dates dropped
    r = rows[1]
    assert r.month == "2025-07"  # recomputed from date
    assert r.revenue == 0.0 and r.order_value == 10.5
    assert (r.viewed_product_flag, r.added_to_cart_flag, r.checkout_started_flag) == (1, 1, 0)
    assert r.purchase_completed_flag == 0 and r.is_purchaser_session is False
    assert rows[4].channel is None  # null token
    assert rows[4].order_value == 0.0 and rows[4].revenue == 20.25
    base = {r.user_id: r for r in funnel_events(clean).collect()}
    assert (base[1].viewed_flag, base[1].cart_flag) == (0, 0)  # exact 'Yes' only
    assert base[1].event_date == dt.date(2025, 7, 1)


def test_zero_denominators(spark):
    from pyspark.sql import functions as F

    from funnel_engine.functions.expr import ratio, ratio_or_zero

    r = spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("a"), ratio_or_zero(F.lit(1), F.lit(0)).alias("b")).first()
    assert r.a is None and r.b == 0.0


def test_funnel_conversion_with_empty_stage(spark):
    from pyspark.sql import Row

    from funnel_engine.schema import BASE_FLAGS

    rows = [Row(**{f: v for f, v in zip(BASE_FLAGS, flags)}) for flags in [(1, 0, 0, 0, 0, 0), (1, 0, 1, 0, 0, 0)]]
    out = {r.stage_order: r for r in ops.funnel_summary(spark.createDataFrame(rows)).collect()}
    assert out[1].conversion_from_previous == 1.0
    assert out[2].sessions == 0 and out[2].conversion_from_previous == 0.0
    assert out[3].conversion_from_previous == 1.0  # previous stage 0 -> divide by itself
    assert out[5].conversion_from_previous is None


def test_missing_source(spark):
    from funnel_engine.sources.ingest import read_sessions

    with pytest.raises(FileNotFoundError, match="Source dataset not found"):
        read_sessions(spark, "/nonexistent/sessions.csv")


def test_dimension_guard(events):
    with pytest.raises(ValueError):
        ops.wallet_view(ops.segment_wallet_share(events), "nope")


def test_cleaning_with_date_formats(spark):
    from funnel_engine.schema import RAW_COLUMNS

    row = {c: "Yes" for c in RAW_COLUMNS}
    row.update(user_id="1", session_id="1", date="07/15/2025", month="x", channel="Email", order_value="5", revenue="5")
    raw = spark.createDataFrame([[row[c] for c in RAW_COLUMNS], [*(row[c] for c in RAW_COLUMNS[:2]), "2025-08-01", *(row[c] for c in RAW_COLUMNS[3:])]], RAW_COLUMNS)
    assert clean_sessions(raw).count() == 1  # default: ISO only
    out = clean_sessions(raw, formats=["MM/dd/yyyy", "yyyy-MM-dd"]).orderBy("date").collect()
    assert [r.month for r in out] == ["2025-07", "2025-08"]


def test_customers_ordered_by_user(events):
    ids = [r.user_id for r in ops.customer_retention_churn(events, ordered=True).collect()]
    assert ids == sorted(ids)
