"""Values that must survive: small, huge and odd money, any ids, quoted text, dates with offsets."""

from __future__ import annotations

import datetime
import math
import os

import pytest
from fixtures import micro_raw
from pyspark.sql import functions as F

from funnel_engine import __main__ as cli
from funnel_engine import operators as ops
from funnel_engine.functions.expr import money_terms, money_value
from funnel_engine.plans.base import funnel_events
from funnel_engine.plans.pipeline import folds, run
from funnel_engine.plans.report import run_summary_lines, run_totals, totals_from_cells
from funnel_engine.sinks.writers import read_outputs
from funnel_engine.sources.ingest import clean_sessions, parse_number, parse_timestamp, read_sessions

COLUMNS = (
    "user_id,session_id,date,month,channel,campaign_type,device,user_type,region,visited_website,viewed_product,"
    "added_to_cart,checkout_started,purchase_completed,discount_applied,order_value,revenue"
)


def _csv(folder: str, *rows: str) -> str:
    path = os.path.join(folder, "sessions.csv")
    with open(path, "w") as f:
        f.write("\n".join([COLUMNS, *rows]) + "\n")
    return path


def _row(user="1", session="1", date="2025-01-05", channel="Ads", kind="EU", revenue="10", bought="Yes") -> str:
    return f"{user},{session},{date},,{channel},{kind},Mobile,New,North,Yes,Yes,Yes,Yes,{bought},No,{revenue},{revenue}"


def _total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "m double")
    return df.agg(*money_terms("m", "_m")).select(money_value("_m")).first()[0]


def test_small_huge_and_odd_money(spark):
    assert math.isclose(_total(spark, [0.0004] * 10_000), 4.0, rel_tol=1e-12)
    assert _total(spark, [math.inf, 1e26, 5.0]) == math.inf
    assert _total(spark, [1e26, 5.0]) == 1e26
    assert _total(spark, [0.1] * 10) == 1.0
    assert math.isnan(_total(spark, [math.nan, 1.0]))
    assert _total(spark, [None, 2.5]) == 2.5
    assert _total(spark, [None, None]) is None


def test_small_money_reaches_every_kpi(spark, scratch_dir):
    rows = [_row(user=str(i % 7), session=str(i), date=f"2025-01-{i % 28 + 1:02d}", revenue="0.0004") for i in range(700)]
    ev = funnel_events(clean_sessions(read_sessions(spark, _csv(scratch_dir, *rows))))
    want = 0.28
    assert math.isclose(ops.executive_kpis(ev).first().revenue, want, rel_tol=1e-9)
    assert math.isclose(ops.monthly_kpis(ev).first().revenue, want, rel_tol=1e-9)
    assert math.isclose(ops.campaign_performance(ev).first().revenue, want, rel_tol=1e-9)
    seg = ops.segment_wallet_share(ev).where("dimension = 'device'").first()
    assert math.isclose(seg.revenue, want, rel_tol=1e-9) and seg.wallet_share == 1.0
    customers = ops.customer_retention_churn(ev)
    assert math.isclose(customers.agg(F.sum("customer_revenue")).first()[0], want, rel_tol=1e-9)
    assert math.isclose(ops.churn_bands(customers).agg(F.sum("revenue")).first()[0], want, rel_tol=1e-9)
    assert math.isclose(ops.kpi_strip(ops.monthly_kpis(ev, users=False)).first().revenue, want, rel_tol=1e-9)


def test_quoted_fields(spark, scratch_dir):
    path = _csv(scratch_dir, _row(channel='"Paid ""Ads"", EU"'))
    got = clean_sessions(read_sessions(spark, path)).first()
    assert (got.channel, got.campaign_type, got.revenue) == ('Paid "Ads", EU', "EU", 10.0)


def test_line_end_in_quotes_needs_multi_line(spark, scratch_dir):
    path = _csv(scratch_dir, _row(channel='"Paid\nAds"'), _row(session="2"))
    got = read_sessions(spark, path, multi_line=True)
    assert got.count() == 2 and got.orderBy("session_id").first().channel == "Paid\nAds"
    with pytest.raises(Exception, match="MALFORMED"):
        read_sessions(spark, path).collect()


@pytest.mark.parametrize("row", ["1,2,3", _row() + ",more"])
def test_ragged_rows_fail(spark, scratch_dir, row):
    with pytest.raises(Exception, match="MALFORMED"):
        read_sessions(spark, _csv(scratch_dir, _row(), row)).select("user_id").collect()


def test_text_ids(spark, scratch_dir):
    rows = [_row(user=f"U{i % 5}", session=f"S{i}") for i in range(1, 11)]
    raw = read_sessions(spark, _csv(scratch_dir, *rows))
    ev = funnel_events(clean_sessions(raw, id_type="string"))
    k = ops.executive_kpis(ev).first()
    assert (k.users, k.orders) == (5, 10)
    assert ops.monthly_kpis(ev).first().sessions == 10
    assert ops.customer_retention_churn(ev).count() == 5
    with pytest.raises(Exception, match="not an integer"):
        clean_sessions(raw).collect()
    assert clean_sessions(raw, bad_ids="null").where("user_id IS NULL").count() == 10


def test_integral_ids_with_a_fraction(spark, scratch_dir):
    raw = read_sessions(spark, _csv(scratch_dir, _row(user="7.0", session="12.00"), _row(user="", session="13")))
    got = clean_sessions(raw).orderBy("session_id").collect()
    assert [(r.user_id, r.session_id) for r in got] == [(7, 12), (None, 13)]


def test_dates(spark):
    df = spark.createDataFrame([(x,) for x in ["2025-01-31T23:30:00-05:00", "2025-01-31 23:30:00Z", "2025-01-31", "31/01/2025", "12:30", None]], "d string")
    day = lambda f: [r[0] for r in df.select(parse_timestamp(F.col("d"), f).cast("date")).collect()]
    want = datetime.date(2025, 1, 31)
    assert day(None) == [want, want, want, None, None, None]
    assert day(["dd/MM/yyyy"]) == [None, None, None, want, None, None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert day(None)[:3] == [want, want, want]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_plain_numbers_only(spark):
    df = spark.createDataFrame([(x,) for x in ["5d", "7f", "5D ", "1e3", "-2.5", "inf", "Infinity", "x", None]], "n string")
    assert [r[0] for r in df.select(parse_number(F.col("n"))).collect()] == [None, None, None, 1000.0, -2.5, math.inf, math.inf, None, None]


def test_pipeline_formats_ids_and_report(spark, scratch_dir):
    rows = [_row(user=f"U{i}", session=f"S{i}", date=d) for i, d in enumerate(["31/01/2025", "01/02/2025", "gone"])]
    out = os.path.join(scratch_dir, "out")
    res = run(spark, _csv(scratch_dir, *rows), out, fmt="csv", formats=["dd/MM/yyyy"], id_type="string")
    report = res["cleaning_report"].first()
    assert (report.rows, report.undated_rows, report.bad_ids) == (3, 1, 0)
    assert [r.month for r in res["monthly_growth_kpis"].orderBy("month").collect()] == ["2025-01", "2025-02"]
    back = read_outputs(spark, f"{out}/csv", ["monthly_growth_kpis", "segment_wallet_share", "retention_summary"], fmt="csv")
    for name, df in back.items():
        assert df.dtypes == res[name].dtypes
        assert sorted(map(str, df.collect())) == sorted(map(str, res[name].collect()))


def test_pipeline_scans_the_clean_table_three_times(spark, scratch_dir):
    micro_raw(spark).write.parquet(os.path.join(scratch_dir, "raw"))
    path = os.path.join(scratch_dir, "clean")
    clean_sessions(spark.read.parquet(os.path.join(scratch_dir, "raw"))).write.parquet(path)
    scans = 0
    for name, df in folds(spark.read.parquet(path)).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        # The customers' analysis end is a scalar subquery: a scan of one column.
        assert plan.count("FileScan") == (2 if name == "customer_retention_churn" else 1), plan
        scans += plan.count("FileScan")
    assert scans == 3


def test_totals_from_cells_equal_totals(spark):
    clean = clean_sessions(micro_raw(spark))
    base = folds(clean)
    got, want = totals_from_cells(base["cells"]), run_totals(clean)
    assert got.collect() == want.select(got.columns).collect()
    none = clean.where("false")
    base = folds(none)
    assert totals_from_cells(base["cells"]).first().users == 0


def test_report_keeps_lines_with_missing_values(spark):
    row = {c: None for c in ["start_date", "end_date", "top_channel", "top_campaign_type", "biggest_dropoff_stage"]}
    df = spark.range(1).select(
        *[F.lit(v).cast("string").alias(c) for c, v in row.items()],
        *[F.lit(3).cast("long").alias(c) for c in ["sessions", "users", "orders"]],
        *[F.lit(0.5).alias(c) for c in ["revenue", "visit_to_order_rate", "first_to_second_order_rate", "d7_retention", "top_campaign_revenue"]],
    )
    lines = [r.value for r in run_summary_lines(df, "x", horizons=[7]).collect()]
    assert len(lines) == 12 and None not in lines
    assert lines[9] == "D7 retention: 50.00%"
    assert lines[10] == "Highest revenue campaign: n/a - n/a (0.50)"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local[*]", "local[3]"])
def test_master_is_used_as_given(master):
    builder = cli.session(master)
    try:
        assert builder._options["spark.master"] == master
    finally:
        builder._options.pop("spark.master", None)


def test_customers_counted_once_each(spark):
    rows = [(1, "Low", 5.0, 1, 2), (1, "Low", 5.0, 1, 2), (2, "Low", 1.0, 1, 4)]
    df = spark.createDataFrame(rows, "user_id bigint, churn_risk string, customer_revenue double, order_count bigint, days_since_last_order bigint")
    assert ops.churn_bands(df).first().customers == 2


def test_written_tables_are_deleted(spark):
    import __spark_entry__ as entry
    from conftest import SMOKE

    scan = entry.queries()["funnel_events"](spark, SMOKE).inputFiles()
    entry.forget(spark)
    assert scan and not any(os.path.exists(f.removeprefix("file://")) for f in scan)
