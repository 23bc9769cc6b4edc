"""End-to-end batch pipeline: CSV in, written outputs and run summary out."""

from __future__ import annotations

import os

import pytest
from fixtures import micro_raw

from funnel_engine.plans.pipeline import run
from funnel_engine.sinks.writers import load_table, read_outputs, write_outputs
from funnel_engine.sources.ingest import read_sessions, typed_sessions


@pytest.fixture()
def csv_source(spark, scratch_dir):
    path = os.path.join(scratch_dir, "raw_csv")
    micro_raw(spark).coalesce(1).write.option("header", True).csv(path)
    return path


def test_read_sessions_csv_all_text(spark, csv_source):
    raw = read_sessions(spark, csv_source)
    assert raw.count() == 13
    assert all(t == "string" for _, t in raw.dtypes)


def test_source_env_override(spark, csv_source, monkeypatch):
    monkeypatch.setenv("D2C_FUNNEL_DATA_PATH", csv_source)
    assert read_sessions(spark).count() == 13


def test_pipeline_outputs(spark, csv_source, scratch_dir):
    out = os.path.join(scratch_dir, "out")
    res = run(spark, csv_source, out)
    for name in [
        "clean_sessions", "funnel_summary", "monthly_growth_kpis", "segment_wallet_share",
        "campaign_performance", "customer_retention_churn", "retention_summary", "run_summary",
    ]:
        assert os.path.isdir(os.path.join(out, name)), name
    ret = res["retention_summary"].first()
    assert (ret.purchasers, ret.repeat_buyers) == (6, 5)
    funnel = res["funnel_summary"].orderBy("stage_order").collect()
    assert [r.sessions for r in funnel] == [13, 13, 12, 12, 12]
    lines = [r.value for r in res["run_summary_lines"].collect()]
    assert len(lines) == 12
    assert lines[0].endswith("Run Summary")
    assert lines[2] == "Date range: 2025-09-01 to 2025-12-27"
    assert lines[3] == "Sessions: 13"
    assert lines[5] == "Orders: 12"
    assert lines[6] == "Revenue: 1,200.00"
    assert lines[7] == "Visit-to-order conversion: 92.31%"
    assert lines[9] == "D7/D14/D30 retention: 33.33% / 50.00% / 66.67%"
    assert lines[10].startswith("Highest revenue campaign: ")
    assert lines[11] == "Biggest funnel dropoff: Cart Add"
    txt = [f for f in os.listdir(os.path.join(out, "run_summary_txt")) if f.startswith("part-")]
    assert txt
    back = read_outputs(spark, out)
    assert back["customer_retention_churn"].count() == 6


def test_write_outputs_and_load_table(spark, scratch_dir):
    df = typed_sessions(micro_raw(spark))
    assert dict(df.dtypes)["date"] == "date" and dict(df.dtypes)["revenue"] == "double"
    paths = write_outputs({"funnel_summary": df.limit(3)}, os.path.join(scratch_dir, "o"), fmt="csv")
    assert spark.read.option("header", True).csv(paths["funnel_summary"]).count() == 3
    load_table(df, "typed_sessions_t")
    load_table(df, "typed_sessions_t")
    assert spark.table("typed_sessions_t").count() == 26
    spark.sql("DROP TABLE typed_sessions_t")


def test_views(spark):
    from funnel_engine import operators as ops
    from funnel_engine.plans.base import funnel_events
    from funnel_engine.sources.ingest import clean_sessions

    events = funnel_events(clean_sessions(micro_raw(spark)))
    monthly = ops.monthly_kpis(events)
    strip = ops.kpi_strip(monthly, ["2025-12"]).first()
    assert (strip.sessions, strip.orders) == (4, 3)
    empty = ops.kpi_strip(monthly, ["1999-01"]).first()
    assert empty.visit_to_order_rate == 0.0 and empty.aov == 0.0
    with pytest.raises(ValueError):
        ops.require_rows(ops.select_months(monthly, ["1999-01"]))
    long = ops.monthly_long(monthly).collect()
    assert {r.metric for r in long} == {"sessions", "orders"} and len(long) == 8
    top = ops.top_campaigns(ops.campaign_performance(events), 1).collect()
    assert len(top) == 1


def test_dashboard_panels(spark, csv_source, scratch_dir):
    from funnel_engine.plans.dashboard import load_panels

    out = os.path.join(scratch_dir, "dash")
    run(spark, csv_source, out)
    p = load_panels(spark, out, months=["2025-11", "2025-12"], dimension="channel")
    strip = p["kpi_strip"].first()
    assert (strip.sessions, strip.orders) == (9, 8)
    text = p["kpi_strip_text"].first()
    assert text.revenue == "₹800" and text.visit_to_order == "88.9%"
    assert p["monthly_long"].count() == 4
    assert {r.segment for r in p["wallet_share"].collect()} == {"Paid Ads", "Organic"}
    assert p["churn_bands"].count() == 3
    with pytest.raises(ValueError):
        load_panels(spark, out, months=["1990-01"])


def test_cli(spark, csv_source, scratch_dir, capsys):
    from funnel_engine.__main__ import main

    assert main(["--source", csv_source, "--out", os.path.join(scratch_dir, "cli")]) == 0
    printed = capsys.readouterr().out.splitlines()
    assert printed[3] == "Sessions: 13"


def test_pipeline_csv_outputs(spark, csv_source, scratch_dir):
    out = os.path.join(scratch_dir, "csvout")
    res = run(spark, csv_source, out, fmt="csv")
    assert res["retention_summary"].first().purchasers == 6
    back = spark.read.option("header", True).csv(os.path.join(out, "csv", "funnel_summary"))
    assert back.count() == 5
    assert spark.read.option("header", True).csv(os.path.join(out, "csv", "clean_sessions")).count() == 13


def test_pipeline_on_test_tables_matches_oracle(spark, scratch_dir):
    from check_oracle import compare, duck
    from conftest import SMOKE

    from funnel_engine.oracle import pipeline_sql
    from funnel_engine.sources.testtables import dirty_sessions

    res = run(spark, dirty_sessions(spark, SMOKE), os.path.join(scratch_dir, "tt"))
    con = duck(SMOKE)
    for name, sql in pipeline_sql().items():
        ok, msg = compare(res[name].toPandas(), con.execute(sql).df())
        assert ok, f"{name}: {msg}"


def test_sql_views(spark):
    from funnel_engine.plans.base import register_kpi_views
    from funnel_engine.sources.ingest import typed_sessions

    register_kpi_views(typed_sessions(micro_raw(spark)))
    r = spark.sql("SELECT purchasers, repeat_buyers FROM retention_summary").first()
    assert (r.purchasers, r.repeat_buyers) == (6, 5)
    top = spark.sql("SELECT channel FROM campaign_performance ORDER BY revenue DESC LIMIT 1").first()
    assert top.channel == "Paid Ads"
    assert spark.sql("SELECT COUNT(*) AS n FROM funnel_events").first().n == 13


def test_copy_csv_into_typed_table(spark, scratch_dir):
    from funnel_engine.sinks.writers import copy_csv_into_table

    path = os.path.join(scratch_dir, "semicolon_csv")
    micro_raw(spark).coalesce(1).write.option("header", True).option("sep", ";").csv(path)
    copy_csv_into_table(spark, path, "copied_sessions", delimiter=";")
    t = spark.table("copied_sessions")
    assert t.count() == 13
    assert dict(t.dtypes)["date"] == "date" and dict(t.dtypes)["user_id"] == "bigint"
    spark.sql("DROP TABLE copied_sessions")
