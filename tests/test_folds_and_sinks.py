"""The one-scan fold, plans of the sinks, typed loads with rejects, date formats, publication and the memo of outputs."""

from __future__ import annotations

import json
import os

import pytest
from conftest import SMOKE
from fixtures import micro_raw
from pyspark.sql import functions as F
from test_lossless import _csv, _row

from funnel_engine import operators as ops
from funnel_engine.operators.campaigns import campaigns_from_cells
from funnel_engine.operators.cells import CELL_KEYS, USER_COUNTS, USER_SETS, cells, distinct_users
from funnel_engine.operators.funnel import funnel_from_cells
from funnel_engine.operators.monthly import monthly_from_cells
from funnel_engine.operators.segments import segments_from_cells
from funnel_engine.plans import pipeline
from funnel_engine.plans.base import funnel_events
from funnel_engine.sinks import published as pub
from funnel_engine.sinks.writers import copy_csv_into_table, read_outputs, single_partition
from funnel_engine.sources.ingest import DATE_FORMATS, clean_sessions, detect_formats, read_sessions
from funnel_engine.sources.testtables import gaps_from_sessions, sessions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def gaps(spark):
    """The test tables' events with NULL keys, dates and users."""
    return funnel_events(gaps_from_sessions(sessions(spark, SMOKE)))


# -- the fold -------------------------------------------------------------


def test_cells_count_users_as_distinct_counts_do(gaps):
    folded = cells(gaps).cache()
    want = distinct_users(gaps).collect()
    for name, keys in USER_COUNTS.items():
        number = sum(1 << (len(CELL_KEYS) - 1 - i) for i, k in enumerate(CELL_KEYS) if k not in keys)
        expect = {tuple(r[k] for k in keys): r.users for r in want if r.set == number}
        got = folded.groupBy(*keys).agg(F.sum(name).alias("n")).collect()
        assert {tuple(r[k] for k in keys): r.n for r in got} == expect, name
    assert sorted(map(sorted, USER_COUNTS.values())) == sorted(map(sorted, USER_SETS))
    folded.unpersist()


def test_kpis_from_cells_equal_the_direct_ones(gaps):
    folded = cells(gaps)
    assert _rows(monthly_from_cells(folded)) == _rows(ops.monthly_kpis(gaps))
    assert _rows(segments_from_cells(folded)) == _rows(ops.segment_wallet_share(gaps))
    assert _rows(segments_from_cells(folded, "rows")) == _rows(ops.segment_wallet_share(gaps, session_count_mode="rows"))
    assert _rows(campaigns_from_cells(folded)) == _rows(ops.campaign_performance(gaps))
    assert _rows(funnel_from_cells(folded)) == _rows(ops.funnel_summary(gaps))


def test_hot_user_and_unknown_users(spark):
    rows = [(0 if i % 3 == 0 else None if i % 3 == 1 else i, i, f"2025-{i % 4 + 1:02d}", f"c{i % 5}", f"t{i % 2}") for i in range(6000)]
    ev = spark.createDataFrame(rows, "user_id bigint, session_id bigint, month string, channel string, campaign_type string")
    ev = ev.select("*", *[F.lit("x").alias(c) for c in ("device", "region", "user_type")], F.lit("2025-01-01").cast("date").alias("event_date"))
    ev = ev.select("*", F.lit(1.5).alias("revenue"), *[F.lit(1).alias(f) for f in ("visited_flag", "viewed_flag", "cart_flag", "checkout_flag", "order_flag", "discount_flag")])
    assert _rows(monthly_from_cells(cells(ev))) == _rows(ops.monthly_kpis(ev))
    assert cells(ev).agg(F.sum("users_all")).first()[0] == 2001
    assert cells(ev.where("user_id IS NULL")).agg(F.sum("users_all")).first()[0] == 0


def test_fold_scans_once_and_moves_users_once(spark, scratch_dir):
    path = os.path.join(scratch_dir, "clean")
    clean_sessions(micro_raw(spark)).write.parquet(path)
    plan = _plan(pipeline.folds(spark.read.parquet(path))["cells"])
    assert plan.count("FileScan") == 1 and plan.count("REPARTITION_BY_COL") == 1
    assert plan.count("Exchange") == 3, plan  # per task and user cell, by user, cells
    # Nested groupings share one sort: all users, channel, and channel with campaign type.
    assert plan.count("Window") == len(USER_COUNTS) and plan.count("Sort ") == len(USER_COUNTS) - 2


def test_run_summary_scans_twice(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["run_summary"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2, plan  # cells and customers; no rate of the summary needs the analysis end


# -- sinks ----------------------------------------------------------------


def test_no_write_plan_merges_an_aggregate_into_one_task(spark, scratch_dir, monkeypatch):
    plans = {}
    real = pipeline.write_table

    def seen(df, path, fmt="parquet", mode="overwrite", single_file=False, order=()):
        plans[os.path.basename(path)] = _plan(single_partition(df, order) if single_file else df)
        real(df, path, fmt, mode, single_file, order)

    monkeypatch.setattr(pipeline, "write_table", seen)
    raw = os.path.join(scratch_dir, "raw")
    micro_raw(spark).write.parquet(raw)
    pipeline.run(spark, spark.read.parquet(raw), os.path.join(scratch_dir, "out"))
    assert {"cells", "customer_retention_churn", "run_summary", "monthly_growth_kpis"} <= set(plans)
    for name, plan in plans.items():
        assert "Coalesce" not in plan, name
        if name in ("cells", "monthly_growth_kpis", "segment_wallet_share", "campaign_performance"):
            above = plan.split("HashAggregate")[0]
            assert "Exchange RoundRobin" in above or "Exchange SinglePartition" in above, plan


def test_small_outputs_are_one_sorted_file(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    micro_raw(spark).write.parquet(raw)
    out = os.path.join(scratch_dir, "out")
    pipeline.run(spark, spark.read.parquet(raw), out)
    for name, key in [("monthly_growth_kpis", "month"), ("funnel_summary", "stage_order")]:
        files = [f for f in os.listdir(os.path.join(out, name)) if f.startswith("part-")]
        assert len(files) == 1
        got = [r[0] for r in spark.read.parquet(os.path.join(out, name)).select(key).collect()]
        assert got == sorted(got) and len(got) > 1
    text = [f for f in os.listdir(os.path.join(out, "run_summary_txt")) if f.startswith("part-")]
    with open(os.path.join(out, "run_summary_txt", text[0])) as f:
        assert [line.split(":")[0] for line in f][3:5] == ["Sessions", "Users"]


# -- typed loads ----------------------------------------------------------


def test_typed_load_converts_or_fails(spark, scratch_dir):
    path = _csv(scratch_dir, _row(user="1.0", session="2"), _row(user="", session="3", date=""))
    assert copy_csv_into_table(spark, path, "load_ok") == {"loaded": 2, "rejected": 0}
    assert [r.user_id for r in spark.table("load_ok").orderBy("session_id").collect()] == [1, None]
    for bad in (_row(user="U1"), _row(session="1.5"), _row(date="junk"), _row(revenue="ten")):
        with pytest.raises(Exception, match="is not a"):
            copy_csv_into_table(spark, _csv(scratch_dir, _row(), bad), "load_ok")
    assert spark.table("load_ok").count() == 2  # a failed load appends nothing
    spark.sql("DROP TABLE load_ok")


def test_typed_load_lists_rejects(spark, scratch_dir):
    path = _csv(scratch_dir, _row(session="1"), _row(user="U1", session="2", revenue="ten"), _row(session="3", date="junk"))
    got = copy_csv_into_table(spark, path, "load_some", on_error="reject")
    assert got == {"loaded": 1, "rejected": 2}
    assert [r.session_id for r in spark.table("load_some").collect()] == [1]
    listed = spark.table("load_some_rejects").collect()
    assert sorted((r.column, r.value) for r in listed) == [("date", "junk"), ("order_value", "ten"), ("revenue", "ten"), ("user_id", "U1")]
    assert all(r.reason == "does not convert" for r in listed)
    assert {json.loads(r.row)["session_id"] for r in listed} == {"2", "3"}
    spark.sql("DROP TABLE load_some")
    spark.sql("DROP TABLE load_some_rejects")


def test_typed_load_with_text_ids_and_formats(spark, scratch_dir):
    path = _csv(scratch_dir, _row(user="U1", session="S1", date="31/01/2025"))
    copy_csv_into_table(spark, path, "load_text", id_type="string", formats=["dd/MM/yyyy"])
    r = spark.table("load_text").first()
    assert (r.user_id, r.session_id, str(r.date)) == ("U1", "S1", "2025-01-31")
    spark.sql("DROP TABLE load_text")


# -- dates ----------------------------------------------------------------


def _dates(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "date string")


def test_formats_are_found_from_the_data(spark):
    assert detect_formats(_dates(spark, "2025-01-31", "junk", None)) == []
    assert detect_formats(_dates(spark)) == []
    assert detect_formats(_dates(spark, "31/01/2025", "01/02/2025", "")) == [DATE_FORMATS[0]]
    assert detect_formats(_dates(spark, "1/31/2025 8:05", "1/2/2025")) == [DATE_FORMATS[1]]
    assert detect_formats(_dates(spark, "05/05/2025")) == [DATE_FORMATS[0]]  # both read the same day
    assert detect_formats(_dates(spark, "31.01.2025")) == ["d.M.yyyy[ H:mm[:ss]]"]
    with pytest.raises(ValueError, match="ambiguous.*: 2.*: 2; 1 dates differ"):
        detect_formats(_dates(spark, "05/05/2025", "01/02/2025"))


def test_pipeline_keeps_rows_of_other_formats_without_a_flag(spark, scratch_dir):
    path = _csv(scratch_dir, *[_row(user=str(i), session=str(i), date=d) for i, d in enumerate(["31/01/2025", "01/02/2025", "gone", ""])])
    out = os.path.join(scratch_dir, "out")
    res = pipeline.run(spark, path, out)
    report = res["cleaning_report"].first()
    assert (report.rows, report.undated_rows) == (4, 2)
    assert [r.month for r in res["monthly_growth_kpis"].orderBy("month").collect()] == ["2025-01", "2025-02"]
    lost = res["rejected_values"].orderBy("value").collect()
    assert [(r.column, r.value, r.reason) for r in lost] == [("date", None, "missing"), ("date", "gone", "does not convert")]
    assert [json.loads(r.row)["session_id"] for r in lost] == ["3", "2"]
    # An empty list asks for ISO alone.
    res = pipeline.run(spark, path, out, formats=[])
    assert res["cleaning_report"].first().undated_rows == 4 == res["rejected_values"].count()


def test_report_counts_the_rejected_values(spark, scratch_dir):
    path = _csv(scratch_dir, _row(), _row(user="U1", session="2"), _row(session="x", date="2025-13-01"))
    res = pipeline.run(spark, path, os.path.join(scratch_dir, "out"), bad_ids="null")
    report, lost = res["cleaning_report"].first(), res["rejected_values"]
    assert report.undated_rows == lost.where("column = 'date'").count() == 1
    assert report.bad_ids == lost.where("column LIKE '%_id'").select("row").distinct().count() == 2


# -- publication and memo -------------------------------------------------


def test_failed_run_leaves_the_old_set(spark, scratch_dir, monkeypatch):
    raw = os.path.join(scratch_dir, "raw")
    micro_raw(spark).write.parquet(raw)
    out = os.path.join(scratch_dir, "out")
    pipeline.run(spark, spark.read.parquet(raw), out)
    before = {n: _rows(df) for n, df in read_outputs(spark, out).items()}
    twice = spark.read.parquet(raw).union(spark.read.parquet(raw))

    real, calls = pipeline.write_table, []

    def killed(df, path, *args, **more):
        calls.append(path)
        if path.endswith("campaign_performance"):
            raise RuntimeError("killed")
        real(df, path, *args, **more)

    monkeypatch.setattr(pipeline, "write_table", killed)
    with pytest.raises(RuntimeError, match="killed"):
        pipeline.run(spark, twice, out)
    assert len(calls) > 3  # some sinks of the failed run were written
    assert {n: _rows(df) for n, df in read_outputs(spark, out).items()} == before
    assert not [f for f in os.listdir(out) if f.startswith("_staging")]

    # Killed between the moves and the manifest: readers that go by it still see the old set.
    monkeypatch.setattr(pipeline, "write_table", real)
    monkeypatch.setattr(pub, "replace_text", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        pipeline.run(spark, twice, out)
    assert {n: _rows(df) for n, df in read_outputs(spark, out).items()} == before

    # The next run publishes its own set and clears what is left.
    monkeypatch.undo()
    pipeline.run(spark, twice, out)
    after = read_outputs(spark, out)
    assert after["monthly_growth_kpis"].agg(F.sum("sessions")).first()[0] == 26
    assert len([f for f in os.listdir(os.path.join(out, "funnel_summary")) if f.startswith("part-")]) == 1


def test_memo_scans_once_until_outputs_change(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    micro_raw(spark).write.parquet(raw)
    out = os.path.join(scratch_dir, "out")
    pipeline.run(spark, spark.read.parquet(raw), out)
    memo = pub.OutputMemo()
    names = ["monthly_growth_kpis", "customer_retention_churn"]
    first = memo.read(spark, out, names)
    assert first["customer_retention_churn"].count() == 6
    again = memo.read(spark, out, names)
    assert all(first[n] is again[n] for n in names)
    assert "FileScan" not in _plan(again["monthly_growth_kpis"])
    assert "InMemoryTableScan" in _plan(again["customer_retention_churn"])
    pipeline.run(spark, spark.read.parquet(raw).union(spark.read.parquet(raw)), out)
    new = memo.read(spark, out, names)
    assert new["monthly_growth_kpis"].agg(F.sum("sessions")).first()[0] == 26
    assert new["customer_retention_churn"].agg(F.sum("order_count")).first()[0] == 24
    memo.forget()


def test_memo_of_plain_folders(spark, scratch_dir):
    df = spark.createDataFrame([(1, "a")], "stage_order int, stage string")
    df.write.parquet(f"{scratch_dir}/funnel_summary")
    memo = pub.OutputMemo()
    assert memo.read(spark, scratch_dir, ["funnel_summary"])["funnel_summary"].count() == 1
    df.union(df).write.mode("overwrite").parquet(f"{scratch_dir}/funnel_summary")
    assert memo.read(spark, scratch_dir, ["funnel_summary"])["funnel_summary"].count() == 2
