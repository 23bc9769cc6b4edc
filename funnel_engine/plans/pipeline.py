"""Batch pipeline: read -> clean -> base -> KPIs -> sinks -> run summary.

Materialisation points are written tables in the output folder (which must
be shared storage on a cluster). The cleaned session table is written once and
read three times: folded to cells (every additive sum and user count, see
``operators.cells``), folded per customer, and one column of it for the analysis
end. Everything else is built from those two results. Each written table cuts the
lineage, so a lost executor costs a re-read, not a re-run of the upstream plan.

Outputs are written into a staging folder and published together at the end (see
``sinks.published``), so readers never see outputs of two runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.campaigns import campaigns_from_cells
from ..operators.cells import cells
from ..operators.customers import customer_retention_churn
from ..operators.funnel import funnel_from_cells
from ..operators.monthly import monthly_from_cells
from ..operators.retention import retention_summary
from ..operators.segments import segments_from_cells
from ..schema import OUTPUT_ORDER, OUTPUT_SCHEMAS
from ..session import delete_path
from ..sinks.published import publish
from ..sinks.writers import read_outputs, single_partition, write_table
from ..sources.ingest import clean_sessions, detect_formats, read_sessions, rejected_values, session_values, source_path
from .base import funnel_events
from .report import run_summary, run_summary_lines

#: Outputs that grow with the data; the others are one file each.
BIG = ("clean_sessions", "customer_retention_churn", "rejected_values")


def folds(clean: DataFrame) -> dict[str, DataFrame]:
    """The two folds of the clean table that every output is built from."""
    events = funnel_events(clean, keep=["purchase_completed_flag"])
    return {
        "cells": cells(events, flagged="purchase_completed_flag"),
        # sorted by user at the sink (range-partitioned sort; one row per user, so no hot key)
        "customer_retention_churn": customer_retention_churn(events, ordered=True),
    }


def _clean(raw: DataFrame, path: str, formats: Sequence[str] | None, id_type: str, bad_ids: str) -> tuple[tuple[int, int, int], Sequence[str]]:
    """Write the clean table; its counts (rows, undated rows, bad ids) and the date formats that were used.

    Without given formats dates are read as ISO. Only if that leaves some undated, the
    formats that fit are sought, and the table is written again if there are any.
    """

    def write(patterns: Sequence[str]) -> tuple[int, int, int]:
        seen = Observation("cleaning")
        write_table(clean_sessions(raw, patterns, id_type=id_type, bad_ids=bad_ids, observation=seen), path)
        return seen.get["rows"], seen.get["undated_rows"], seen.get["bad_ids"]

    counts = write(formats or ())
    if formats is None and counts[1] and (formats := detect_formats(raw)):
        counts = write(formats)
    return counts, formats or ()


def run(
    spark: SparkSession,
    source: str | DataFrame | None,
    out_dir: str,
    fmt: str = "parquet",
    formats: Sequence[str] | None = None,
    id_type: str = "bigint",
    bad_ids: str = "fail",
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """Run the whole batch and return the published outputs as DataFrames.

    ``formats`` are the date patterns of the source (an empty list: ISO alone; by default
    they are found from the data where ISO does not fit), ``id_type`` and ``bad_ids`` its ids
    (see ``clean_sessions``). The output ``cleaning_report`` counts the rows read, the undated
    rows dropped and the ids that did not parse; ``rejected_values`` holds those values and
    their rows.
    """
    out = out_dir.rstrip("/")
    generation = uuid.uuid4().hex
    staging = f"{out}/_staging-{generation}"
    raw = source if isinstance(source, DataFrame) else read_sessions(spark, source, multi_line=multi_line)
    label = "<DataFrame>" if isinstance(source, DataFrame) else source_path(source)

    def write_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        # Independent outputs: submitted as concurrent Spark jobs, so small jobs share the cores.
        with ThreadPoolExecutor(max_workers=len(frames)) as pool:
            futures = [
                pool.submit(write_table, df, f"{staging}/{name}", "parquet", "overwrite", name not in BIG, OUTPUT_ORDER.get(name, ()))
                for name, df in frames.items()
            ]
            for f in futures:
                f.result()
        return {name: spark.read.parquet(f"{staging}/{name}") for name in frames}

    try:
        # The clean table is the pipeline's materialisation point: always Parquet
        # (typed, prunable); ``fmt='csv'`` adds CSV copies of every output at the end.
        counts, used = _clean(raw, f"{staging}/clean_sessions", formats, id_type, bad_ids)
        clean = spark.read.parquet(f"{staging}/clean_sessions")
        if counts[1] or counts[2]:
            values = session_values(raw, used, id_type=id_type, numbers=False)
            rejected = rejected_values(raw, values, required=["date"]).drop("first")
        else:
            rejected = spark.createDataFrame([], OUTPUT_SCHEMAS["rejected_values"])

        base = write_all({**folds(clean), "rejected_values": rejected})
        folded, customers = base["cells"], base["customer_retention_churn"]
        small = {
            "funnel_summary": funnel_from_cells(folded, ordered=False),
            "monthly_growth_kpis": monthly_from_cells(folded, ordered=False),
            "segment_wallet_share": segments_from_cells(folded, ordered=False),
            "campaign_performance": campaigns_from_cells(folded, ordered=False),
            "retention_summary": retention_summary(customers),
            "cleaning_report": spark.createDataFrame([counts], OUTPUT_SCHEMAS["cleaning_report"]),
        }
        result = {"clean_sessions": clean, **base, **write_all(small)}
        result |= write_all({"run_summary": run_summary(folded, result["retention_summary"])})
        lines = run_summary_lines(result["run_summary"], label)
        single_partition(lines, OUTPUT_ORDER["run_summary_txt"]).select("value").write.mode("overwrite").text(f"{staging}/run_summary_txt")

        csv = ["clean_sessions", *small, "customer_retention_churn", "rejected_values", "run_summary"] if fmt == "csv" else []
        for name in csv:
            write_table(result[name], f"{staging}/csv/{name}", "csv", single_file=name not in BIG, order=OUTPUT_ORDER.get(name, ()))
    except BaseException:
        delete_path(spark, staging)
        raise
    if csv:
        publish(spark, f"{staging}/csv", f"{out}/csv", generation, csv)
    publish(spark, staging, out, generation, [*result, "run_summary_txt"])
    outputs = read_outputs(spark, out, list(result))
    return {**outputs, "run_summary_lines": run_summary_lines(outputs["run_summary"], label).select("value")}
