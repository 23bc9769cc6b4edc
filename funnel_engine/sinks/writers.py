"""Table sinks: the clean-session table, the KPI outputs, typed bulk loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import OUTPUT_ORDER, OUTPUT_SCHEMAS
from .published import published_files

# KPI outputs whose row count is bounded by the number of stages, months,
# segments or campaigns: written as one file each. The per-customer table
# grows with the data and keeps its partitioning.
SMALL_OUTPUTS = {
    "funnel_summary",
    "monthly_growth_kpis",
    "segment_wallet_share",
    "campaign_performance",
    "retention_summary",
    "run_summary",
    "cleaning_report",
}


def _order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns]


def single_partition(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """``df`` in one partition. Its rows move there: unlike ``coalesce(1)``, that leaves an aggregation below parallel."""
    one = df.repartition(1)
    return one.sortWithinPartitions(*_order(order)) if order else one


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", single_file: bool = False, order: Sequence[str] = ()
) -> None:
    """Write a table; as a single file in the given order of columns (``-`` before a descending one) if asked to."""
    out = single_partition(df, order) if single_file else df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.save(path)


def write_outputs(outputs: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write every named output under ``out_dir/<name>``; returns the paths."""
    paths = {}
    for name, df in outputs.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        order = [c for c in OUTPUT_ORDER.get(name, []) if c.removeprefix("-") in df.columns]
        write_table(df, path, fmt=fmt, single_file=name in SMALL_OUTPUTS, order=order)
        paths[name] = path
    return paths


def read_outputs(
    spark: SparkSession,
    out_dir: str,
    names: list[str] | None = None,
    fmt: str = "parquet",
    schemas: Mapping[str, T.StructType | str] | None = None,
) -> dict[str, DataFrame]:
    """Read written outputs back: the published files if a pipeline run published some (see ``sinks.published``), else whole folders.

    CSV gets the outputs' schemas (``schema.OUTPUT_SCHEMAS``, or those given here)."""
    names = names or sorted(SMALL_OUTPUTS - {"run_summary", "cleaning_report"} | {"customer_retention_churn"})
    schemas = {**OUTPUT_SCHEMAS, **(schemas or {})}
    files = published_files(spark, out_dir) or {}
    frames = {}
    for name in names:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True).option("quote", '"').option("escape", '"')
            if name in schemas:
                reader = reader.schema(schemas[name])
        folder = f"{out_dir.rstrip('/')}/{name}"
        paths = [f"{folder}/{f}" for f in files[name]] if name in files else [folder]
        frames[name] = reader.load(paths) if paths else spark.createDataFrame([], schemas[name])
    return frames


def load_table(df: DataFrame, table: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Bulk load (typed) rows into a catalog table, creating it if needed."""
    df.write.mode(mode).format(fmt).saveAsTable(table)


def copy_csv_into_table(
    spark: SparkSession,
    path: str,
    table: str,
    delimiter: str = ",",
    mode: str = "append",
    on_error: str = "fail",
    rejects: str | None = None,
    formats: Sequence[str] | None = None,
    id_type: str = "bigint",
    multi_line: bool = False,
) -> dict[str, int]:
    """``COPY table FROM path (HEADER, DELIMITER d)`` into the typed session schema; returns ``loaded`` and ``rejected`` row counts.

    Empty fields are NULL. With ``on_error='fail'`` a value that does not convert fails
    the load and nothing is appended. With ``'reject'`` rows with such values stay out and
    are listed in the table ``rejects`` (default: ``<table>_rejects``), one row per value with
    its column, the reason and the whole row as JSON. No value becomes NULL in silence.
    """
    from ..sources.ingest import read_sessions, rejected_values, session_values, typed_sessions

    if on_error not in ("fail", "reject"):
        raise ValueError(f"on_error must be 'fail' or 'reject', got {on_error!r}")
    raw = read_sessions(spark, path, delimiter=delimiter, multi_line=multi_line)
    rejected = 0
    if on_error == "reject":
        values = session_values(raw, formats, null_tokens=("",), id_type=id_type)
        seen = Observation("rejects")
        bad = rejected_values(raw, values).observe(seen, F.count_if("first").alias("rows")).drop("first")
        load_table(bad, rejects or f"{table}_rejects", mode=mode)
        rejected = seen.get["rows"]
    good, count = typed_sessions(raw, formats, id_type=id_type, on_error=on_error), Observation("loaded")
    load_table(good.observe(count, F.count(F.lit(1)).alias("rows")), table, mode=mode)
    return {"loaded": count.get["rows"], "rejected": rejected}
