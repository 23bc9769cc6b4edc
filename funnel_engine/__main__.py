"""Command line: run the batch pipeline.

    python -m funnel_engine --source sessions.csv --out /shared/out [--master local[8]] [--date-format dd/MM/yyyy]

The source defaults to the path in the environment override (see
``sources.ingest.source_path``). Prints the run summary when done.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def session(master: str | None) -> SparkSession.Builder:
    """Builder for the given master, used as it is; without one the platform's setting holds."""
    builder = SparkSession.builder.appName("funnel_engine")
    return builder if master is None else builder.master(master)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="funnel_engine", description="Run the funnel and retention batch pipeline.")
    p.add_argument("--source", default=None, help="session CSV (default: environment override or local path)")
    p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="parquet, or csv to add CSV copies of every output")
    p.add_argument("--master", default=None, help="Spark master, e.g. local[8], yarn or spark://host:port (default: the platform's)")
    p.add_argument("--date-format", action="append", default=None, help="pattern of the date column; repeat for several (default: ISO, or found from the data)")
    p.add_argument("--id-type", default="bigint", choices=["bigint", "string"], help="type of user and session ids")
    p.add_argument("--bad-ids", default="fail", choices=["fail", "null"], help="what a bigint id that does not parse does")
    p.add_argument("--multi-line", action="store_true", help="allow line ends inside quoted CSV fields")
    args = p.parse_args(argv)

    spark = session(args.master).getOrCreate()

    from .plans.pipeline import run

    outputs = run(
        spark, args.source, args.out, args.format, formats=args.date_format, id_type=args.id_type, bad_ids=args.bad_ids, multi_line=args.multi_line
    )
    for row in outputs["run_summary_lines"].toLocalIterator():
        print(row.value)
    report = outputs["cleaning_report"].first()
    print(f"Rows read: {report.rows:,}; dropped without a date: {report.undated_rows:,}; ids that did not parse: {report.bad_ids:,}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
