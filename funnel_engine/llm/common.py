"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from funnel_engine.session import checkpoint_dir, delete_at_exit, delete_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Words are runs of anything but ASCII white space (``bytes.split()`` splits alike).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their own shuffle files when they are done: nothing reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def collected(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables that operators write inside, when it ends; write results before that."""
    paths: list[str] = []
    token = _WRITTEN.set(paths)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in paths:
            delete_path(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back.

    Cuts the lineage with a table that survives the loss of an executor. The table
    goes with the surrounding ``collected``, else when the driver ends.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    if written is None:
        delete_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch where the session has Spark's default of 10,000, whose whole texts fill tens of MB on either side.
BATCH_ROWS = 1_000


def prepare_workers(spark: SparkSession) -> None:
    """Settings that the Python functions of this package need.

    Workers unpickle them by name, so they must find the package from any working
    directory; and batches of long texts must be smaller than Spark's default.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, env.get("PYTHONPATH")]))


def map_columns(
    df: DataFrame,
    make: Callable[[], Callable[..., list]],
    schema: str | T.StructType,
    rows: int = 512,
) -> DataFrame:
    """Run ``make()`` once per task and call it with the columns of at most ``rows`` rows at a time.

    The function gets one Python list per column of ``df`` and returns one list
    (or Arrow array) per column of ``schema``. Its ``finish`` attribute, if it has
    one, is called when the task ends.
    """
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                got = call(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(got, arrow, strict=True)],
                    schema=arrow,
                )
        # Workers live on after a task: give its memory back.
        getattr(call, "finish", lambda: None)()
        pa.default_memory_pool().release_unused()

    prepare_workers(df.sparkSession)
    return df.mapInArrow(run, out)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that they clash with no name given beside it; ``select('<its name>.*')`` restores them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def rewrite_text(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """``df`` with the texts of one column replaced; all other columns pass as they are."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in _parts(batches):
            columns = batch.columns
            columns[at] = pa.array(call(columns[at].to_pylist()), columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    prepare_workers(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def keep_texts(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of ``df`` whose texts the function keeps."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in _parts(batches):
            yield batch.filter(pa.array(call(batch.column(at).to_pylist()), pa.bool_()))

    prepare_workers(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the whole text, null texts as empty ones; other columns are never read."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
