"""Spark session settings for local runs, tests and the bench.

On a cluster the session comes from the platform; only the settings below that
are unset there get filled in (see ``checkpoint_dir``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "funnel_engine") -> SparkSession:
    parts = shuffle_partitions or cpus
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a skewed join partition even when the join's output
        # partitioning is reused by the next aggregate (costs one shuffle).
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _located(spark: SparkSession, path: str):
    """The path and its file system, whatever that is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or written table."""
    p, fs = _located(spark, path)
    fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a written table when the driver ends."""
    p, fs = _located(spark, path)
    fs.deleteOnExit(p)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``name, length, modification time`` of a written table's data files, by name; none if it does not exist."""
    p, fs = _located(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; its folder is made if there is none."""
    a, fs = _located(spark, source)
    b, _ = _located(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    p, fs = _located(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file at once: readers see the old one or the whole new one."""
    new, fs = _located(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    new, old = fs.makeQualified(new), fs.makeQualified(_located(spark, path)[0])
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(new, old, options)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    Only when the session names none (local tests) is a scratch folder set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    path = tempfile.mkdtemp(prefix="funnel-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
