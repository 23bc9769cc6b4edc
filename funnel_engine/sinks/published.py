"""Outputs published together: a run's files become visible by one manifest.

A run writes its outputs into a staging folder. ``publish`` moves the files into the
outputs' folders, next to those of the run before, and then replaces the manifest, which
names the files of every output. Readers go by the manifest, so they see all outputs of
one run: a run that fails before leaves the old set as it was. Files that the manifest no
longer names are deleted afterwards, or by the next publication.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, list_files, move_file, read_text, replace_text

MANIFEST = "_published.json"


def published_files(spark: SparkSession, out_dir: str) -> dict[str, list[str]] | None:
    """File names of every published output; None if nothing has been published under ``out_dir``."""
    text = read_text(spark, f"{out_dir.rstrip('/')}/{MANIFEST}")
    return None if text is None else json.loads(text)["files"]


def publish(spark: SparkSession, staging: str, out_dir: str, run: str, names: Sequence[str]) -> None:
    """Make the staged outputs the published ones. ``run`` is a name that no earlier run has."""
    out = out_dir.rstrip("/")
    before = published_files(spark, out) or {}
    moves, files = [], {}
    for name in names:
        staged = [f for f, _, _ in list_files(spark, f"{staging}/{name}")]
        files[name] = [f"part-{run}-{f.removeprefix('part-')}" for f in staged]
        moves += [(f"{staging}/{name}/{a}", f"{out}/{name}/{b}") for a, b in zip(staged, files[name], strict=True)]
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(lambda m: move_file(spark, *m), moves))
        # Outputs that this run does not have stay published.
        kept = {**before, **files}
        replace_text(spark, f"{out}/{MANIFEST}", json.dumps({"run": run, "files": kept}, indent=1))
        old = [f"{out}/{name}/{f}" for name in kept for f, _, _ in list_files(spark, f"{out}/{name}") if f not in kept[name]]
        list(pool.map(lambda f: delete_path(spark, f), old))
    delete_path(spark, staging)


class OutputMemo:
    """Outputs read once: further reads list their files and scan nothing, until the files change.

    The small outputs are kept as local rows (they are bounded by stages, months, segments and
    campaigns), the customers as a persisted table of the cluster.
    """

    def __init__(self) -> None:
        self._kept: dict[tuple, tuple[list, DataFrame]] = {}

    def read(self, spark: SparkSession, out_dir: str, names: list[str], fmt: str = "parquet", schemas=None) -> dict[str, DataFrame]:
        from .writers import SMALL_OUTPUTS, read_outputs

        out = out_dir.rstrip("/")
        files = published_files(spark, out) or {}
        frames = {}
        for name in names:
            key = (spark.sparkContext.applicationId, out, name, fmt)
            listing = [f for f in list_files(spark, f"{out}/{name}") if name not in files or f[0] in files[name]]
            known = self._kept.get(key)
            if known is None or known[0] != listing:
                if known is not None:
                    known[1].unpersist()
                df = read_outputs(spark, out, [name], fmt, schemas)[name]
                df = spark.createDataFrame(df.collect(), df.schema) if name in SMALL_OUTPUTS else df.persist()
                known = self._kept[key] = (listing, df)
            frames[name] = known[1]
        return frames

    def forget(self) -> None:
        for _, df in self._kept.values():
            df.unpersist()
        self._kept.clear()
