"""Cutting lineage through tables in the cluster's shared folder.

Frames that later steps read more than once (totals, ranks, grids, splits) are written
once and read back. The fact is then scanned a single time, the re-read prunes columns,
its size is known from file footers, and a lost executor costs no recomputation.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a local session may go without."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    # local-cluster has executors with folders of their own, like any other cluster
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
    folder = tempfile.mkdtemp(prefix="orderloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, grouped by application so that a run can be removed."""
    run = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{run}/{label}-{uuid.uuid4().hex}"


# Paths stored in the innermost open scope of this thread.
_OPEN = threading.local()


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a frame to the shared folder, packed as the session says or by `codec`, and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=codec)
    stored = spark.read.schema(df.schema).parquet(path)
    if getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.append(path)
        stored._scratch_path = path
    return stored


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete stored tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The paths of what is stored inside the block; those that inner scopes remove are not among them."""
    outer = getattr(_OPEN, "paths", None)
    paths = _OPEN.paths = []
    try:
        yield paths
    finally:
        _OPEN.paths = outer


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end of the block what was stored inside, but for frames passed to the given function.

    Frames that outlive the block must read kept tables alone. These belong to the scope
    around this one, if there is any.
    """
    kept: list[str] = []

    def keep(stored: DataFrame) -> DataFrame:
        kept.append(stored._scratch_path)
        return stored

    with recorded_scratch() as paths:
        try:
            yield keep
        finally:
            remove(spark, [p for p in paths if p not in kept])
    if getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.extend(kept)
