"""Tables written between two passes over the same rows.

A staged table is read back from the shared folder, so a lost executor costs a
re-read and not a new run of everything before it, and two passes over it are
certain to see the same rows. It is columnar, so the second pass reads only the
columns it needs, and its real size is known when the next join is planned.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: smaller than the default, at little more time; these tables hold whole texts
COMPRESSION = "zstd"

RANGE_BYTES = "spark.sql.files.maxPartitionBytes"

_open_scope: ContextVar[list[str] | None] = ContextVar("staged_paths", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read and write, as named by the session.

    Only a local master that names none, whose executors are this very process, gets a
    temporary one of its own; a cluster without a folder is refused.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="kvartal-"))
    return context.getCheckpointDir()


def staged_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/staged/{label}-{uuid.uuid4().hex}"
    opened = _open_scope.get()
    if opened is not None:
        opened.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and go on from the written table."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def file_ranges(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Jobs inside the block read files in ranges of so many bytes."""
    before = spark.conf.get(RANGE_BYTES)
    if size is not None:
        spark.conf.set(RANGE_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(RANGE_BYTES, before)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the tables staged inside the block when it ends.

    Frames that read them are only good inside the block, so write results there.
    Without the block staged tables stay until the shared folder is cleared.
    """
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)
