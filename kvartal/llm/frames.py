"""Small DataFrame helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: stands for a missing id where rows are joined by id
NO_ID = -(2**63)
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """The name, longer by underscores while a column of the table has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: int = 2**22) -> Iterator[None]:
    """Few rows and few bytes at a time between Spark and Python, for jobs run inside the block.

    Texts are long, and a thousand of the longest are more than a task can hold.
    """
    before = {name: spark.conf.get(name) for name in (BATCH_ROWS, BATCH_BYTES)}
    spark.conf.set(BATCH_ROWS, str(rows))
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def bounded_batches(spark: SparkSession, rows: int = 1000, size: int = 2**22) -> None:
    """Lower the session's bounds on what goes to Python at a time to those of ``small_batches``.

    For frames that run later, when a block of ``small_batches`` would have ended.
    """
    for name, most in ((BATCH_ROWS, rows), (BATCH_BYTES, size)):
        now = spark.conf.get(name).lower().rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:  # another unit is far more, none is no bound
            spark.conf.set(name, str(most))


def constant_array(numbers: list[int]) -> Column:
    """Whole numbers as one literal, quick to plan however many they are."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def place_of(value: Column, bounds: Column, most: int) -> Column:
    """How many of the ascending ``bounds`` (at most ``most``) are at or below the value.

    Binary search inside the expression, so the bounds may be many.
    """
    steps = [2**k for k in reversed(range(max(most, 1).bit_length()))]
    found = F.lit(0)
    for step in steps:
        found = _advanced(found, step, value, bounds)
    return found


def _advanced(found: Column, step: int, value: Column, bounds: Column) -> Column:
    return F.aggregate(
        F.array(F.lit(step)),
        found,
        lambda at, by: F.when(
            (at + by <= F.size(bounds)) & (F.get(bounds, at + by - 1) <= value), at + by
        ).otherwise(at),
    )
