"""Positions in a global or per-key order, without one task seeing all rows.

A window without partition columns, or with a hot key, puts its rows through a
single task. The functions here number inside bounded slices and add the number
of rows in the slices before, which is a sum over one small row per slice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from kvartal.sources.staging import stage

# The function below travels with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = "_slice"
BEFORE = "_before"


def range_sliced(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Staged copy cut into consecutive ranges of ``order``, NULLs first.

    The slice number is stored with the row, so later passes agree on the cut.
    """
    keys = [F.col(name).asc_nulls_first() for name in order]
    return stage(
        df.repartitionByRange(*keys).withColumn(SLICE, F.spark_partition_id()), label
    )


def _before(sliced: DataFrame, weight: Column) -> DataFrame:
    """Per slice, the summed weight of all slices before it; one row per slice."""
    sums = sliced.groupBy(SLICE).agg(F.sum(weight).alias("_weight"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(SLICE, F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias(BEFORE))


def number_distinct(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number distinct rows 1, 2, 3, ... by ``order``, NULLs first.

    The number depends on the rows alone, so a second load gives the same keys.
    """
    sliced = range_sliced(df, order, name)
    inside = Window.partitionBy(SLICE).orderBy(*(F.col(c).asc_nulls_first() for c in order))
    # one row per slice: at most as many as the shuffle has partitions
    offsets = F.broadcast(_before(sliced, F.lit(1)))
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, SLICE)
        .select((F.col("_inside") + F.col(BEFORE)).cast("int").alias(name), *df.columns)
    )


def number_within(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows of each key 1, 2, 3, ... in no particular order.

    Rows are numbered inside (key, input slice), so a key that holds a third of
    the table is spread over as many tasks as the table has slices.
    """
    sliced = stage(df.withColumn(SLICE, F.spark_partition_id()), name)
    counts = sliced.groupBy(key, SLICE).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (
        Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        F.col(key).alias("_key"),
        F.col(SLICE).alias("_its_slice"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(BEFORE),
    )
    inside = Window.partitionBy(key, SLICE).orderBy(key)
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(
            offsets,
            F.col(key).eqNullSafe(F.col("_key")) & (F.col(SLICE) == F.col("_its_slice")),
        )
        .select(*df.columns, (F.col("_inside") + F.col(BEFORE)).alias(name))
    )


def _opens_run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Whether a value is not that of the row before it; NULL is like NULL."""
    before = None
    for values in batches:
        if not len(values):
            yield pa.array([], pa.bool_())
            continue
        head = values.slice(0, 1) if before is None else before
        earlier = pa.concat_arrays([head, values.slice(0, len(values) - 1)])
        unlike = pc.coalesce(pc.not_equal(values, earlier), pc.xor(values.is_null(), earlier.is_null()))
        if before is None:
            unlike = pa.concat_arrays([pa.array([True]), unlike.slice(1)])
        before = values.slice(len(values) - 1, 1)
        yield unlike


def first_in_partition(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row by ``order`` of each key among the rows of its partition, without a shuffle.

    Spark sorts the partition and only the keys are looked at, in the order of the rows, so the
    function must not be moved below the sort.
    """
    opens = F.arrow_udf(_opens_run, "boolean").asNondeterministic()
    rows = df.sortWithinPartitions(F.col(key).asc_nulls_first(), *order)
    return rows.withColumn("_opens", opens(F.col(key))).filter("_opens").drop("_opens")


def value_counts(df: DataFrame, column: str, *by: str) -> DataFrame:
    """(by, _value, _copies): how often each value occurs. Counts of parts add up to those of the whole."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )


def quantiles(df: DataFrame, column: str, points: Sequence[float]) -> DataFrame:
    """One row with the exact quantiles q0, q1, ... by linear interpolation.

    Rows are first counted per value, then ranked over consecutive value ranges.
    No task holds all values and no value has to fit beside its copies.
    """
    return quantiles_of_counts(value_counts(df, column), points)


def quantiles_of_counts(counted: DataFrame, points: Sequence[float]) -> DataFrame:
    """The same from ``value_counts``, each value in one row."""
    sliced = range_sliced(counted, ["_value"], "values")
    so_far = (
        Window.partitionBy(SLICE).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    )
    last = F.col("_last")
    # one row per slice, as above
    offsets = F.broadcast(_before(sliced, F.col("_copies")))
    ranked = (
        sliced.withColumn("_upto", F.sum("_copies").over(so_far))
        .join(offsets, SLICE)
        .select(
            "_value",
            (F.col("_upto") + F.col(BEFORE) - F.col("_copies")).alias("_first"),
            (F.col("_upto") + F.col(BEFORE) - 1).alias("_last"),
            sliced.agg((F.sum("_copies") - 1).alias("n")).scalar().alias("_end"),
        )
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_first") <= rank) & (rank <= last), F.col("_value")))

    sides = []
    for i, point in enumerate(points):
        position = F.col("_end") * F.lit(float(point))
        sides += [
            value_at(F.floor(position)).alias(f"_lo{i}"),
            value_at(F.ceil(position)).alias(f"_hi{i}"),
            F.max(position - F.floor(position)).alias(f"_part{i}"),
        ]
    return ranked.agg(*sides).select(
        *(_between(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_part{i}")).alias(f"q{i}")
          for i in range(len(points)))
    )


def _between(low: Column, high: Column, part: Column) -> Column:
    """Linear interpolation, counted from the nearer end."""
    gap = high - low
    return F.when(part < 0.5, low + gap * part).otherwise(high - gap * (1 - part))
