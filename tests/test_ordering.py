"""Distributed numbering and quantiles against brute force, with hot keys and values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kvartal.operators import ordering


@pytest.mark.parametrize("values", [
    [1.0], [3.0, 1.0], [5.0] * 40 + [1.0, 9.0, 7.5], list(np.linspace(0, 1, 101) ** 2),
    [0.1 * i for i in range(37)] * 3 + [2.5] * 60,
])
def test_quantiles(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    points = (0.0, 0.25, 0.5, 0.75, 1.0)
    found = ordering.quantiles(rows.repartition(5), "v", points).first()
    assert list(found) == list(np.quantile(values, points))


def test_quantiles_of_nothing(spark):
    assert list(ordering.quantiles(spark.createDataFrame([], "v double"), "v", (0.5,)).first()) == [
        None
    ]


def test_number_distinct_sorts_over_many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(500).select(
            F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("a"),
            (F.col("id") % 71).alias("b"),
        ).distinct()
        found = ordering.number_distinct(rows, ["a", "b"], "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = sorted(found, key=lambda r: (r.a is not None, r.a or "", r.b))
    assert [r.n for r in ordered] == list(range(1, len(found) + 1))
    assert len(found) == len({(r.a, r.b) for r in found}) > 400


def test_number_within_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("k"), "id",
    ).repartition(6)
    found = ordering.number_within(rows, "k", "n").collect()
    assert len(found) == 3000
    by_key = {}
    for r in found:
        by_key.setdefault(r.k, []).append(r.n)
    assert all(sorted(ns) == list(range(1, len(ns) + 1)) for ns in by_key.values())
    assert len(by_key["hot"]) == len(by_key[None]) == 1000
