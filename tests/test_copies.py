"""Copies of listings inside one partition, over several, and listings without copies."""

from datetime import date

import pyarrow as pa
from pyspark.sql import functions as F

from kvartal.operators import listings, ordering
from kvartal.plans import incremental
from kvartal.sources.staging import stage
from rows import DEFAULTS, bronze


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def many(spark):
    """9,000 rows: 1,500 ids alone, 1,500 with five copies beside each other or apart, one of which is NULL."""
    base = bronze(spark, {}).drop("listing_id", "price", "url", "rooms", "description")
    number = F.col("id")
    listing = F.when(number < 1500, number).when(number < 5250, 1500 + F.floor((number - 1500) / 5)).otherwise(
        2250 + number % 750
    )
    rows = spark.range(0, 9000, 1, 6).select(
        F.nullif(F.concat(F.lit("L"), listing), F.lit("L2260")).alias("listing_id"),
        F.when(number % 3 > 0, (number * 7 % 3).cast("double")).alias("price"),
        F.concat(F.lit("u"), number % 2).alias("url"),
        F.when(number % 4 > 0, F.concat(F.lit("t"), number % 5)).alias("description"),
        (number * 31 % 11).cast("double").alias("rooms"),
    )
    return rows.join(base).select(*bronze(spark, {}).columns)


def test_first_copies_wherever_they_lie(spark):
    rows = stage(many(spark), "many")
    columns = ["price", "total_area_m2", "description", "url",
               *(c for c in rows.columns if c not in (listings.KEY, *listings.FIRST_ROW_ORDER))]
    last = lambda v: (v is None, v if v is not None else 0)
    expected = {}
    for row in rows.collect():
        key = [last(row[c]) for c in columns]
        if row.listing_id not in expected or key < expected[row.listing_id][0]:
            expected[row.listing_id] = key, tuple(row)
    for given in (rows, rows.repartition(5, "url"), rows.coalesce(1)):
        found = listings.first_per_listing(given).collect()
        assert len(found) == len(expected)
        assert {r.listing_id: tuple(r) for r in found} == {k: row for k, (_, row) in expected.items()}


def test_listings_that_one_partition_holds_are_not_shuffled(spark):
    text = plan(listings.first_per_listing(many(spark)))
    branches = text[text.index("Union"):]
    assert branches.count("Exchange hashpartitioning(listing_id") == 1
    assert branches.count("WindowGroupLimit") == 2  # both around that exchange
    rows = stage(many(spark).repartition(7, "listing_id"), "together")
    result = listings.first_per_listing(rows)
    assert result.count() == rows.select("listing_id").distinct().count()


def test_one_row_of_each_key_stays_in_a_partition(spark):
    rows = spark.range(0, 1000, 1, 4).select((F.col("id") % 50).cast("string").alias("k"), -F.col("id") % 97)
    rows = rows.toDF("k", "v").withColumn("k", F.nullif("k", F.lit("7")))
    first = ordering.first_in_partition(rows, "k", [F.col("v").asc_nulls_last()])
    part = F.spark_partition_id().alias("p")
    expected = rows.select("*", part).groupBy("k", "p").agg(F.min("v").alias("v"))
    by = lambda r: (r.p, r.k or "", r.v)
    assert sorted(map(by, first.select("*", part).collect())) == sorted(map(by, expected.collect()))


def test_runs_go_on_over_batches():
    batches = [["a", "a", None], [], [None, "b"], ["b"], ["c", None]]
    found = ordering._opens_run(pa.array(b, pa.string()) for b in batches)
    assert [f.to_pylist() for f in found] == [[True, False, True], [], [False, True], [False], [True, True]]


def test_wide_rows_keep_their_values(spark):
    rows = bronze(spark, {"description": "x" * 100_000}, {"listing_id": "b", "rooms": float("nan")}, {"listing_id": "b"})
    found = {r.listing_id: r for r in listings.first_per_listing(rows).collect()}
    assert found["a"].description == "x" * 100_000 and found["b"].rooms == DEFAULTS["rooms"]


def test_copies_of_a_partition_are_not_dealt_by_bucket(spark, folder):
    """A batch with ten copies of each listing beside each other moves one of them."""
    rows = spark.range(0, 2000, 1, 4).withColumn("id", F.floor(F.col("id") / 10))
    base = bronze(spark, {}).drop("listing_id")
    batch = stage(rows.select(F.concat(F.lit("L"), "id").alias("listing_id")).join(base), "ten-times")
    moved = []
    dealt = incremental.dealt_by_bucket

    def counted(copies):
        moved.append(copies.count())
        return dealt(copies)

    incremental.dealt_by_bucket = counted
    try:
        incremental.update(batch, folder, run="first")
    finally:
        incremental.dealt_by_bucket = dealt
    assert len(moved) == 1 and moved[0] < 400
    assert incremental.current_silver(spark, folder, date(2026, 5, 3)).count() <= 200
