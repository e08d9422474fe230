"""Silver by batches against silver of all rows at once."""

import os
import random
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from kvartal.operators import listings
from kvartal.operators.ordering import quantiles, quantiles_of_counts, value_counts
from kvartal.plans import incremental, silver
from kvartal.sources import publishing
from rows import bronze

TODAY = date(2026, 5, 3)


def listing(i, rng):
    return {
        "listing_id": f"L{i}", "price": rng.choice([None, 0.0, 100.0, 30000.0, 500000.0, 9e7]),
        "total_area_m2": rng.choice([None, 900.0, 10.0 + i % 90, 45.0]), "rooms": float(i % 9),
        "url": f"https://e.uz/x-ID{i}-{rng.randrange(5)}.html", "description": rng.choice(["for sale", "for rent", None]),
    }


def bag(df):
    return Counter(map(tuple, df.collect()))


def full(spark, parts):
    return bag(silver.clean(bronze(spark, *(row for part in parts for row in part)), TODAY))


def test_batches_equal_all_rows_at_once(spark, folder, monkeypatch):
    """Copies of one listing in several batches, cheaper ones later and earlier."""
    monkeypatch.setattr(incremental, "BUCKETS", 16)
    rng = random.Random(3)
    parts = [[listing(rng.randrange(60), rng) for _ in range(n)] for n in (80, 5, 30)]
    for i, part in enumerate(parts):
        incremental.update(bronze(spark, *part), folder)
        assert bag(incremental.current_silver(spark, folder, TODAY)) == full(spark, parts[: i + 1])
    incremental.update(bronze(spark, *parts[0]).limit(0), folder)
    assert bag(incremental.current_silver(spark, folder, TODAY)) == full(spark, parts)


def test_a_small_batch_reads_and_writes_few_buckets(spark, folder):
    rng = random.Random(4)
    parts = [[listing(i, rng) for i in range(400)], [listing(7, rng), listing(8, rng), listing(1000, rng)]]
    first = incremental.update(bronze(spark, *parts[0]), folder, run="a")
    second = incremental.update(bronze(spark, *parts[1]), folder, run="b")
    assert len(first.buckets) > 150 and len(second.buckets) == 3
    lines = {line.run: line.folder for line in publishing.lines(spark, folder, incremental.LAYER)}
    place = os.path.join(folder, incremental.LAYER, lines["b"])
    written = {name for name in os.listdir(f"{place}/firsts") if name.startswith("bucket=")}
    assert written == {f"bucket={b}" for b in second.buckets}
    kept = {b: f for b, f in incremental.manifest(spark, folder, lines["a"]).items() if b in second.buckets}
    read = incremental._of_buckets(spark, folder, kept, "firsts")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    where = incremental.manifest(spark, folder)
    assert {b for b, f in where.items() if f == lines["b"]} == set(second.buckets)
    assert bag(incremental.current_silver(spark, folder, TODAY)) == full(spark, parts)


def test_a_run_sent_twice_changes_nothing(spark, folder):
    rng = random.Random(5)
    rows = [listing(i, rng) for i in range(20)]
    incremental.update(bronze(spark, *rows), folder, run="a")
    before = bag(incremental.current_silver(spark, folder, TODAY))
    again = incremental.update(bronze(spark, *[listing(i, rng) for i in range(20)]), folder, run="a")
    assert again.buckets == [] and bag(incremental.current_silver(spark, folder, TODAY)) == before


def test_rows_that_nothing_is_left_of(spark, folder):
    incremental.update(bronze(spark, {"listing_id": None, "price": 0.0}), folder)
    assert incremental.current_silver(spark, folder, TODAY).count() == 0


def test_counts_of_parts_add_up(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, *map(float, range(30))]), rng.randrange(4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "v double, part int")
    counts = value_counts(df, "v", "part")
    merged = counts.groupBy("_value").agg(F.sum("_copies").alias("_copies"))
    points = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    assert quantiles_of_counts(merged, points).collect() == quantiles(df, "v", points).collect()
    areas = df.withColumnRenamed("v", "total_area_m2")
    parts = value_counts(areas, "total_area_m2", "part")
    assert listings.area_bounds_of_counts(parts).collect() == listings.area_bounds(areas).collect()


def test_a_bucket_is_written_in_one_file(spark, folder):
    """Whatever the number of tasks: files in number of tasks times buckets take longer than the rows."""
    rng = random.Random(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = bronze(spark, *(listing(i, rng) for i in range(600))).repartition(4)
        incremental.update(rows, folder, run="a")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    (line,) = publishing.lines(spark, folder, incremental.LAYER)
    for table in ("firsts", "areas"):
        place = os.path.join(folder, incremental.LAYER, line.folder, table)
        for bucket in (name for name in os.listdir(place) if name.startswith("bucket=")):
            files = [f for f in os.listdir(f"{place}/{bucket}") if f.endswith(".parquet")]
            assert len(files) == 1
