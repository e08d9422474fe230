"""Plans that have to hold at scale, and results under heavy skew."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from kvartal import fixtures, schemas
from kvartal.operators import accounting, checks, listings, ordering, star
from kvartal.plans import gold, silver
from kvartal.sources import landing
from kvartal.sources.staging import stage
from rows import bronze

TODAY = date(2026, 5, 3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_keeps_one_row_per_task_before_the_shuffle(spark, sf_dir):
    steps = [line.strip(" +-:*") for line in plan(
        listings.first_per_listing(fixtures.listings(spark, sf_dir))).splitlines()]
    limits = [i for i, s in enumerate(steps) if s.startswith("WindowGroupLimit")]
    exchange = next(i for i, s in enumerate(steps) if s.startswith("Exchange"))
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_silver_is_read_by_column(spark, folder):
    rows = bronze(spark, {})
    rows.write.parquet(f"{folder}/bronze")
    stored = spark.read.schema(schemas.BRONZE).parquet(f"{folder}/bronze")
    assert "living_area_m2" not in plan(silver.cleaning_input(stored))
    few = plan(listings.with_few_rooms(stored).select("listing_id"))
    assert "LessThan(rooms,7.0)" in few
    assert "ReadSchema: struct<listing_id:string,rooms:double>" in few


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 bronze rows; one listing, one place and one URL id hold a third of them."""
    base = bronze(spark, {}).drop("listing_id", "url", "district", "price", "total_area_m2")
    hot = F.col("id") % 3 == 0
    rows = spark.range(0, 20000, 1, 6).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("L"), F.col("id"))).alias("listing_id"),
        F.when(hot, "https://e.uz/x-IDhot.html")
        .otherwise(F.concat(F.lit("https://e.uz/x-ID"), F.col("id"), F.lit(".html"))).alias("url"),
        F.when(F.col("id") % 3 == 1, "Mirabad").otherwise((F.col("id") % 300).cast("string")).alias("district"),
        (F.lit(20000.0) + F.col("id")).alias("price"),
        (50.0 + F.col("id") % 97).alias("total_area_m2"),
    )
    return stage(rows.join(base).select(*schemas.BRONZE.names), "skewed")


def test_layers_under_skew(spark, skewed):
    clean = stage(silver.clean(skewed, TODAY), "skew-silver")
    assert clean.filter("listing_id = 'hot'").count() == 1
    expected = 20000 - 6667 + 1
    assert clean.count() == expected
    tables = gold.star_schema(clean)
    assert tables["fact_listing"].count() == expected
    assert tables["dim_location"].count() == clean.select("region", "district").distinct().count()
    report = checks.gold_checks(clean, tables["fact_listing"], tables["dim_property"],
                                tables["dim_location"], tables["dim_listing_attributes"])
    assert report.filter("NOT passed").count() == 0


def test_shuffle_join_gives_the_same_fact(spark, skewed):
    clean = stage(silver.clean(skewed, TODAY), "skew-silver")
    tables = gold.star_schema(clean)
    small = tables["fact_listing"]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = star.fact_listing(clean, tables["dim_property"], tables["dim_location"])
        assert "SortMergeJoin" in plan(fact) and "BroadcastHashJoin" not in plan(fact)
        rows = sorted(fact.collect(), key=lambda r: r.listing_id)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert rows == sorted(small.collect(), key=lambda r: r.listing_id)


def test_counts_and_numbers_under_skew(spark, skewed):
    assert accounting.extra_copies(skewed).first().listings == 6666
    numbered = ordering.number_within(skewed.select("listing_id", "price"), "listing_id", "n")
    top = numbered.groupBy("listing_id").agg(F.max("n").alias("n"), F.countDistinct("n").alias("d"))
    assert top.filter("n <> d").count() == 0
    assert top.filter("listing_id = 'hot'").first().n == 6667
    new = landing.unseen(skewed, skewed.limit(0))
    assert new.count() == 20000 - 6666
    assert landing.unseen(skewed, skewed).count() == 0


def test_no_plan_of_a_layer_crosses_rows(spark, skewed):
    clean = stage(silver.clean(skewed, TODAY), "skew-silver")
    tables = gold.star_schema(clean)
    for df in (clean, tables["fact_listing"], checks.silver_checks(clean, TODAY),
               checks.gold_checks(clean, tables["fact_listing"], tables["dim_property"],
                                  tables["dim_location"], tables["dim_listing_attributes"])):
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)



def test_gold_checks_read_written_tables_once(spark, skewed):
    """Silver, both dimensions (as keys and for themselves), attributes; the fact twice."""
    clean = stage(silver.clean(skewed, TODAY), "skew-silver")
    tables = gold.star_schema(clean)
    report = checks.gold_checks(clean, tables["fact_listing"], tables["dim_property"],
                                tables["dim_location"], tables["dim_listing_attributes"])
    text = report._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") <= 8
    assert "description" not in plan(report)


def test_few_silver_columns_stage_few_columns(spark, skewed):
    clean = silver.clean(skewed, TODAY, columns=schemas.LOCATION_KEY)
    assert clean.columns == list(schemas.LOCATION_KEY)
    stored = spark.read.parquet(clean.inputFiles()[0])
    assert set(stored.columns) == {"total_area_m2", "_fits", "total_floors", *schemas.LOCATION_KEY}
    whole = silver.clean(skewed, TODAY).select(*schemas.LOCATION_KEY)
    count = lambda df: sorted((*r,) for r in df.groupBy(*schemas.LOCATION_KEY).count().collect())
    assert count(clean) == count(whole)


def test_rows_that_cannot_stay_keep_only_their_area(spark, skewed):
    rows = skewed.withColumn("total_area_m2", F.when(F.col("price") % 2 == 0, 900.0).otherwise(60.0))
    clean = listings.with_usual_area(rows.select("listing_id", "total_area_m2", "description"))
    stored = spark.read.parquet(*clean.inputFiles())
    assert stored.filter("total_area_m2 = 900").filter("listing_id IS NOT NULL").count() == 0
    assert stored.count() == rows.count()


def test_large_steps_are_compiled(spark, sf_dir):
    """The JVM compiles no method beyond 8,000 bytes of code."""
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        fixtures.listings(spark, sf_dir)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)
