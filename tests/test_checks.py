"""Every check passing and failing."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from kvartal import schemas
from kvartal.operators import checks, star
from kvartal.plans import gold, silver
from kvartal.sources.staging import stage
from rows import bronze

TODAY = date(2026, 5, 3)


def outcome(report):
    return {r.check: r.passed for r in report.collect()}


def failed(report):
    return {name for name, passed in outcome(report).items() if not passed}


@pytest.fixture(scope="module")
def clean_rows(spark):
    rows = bronze(spark, *(
        {"listing_id": str(i), "district": d, "total_area_m2": 50.0 + i}
        for i, d in enumerate(["Mirabad", None, "Mirabad", "Sergeli", None, "Uchtepa"])
    ))
    return stage(silver.clean(rows, TODAY), "clean")


def test_bronze(spark):
    good = bronze(spark, {})
    assert failed(checks.bronze_checks(good)) == set()
    assert failed(checks.bronze_checks(good.limit(0))) == {"not empty"}
    assert failed(checks.bronze_checks(bronze(spark, {"url": None}))) == {
        "listing_id or url missing"
    }
    assert failed(checks.bronze_checks(bronze(spark, {"listing_id": "x" * 65}))) == {
        "text too long"
    }


def test_missing_critical_shows_few_rows(spark):
    rows = bronze(spark, *({"listing_id": str(i), "price": None} for i in range(9)), {})
    shown = checks.missing_critical(rows)
    assert shown.columns == ["listing_id", "price", "url", "source", "published_date"]
    assert [r.listing_id for r in shown.collect()] == ["0", "1", "2", "3", "4"]


@pytest.mark.parametrize("change, check", [
    (("price_usd", 0), "price_usd not positive"),
    (("price_usd", None), "price_usd missing"),
    (("rooms", -1), "rooms negative"),
    (("build_year", 1899), "build_year implausible"),
    (("build_year", 2028), "build_year implausible"),
    (("housing_type", "x" * 16), "text too long"),
])
def test_silver_ranges(clean_rows, change, check):
    name, value = change
    assert failed(checks.silver_checks(clean_rows, TODAY)) == set()
    spoilt = clean_rows.withColumn(name, F.when(F.col("listing_id") == "1", F.lit(value)).otherwise(
        F.col(name)))
    assert failed(checks.silver_checks(spoilt, TODAY)) == {check}


def test_next_year_is_plausible(clean_rows):
    assert failed(checks.silver_checks(clean_rows.withColumn("build_year", F.lit(2027)), TODAY)) == (
        set()
    )


def test_duplicates_only_warn(clean_rows):
    report = checks.silver_checks(clean_rows.unionByName(clean_rows), TODAY)
    assert failed(report) == {"duplicate listing_id"}
    checks.require(report)


def test_missing_id(clean_rows):
    spoilt = clean_rows.withColumn("listing_id", F.nullif("listing_id", F.lit("1")))
    assert failed(checks.silver_checks(spoilt, TODAY)) == {"listing_id missing"}


def test_gold(clean_rows):
    tables = gold.star_schema(clean_rows)
    names = ("fact_listing", "dim_property", "dim_location", "dim_listing_attributes")
    fact, prop, loc, attributes = (tables[n] for n in names)
    for name, df in tables.items():
        assert df.schema.names == schemas.GOLD[name].names
        assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.GOLD[name]]
    assert fact.count() == clean_rows.count()
    assert fact.filter("listing_id = '1'").count() == 1
    small = checks.gold_checks(clean_rows, fact, prop, loc, attributes)
    assert failed(small) == set()

    def spoilt(f=fact, p=prop, l=loc, a=attributes, s=clean_rows):
        return failed(checks.gold_checks(s, f, p, l, a))

    assert spoilt(f=fact.filter("listing_id <> '1'")) == {
        "fact rows differ from silver", "attributes listing_id not found",
    }
    assert spoilt(f=fact.unionByName(fact.filter("listing_id = '1'"))) == {
        "fact rows differ from silver", "fact listing_id repeated",
    }
    assert spoilt(l=loc.limit(0)) == {"location_dim_id not found"}
    assert spoilt(p=prop.limit(0)) == {"property_dim_id not found"}
    assert spoilt(a=attributes.unionByName(attributes)) == {"attributes listing_id repeated"}
    assert spoilt(l=loc.unionByName(loc.withColumn("location_dim_id", F.lit(99)))) >= {
        "dim_location combination repeated",
    }
    assert spoilt(p=prop.unionByName(prop.withColumn("renovation", F.lit("x")))) == {
        "property_dim_id repeated",
    }
    empty = fact.limit(0)
    assert {"fact not empty", "dim_property to fact ratio"} <= spoilt(f=empty)
    wide = prop.unionByName(clean_rows.select(
        (F.col("rooms") + F.col("listing_id").cast("int") + 100).alias("property_dim_id"),
        *schemas.PROPERTY_KEY).withColumn("renovation", F.col("property_dim_id").cast("string")))
    assert spoilt(p=wide) == {"dim_property to fact ratio"}


def test_null_attributes_find_their_dimension_row(clean_rows):
    location = stage(star.dim_location(clean_rows), "loc")
    rows = [(r.location_dim_id, r.region, r.district) for r in location.collect()]
    assert sorted(rows) == [
        (1, "R", None), (2, "R", "Mirabad"), (3, "R", "Sergeli"), (4, "R", "Uchtepa"),
    ]


def test_require_names_every_failed_check(spark):
    report = checks.bronze_checks(bronze(spark, {"url": None, "region": "x" * 101}))
    with pytest.raises(checks.ChecksFailed, match="missing.*too long"):
        checks.require(report)
