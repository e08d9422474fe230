"""Data-quality checks. Every check is one row; nothing is raised inside a plan.

Columns: layer, check, severity (``fail`` or ``warn``), observed, threshold, passed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kvartal import schemas, vocab

FAIL, WARN = "fail", "warn"


def _rows(df: DataFrame, layer: str, checks: Sequence[tuple]) -> DataFrame:
    """Turn one row of aggregates into one row per check.

    Each check is (name, severity, observed, threshold, passed).
    """
    structs = F.array(*(
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("check"),
            F.lit(severity).alias("severity"),
            observed.cast("double").alias("observed"),
            F.lit(float(threshold)).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for name, severity, observed, threshold, passed in checks
    ))
    return df.select(F.inline(structs))


def _none(name: str, severity: str, column: str) -> tuple:
    """Check that a count is zero."""
    return name, severity, F.col(column), 0, F.col(column) == 0


def _too_long(lengths: Mapping[str, int]) -> Column:
    return reduce(
        lambda a, b: a | b,
        (F.coalesce(F.length(c) > n, F.lit(False)) for c, n in lengths.items()),
    )


def bronze_checks(bronze: DataFrame) -> DataFrame:
    """Not empty, id and URL present, texts within their declared length."""
    found = bronze.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("listing_id").isNull() | F.col("url").isNull()).alias("no_key"),
        F.count_if(_too_long(schemas.BRONZE_LENGTHS)).alias("too_long"),
    )
    return _rows(found, "bronze", [
        ("not empty", FAIL, F.col("rows"), 1, F.col("rows") >= 1),
        _none("listing_id or url missing", FAIL, "no_key"),
        _none("text too long", FAIL, "too_long"),
    ])


def missing_critical(bronze: DataFrame, rows: int = 5) -> DataFrame:
    """A few listings without id, price or URL, for a look."""
    missing = [F.col(c).isNull() for c in ("listing_id", "price", "url")]
    return (
        bronze.filter(reduce(lambda a, b: a | b, missing))
        .select("listing_id", "price", "url", "source", "published_date")
        .orderBy(F.col("listing_id").asc_nulls_first(), F.col("url").asc_nulls_first())
        .limit(rows)
    )


def silver_checks(silver: DataFrame, as_of: date) -> DataFrame:
    """Value ranges, the key and the declared lengths, in one pass over silver.

    Counts are first taken per listing id, combined before the shuffle, so copies
    of one id do not travel.
    """
    year = F.col("build_year")
    bad = {
        "bad_price": F.col("price_usd") <= 0,
        "no_price": F.col("price_usd").isNull(),
        "bad_rooms": F.col("rooms") < 0,
        "bad_year": (year < vocab.FIRST_BUILD_YEAR) | (year > as_of.year + 1),
        "too_long": _too_long(schemas.SILVER_LENGTHS),
    }
    per_id = silver.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(test).alias(name) for name, test in bad.items()),
    )
    total = lambda value, name: F.coalesce(F.sum(value), F.lit(0)).alias(name)
    found = per_id.agg(
        total(F.col("rows") - 1, "duplicates"),
        total(F.when(F.col("listing_id").isNull(), F.col("rows")), "no_id"),
        *(total(F.col(name), name) for name in bad),
    )
    return _rows(found, "silver", [
        _none("duplicate listing_id", WARN, "duplicates"),
        _none("price_usd not positive", FAIL, "bad_price"),
        _none("rooms negative", FAIL, "bad_rooms"),
        _none("build_year implausible", FAIL, "bad_year"),
        _none("listing_id missing", FAIL, "no_id"),
        _none("price_usd missing", FAIL, "no_price"),
        _none("text too long", FAIL, "too_long"),
    ])


def _total(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).alias(name)


def _known(table: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a table, marked."""
    return table.select(key).distinct().withColumn(f"_{key}", F.lit(True))


def _fact_counts(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row, from one pass: rows, repeated listings, and rows whose key a dimension lacks."""
    keyed = fact.select("listing_id", *dims)
    for key, dim in dims.items():
        keyed = keyed.join(_known(dim, key), key, "left")
    per_listing = keyed.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(f"_{key}").isNull()).alias(f"{key}_lost") for key in dims),
    )
    return per_listing.agg(
        _total(F.col("_rows"), "fact_rows"),
        _total(F.col("_rows") - 1, "fact_repeated"),
        *(_total(F.col(f"{key}_lost"), f"{key}_lost") for key in dims),
    )


def _attribute_counts(attributes: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: repeated listings, and rows whose listing the fact lacks."""
    per_listing = attributes.groupBy("listing_id").agg(F.count(F.lit(1)).alias("_rows"))
    return per_listing.join(_known(fact, "listing_id"), "listing_id", "left").agg(
        _total(F.col("_rows") - 1, "attributes_repeated"),
        _total(F.when(F.col("_listing_id").isNull(), F.col("_rows")), "attributes_lost"),
    )


def _dimension_counts(dim: DataFrame, key: str, combination: Sequence[str]) -> DataFrame:
    """One row, from one pass: rows, repeated combinations and repeated keys."""
    return dim.agg(
        F.count(F.lit(1)).alias(f"{key}_rows"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*combination))).alias(f"{key}_combinations"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(key))).alias(f"{key}_repeated"),
    )


def gold_checks(
    silver: DataFrame,
    fact: DataFrame,
    properties: DataFrame,
    locations: DataFrame,
    attributes: DataFrame,
) -> DataFrame:
    """Row reconciliation, size of the dimension, unique keys and found references.

    Hand in written tables: the fact is read twice, the others once.
    """
    one_row = [
        _fact_counts(fact, {"property_dim_id": properties, "location_dim_id": locations}),
        _attribute_counts(attributes, fact),
        _dimension_counts(properties, "property_dim_id", schemas.PROPERTY_KEY),
        _dimension_counts(locations, "location_dim_id", schemas.LOCATION_KEY),
    ]
    packed = lambda counts: counts.select(F.struct("*").alias("counts")).scalar()
    found = silver.agg(F.count(F.lit(1)).alias("silver_rows")).select(
        "silver_rows", *(packed(counts).alias(f"_{i}") for i, counts in enumerate(one_row))
    ).select("silver_rows", *(f"_{i}.*" for i in range(len(one_row))))
    ratio = F.try_divide(
        F.col("property_dim_id_rows").cast("double"), F.col("fact_rows").cast("double")
    )
    return _rows(found.withColumn("ratio", ratio), "gold", [
        ("fact rows differ from silver", FAIL, F.col("fact_rows") - F.col("silver_rows"), 0,
         F.col("fact_rows") == F.col("silver_rows")),
        ("fact not empty", FAIL, F.col("fact_rows"), 1, F.col("fact_rows") >= 1),
        ("dim_property to fact ratio", FAIL, F.col("ratio"), vocab.MAX_DIM_TO_FACT_RATIO,
         F.col("ratio") <= vocab.MAX_DIM_TO_FACT_RATIO),
        _none("fact listing_id repeated", FAIL, "fact_repeated"),
        _none("attributes listing_id repeated", FAIL, "attributes_repeated"),
        _none("dim_property combination repeated", FAIL, "property_dim_id_combinations"),
        _none("dim_location combination repeated", FAIL, "location_dim_id_combinations"),
        _none("property_dim_id repeated", FAIL, "property_dim_id_repeated"),
        _none("location_dim_id repeated", FAIL, "location_dim_id_repeated"),
        _none("property_dim_id not found", FAIL, "property_dim_id_lost"),
        _none("location_dim_id not found", FAIL, "location_dim_id_lost"),
        _none("attributes listing_id not found", FAIL, "attributes_lost"),
    ])


class ChecksFailed(RuntimeError):
    """Raised on the driver after all checks of a layer are known."""


def require(checks: DataFrame) -> DataFrame:
    """Raise if a ``fail`` check did not pass. A layer has a dozen rows at most."""
    failed = checks.filter(~F.col("passed") & (F.col("severity") == FAIL)).collect()
    if failed:
        raise ChecksFailed("; ".join(
            f"{row.layer}: {row.check} (observed {row.observed:g}, threshold {row.threshold:g})"
            for row in failed
        ))
    return checks
