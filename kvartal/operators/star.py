"""Star schema: two de-duplicated dimensions, a fact table and a table of attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kvartal import schemas
from kvartal.operators.ordering import number_distinct


def dimension(silver: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Distinct combinations of ``key``, NULLs equal, numbered in sorted order."""
    return number_distinct(silver.select(*key).distinct(), key, name)


def dim_property(silver: DataFrame) -> DataFrame:
    return dimension(silver, schemas.PROPERTY_KEY, "property_dim_id")


def dim_location(silver: DataFrame) -> DataFrame:
    return dimension(silver, schemas.LOCATION_KEY, "location_dim_id")


def _same(left: str, right: str, key: Sequence[str]) -> Column:
    """All key columns equal, NULL equal to NULL."""
    pairs = (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in key)
    return reduce(lambda a, b: a & b, pairs)


def fact_listing(silver: DataFrame, properties: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per listing with its two dimension keys.

    NULL attributes match their dimension row. The joins carry no hint: the
    dimensions are written tables of known size, so Spark broadcasts them below
    its threshold and falls back to a shuffle join, with skew splitting, above it.
    """
    s, p, d = silver.alias("s"), properties.alias("p"), locations.alias("l")
    same_property = _same("s", "p", schemas.PROPERTY_KEY)
    same_location = _same("s", "l", schemas.LOCATION_KEY)
    return s.join(p, same_property).join(d, same_location).select(
        "s.listing_id", "p.property_dim_id", "l.location_dim_id",
        *(f"s.{c}" for c in schemas.MEASURES),
    )


def listing_attributes(silver: DataFrame) -> DataFrame:
    return silver.select("listing_id", *schemas.ATTRIBUTES)


SALE_PRICE_BY_PLACE = """
    SELECT l.region, l.district, p.housing_type,
           count(*) AS listings,
           CAST(sum(f.price_per_sqr) AS DOUBLE) / count(f.price_per_sqr) AS avg_price_per_sqr
    FROM {fact_listing} f
    JOIN {dim_location} l ON f.location_dim_id = l.location_dim_id
    JOIN {dim_property} p ON f.property_dim_id = p.property_dim_id
    WHERE f.listing_type = 'Sale'
    GROUP BY l.region, l.district, p.housing_type
"""


def sale_price_by_place(
    fact: DataFrame, locations: DataFrame, properties: DataFrame
) -> DataFrame:
    """Listings for sale and their mean price per square metre, by place and housing type."""
    return fact.sparkSession.sql(
        SALE_PRICE_BY_PLACE, fact_listing=fact, dim_location=locations, dim_property=properties
    )
