"""Where rows go during cleaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from kvartal import vocab
from kvartal.operators import categories, listings
from kvartal.sources.staging import stage

KEPT = "kept"
DUPLICATE = "duplicate"


def drop_reasons(df: DataFrame, per_usd: Mapping[str, float] | None = None) -> DataFrame:
    """Rows per reason, the first one that applies in the order of the cleaning steps.

    Missing and non-positive prices, unknown and too many rooms, unknown and
    unusual areas are counted apart. Listings that stay count as ``kept``.
    """
    rates = vocab.UNITS_PER_USD if per_usd is None else per_usd
    first = listings.first_per_listing(df)
    judged = listings.with_price_per_sqr(
        categories.with_listing_type(
            first.withColumn(
                "price_usd", listings.usd(F.col("price"), F.col("currency"), rates)
            )
        )
    )
    early = (
        F.when(F.col("price").isNull(), "missing price")
        .when(F.col("price_usd") <= 0, "price not positive")
        .when(F.col("rooms").isNull(), "rooms unknown")
        .when(F.col("rooms") >= vocab.ROOMS_BELOW, "too many rooms")
        .when(listings.overpriced(), "overpriced")
        .when(F.col("total_area_m2").isNull(), "area unknown")
    )
    rows = stage(
        judged.select(early.alias("_early"), "total_area_m2", "total_floors"), "reasons"
    )
    bounds = listings.area_bounds(rows.filter(F.col("_early").isNull()))
    lower, upper = (bounds.select(c).scalar() for c in ("lower", "upper"))
    few_floors = F.col("total_floors") < vocab.TOTAL_FLOORS_BELOW
    reason = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(~F.col("total_area_m2").between(lower, upper), "area unusual")
        .when(~F.coalesce(few_floors, F.lit(False)), "too many floors")
        .otherwise(KEPT)
    )
    reasons = rows.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("listings"))
    copies = extra_copies(df).select(F.lit(DUPLICATE).alias("reason"), "listings")
    return reasons.unionByName(copies)


def extra_copies(df: DataFrame, key: str = listings.KEY) -> DataFrame:
    """One row: rows beyond the first of their listing, NULL ids taken as one listing."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("listings"))


def null_counts(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """One row: NULLs in a column before and after a step."""
    counts = lambda df, name: df.agg(F.count_if(F.col(column).isNull()).alias(name))
    return counts(before, "nulls_before").select(
        "nulls_before", counts(after, "nulls_after").scalar().alias("nulls_after")
    )
