"""Row-level cleaning of raw listings: which rows stay, and what they cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kvartal import vocab
from kvartal.functions import numbers
from kvartal.operators.ordering import first_in_partition, quantiles_of_counts, value_counts
from kvartal.sources import keys
from kvartal.sources.staging import file_ranges, stage

KEY = "listing_id"
#: bytes of files whose rows one task sorts, so that its memory does not grow with the table
SORTED_BYTES = 2**23
FIRST_ROW_ORDER = ("price", "total_area_m2", "description", "url")


def copy_order(columns: Sequence[str], order: Sequence[str] = FIRST_ROW_ORDER) -> list[Column]:
    """Total order of the copies of a listing: by ``order``, then by the other columns, NULLs last."""
    named = [c for c in order if c in columns]
    rest = [c for c in columns if c != KEY and c not in named]
    return [F.col(c).asc_nulls_last() for c in (*named, *rest)]


def first_per_listing(
    df: DataFrame, order: Sequence[str] = FIRST_ROW_ORDER, by: Sequence[str] = ()
) -> DataFrame:
    """One row per listing: the first by ``order``, NULLs last.

    Remaining columns break ties, so a re-run picks the same row. Rows that are dealt by columns which
    follow from the listing, named in ``by``, stay where they are. Of others each partition keeps the first
    of its copies; these rows are staged, which runs at once. What is shuffled of them is a hash of
    their listing, which tells the listings that several partitions kept, and then the rows of
    those. Bitmaps hold these hashes, so a few other rows may be shuffled, too, and come back alone.
    """
    if by:
        return _ranked_first(df, copy_order([c for c in df.columns if c not in by], order), by)
    spark, keys_in_order = df.sparkSession, copy_order(df.columns, order)
    with file_ranges(spark, SORTED_BYTES):
        kept = stage(first_in_partition(df, KEY, keys_in_order), "copies")
    hashed = kept.withColumn("_hash", F.xxhash64(KEY))
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    # at most keys.BITS / 32,768 rows of 4 kB
    bitmaps = F.broadcast(stage(keys.bitmaps_of(repeated.select("_hash")), "repeated"))
    several = keys.maybe(hashed, "_hash", bitmaps).select(*df.columns)
    alone = keys.marked(hashed, "_hash", bitmaps).filter("NOT _maybe").select(*df.columns)
    return _ranked_first(several, keys_in_order).unionByName(alone)


def _ranked_first(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The rank filter lets Spark keep one row per listing and task before the shuffle, so a listing
    with very many copies does not travel."""
    rank = F.row_number().over(Window.partitionBy(*by, KEY).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def usd(price: Column, currency: Column, per_usd: Mapping[str, float]) -> Column:
    """Price in dollars; a currency without a rate goes through unchanged."""
    amount = price
    for code, rate in per_usd.items():
        converted = numbers.round_half_even(price / F.lit(float(rate)), 1)
        amount = F.when(currency == code, converted).otherwise(amount)
    return amount


def priced(df: DataFrame, per_usd: Mapping[str, float] | None = None) -> DataFrame:
    """Listings with a price above zero, in dollars."""
    rates = vocab.UNITS_PER_USD if per_usd is None else per_usd
    return (
        df.filter(F.col("price").isNotNull())
        .withColumn("price_usd", usd(F.col("price"), F.col("currency"), rates))
        .filter(F.col("price_usd") > 0)
    )


def with_few_rooms(df: DataFrame) -> DataFrame:
    """Below seven rooms; an unknown number of rooms is dropped too."""
    return df.filter(F.col("rooms") < vocab.ROOMS_BELOW)


def per_sqr() -> Column:
    """Price per square metre where the area is known."""
    area = F.col("total_area_m2")
    return F.when(area > 0, numbers.round_half_even(F.col("price_usd") / area, 2))


def with_price_per_sqr(df: DataFrame) -> DataFrame:
    """Price per square metre of sale listings."""
    return df.withColumn("price_per_sqr", F.when(F.col("listing_type") == "Sale", per_sqr()))


def overpriced() -> Column:
    """Sale listing above the price per square metre limit; never NULL.

    The division comes first: as a filter this moves below the keyword scoring, and
    so the listing type is worked out a second time for the few dear rows only.
    """
    above = (per_sqr() > vocab.MAX_PRICE_PER_SQR) & (F.col("listing_type") == "Sale")
    return F.coalesce(above, F.lit(False))


def without_overpriced(df: DataFrame) -> DataFrame:
    return df.filter(~overpriced())


def area_bounds(df: DataFrame) -> DataFrame:
    """One row: quartiles of the area and the range a listing must lie in.

    The areas are counted and staged when this is called.
    """
    return _bounds(value_counts(df, "total_area_m2"))


def area_bounds_of_counts(counted: DataFrame) -> DataFrame:
    """The same from counts per area, which may come from several tables and are added up first."""
    return _bounds(counted.groupBy("_value").agg(F.sum("_copies").alias("_copies")))


def _bounds(counted: DataFrame) -> DataFrame:
    found = quantiles_of_counts(counted, (0.25, 0.75)).select(
        F.col("q0").alias("q1"), F.col("q1").alias("q3")
    )
    fence = F.col("q1") - vocab.IQR_FACTOR * (F.col("q3") - F.col("q1"))
    return found.select(
        "q1", "q3",
        fence.alias("fence"),
        F.greatest(fence, F.lit(float(vocab.MIN_AREA))).alias("lower"),
        F.lit(float(vocab.MAX_AREA)).alias("upper"),
    )


def with_usual_area(df: DataFrame, few_floors: bool = False) -> DataFrame:
    """Area known and within the bounds found on these same rows.

    Two passes over the rows, so they are staged in between, which runs at once. Rows that
    no bounds would let stay count for the bounds, but only their area is stored; with
    ``few_floors`` that holds for rows that ``with_few_floors`` drops, too.
    """
    area = F.col("total_area_m2")
    fits = area.between(vocab.MIN_AREA, vocab.MAX_AREA)
    if few_floors:
        fits = fits & (F.col("total_floors") < vocab.TOTAL_FLOORS_BELOW)
    fits = F.coalesce(fits, F.lit(False))
    kept = [F.when(fits, F.col(c)).alias(c) for c in df.columns if c != "total_area_m2"]
    rows = stage(df.filter(area.isNotNull()).select(area, fits.alias("_fits"), *kept), "area")
    bounds = area_bounds(rows)
    lower, upper = (bounds.select(c).scalar() for c in ("lower", "upper"))
    return rows.filter(F.col("_fits") & area.between(lower, upper)).select(*df.columns)


def with_few_floors(df: DataFrame) -> DataFrame:
    return df.filter(F.col("total_floors") < vocab.TOTAL_FLOORS_BELOW)


def with_age(df: DataFrame, year: int) -> DataFrame:
    """Age of the building; an implausible year keeps its value but gives no age."""
    built = F.col("build_year")
    age = F.when(built.between(vocab.FIRST_BUILD_YEAR, year), F.lit(year) - built)
    return df.withColumn("age", age)
