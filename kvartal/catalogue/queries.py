"""Queries by name. Each takes (session, folder of the tables) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kvartal import fixtures, schemas, vocab
from kvartal.extraction import links, values
from kvartal.extraction.listings import page_listings
from kvartal.operators import accounting, categories, checks, listings, ordering, star
from kvartal.plans import gold, incremental, silver
from kvartal.plans.run import run_layers
from kvartal.sources import landing, listings_csv, publishing, split_csv
from kvartal.sources.staging import stage, staged_path

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2026, 5, 3)
SOURCE = "web"
BASE = "https://example.uz"

QUERIES: dict[str, Query] = {}


def query(define: Query) -> Query:
    QUERIES[define.__name__] = define
    return define


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, for comparing across engines."""

    def column(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*(column(f) for f in df.schema))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.listings(spark, sf_dir)


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.first_per_listing(bronze(spark, sf_dir))


def up_to(spark: SparkSession, sf_dir: str, last: Callable) -> DataFrame:
    """Bronze after the cleaning steps up to and including ``last``."""
    steps = silver.priced_steps()
    return silver.apply(bronze(spark, sf_dir), steps[: steps.index(last) + 1])


def cleaned(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = silver.SILVER_COLUMNS
) -> DataFrame:
    return silver.clean(bronze(spark, sf_dir), AS_OF, columns=columns)


def replaced(step: Callable[[DataFrame], DataFrame], column: str) -> Query:
    """A one-column normaliser over all bronze rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(bronze(spark, sf_dir)).select("listing_id", "url", column)

    return run


# -- which rows stay -------------------------------------------------------


@query
def listings_dedup(spark, sf_dir):
    return first_rows(spark, sf_dir)


@query
def duplicate_report(spark, sf_dir):
    return accounting.extra_copies(bronze(spark, sf_dir))


@query
def duplicate_numbers(spark, sf_dir):
    rows = bronze(spark, sf_dir).select("listing_id", "url", "price")
    numbered = ordering.number_within(rows, "listing_id", "check_duplicates")
    return numbered.select("listing_id", "check_duplicates")


@query
def price_usd(spark, sf_dir):
    return listings.priced(bronze(spark, sf_dir)).select("listing_id", "url", "price_usd")


@query
def rooms_filter(spark, sf_dir):
    return listings.with_few_rooms(bronze(spark, sf_dir)).select("listing_id", "url", "rooms")


@query
def floors_filter(spark, sf_dir):
    rows = listings.with_few_floors(bronze(spark, sf_dir))
    return rows.select("listing_id", "url", "total_floors")


@query
def price_per_sqr(spark, sf_dir):
    rows = up_to(spark, sf_dir, listings.without_overpriced)
    return rows.select("listing_id", "price_usd", "listing_type", "price_per_sqr")


@query
def area_bounds(spark, sf_dir):
    return listings.area_bounds(up_to(spark, sf_dir, listings.without_overpriced))


@query
def area_outliers(spark, sf_dir):
    rows = up_to(spark, sf_dir, listings.without_overpriced)
    return listings.with_usual_area(rows.select("listing_id", "total_area_m2"))


@query
def drop_reasons(spark, sf_dir):
    return accounting.drop_reasons(bronze(spark, sf_dir))


@query
def building_age(spark, sf_dir):
    rows = listings.with_age(bronze(spark, sf_dir), AS_OF.year)
    return rows.select("listing_id", "url", "build_year", "age")


# -- categories ------------------------------------------------------------


@query
def keyword_scores(spark, sf_dir):
    rows = categories.with_keyword_scores(bronze(spark, sf_dir))
    return rows.select("listing_id", "url", "rent_score", "sale_score")


@query
def document_keyword_scores(spark, sf_dir):
    texts = fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("description"), F.col("source").alias("url")
    )
    return categories.with_keyword_scores(texts).select("doc_id", "rent_score", "sale_score")


@query
def listing_type(spark, sf_dir):
    rows = up_to(spark, sf_dir, categories.with_listing_type)
    return rows.select("listing_id", "price_usd", "listing_type")


@query
def listing_type_counts(spark, sf_dir):
    rows = up_to(spark, sf_dir, categories.with_listing_type)
    counts = rows.groupBy("listing_type").agg(F.count(F.lit(1)).alias("listings"))
    return counts.orderBy(F.desc("listings"))


@query
def no_keyword_listings(spark, sf_dir):
    scored = categories.with_keyword_scores(listings.priced(first_rows(spark, sf_dir)))
    silent = (F.col("rent_score") == 0) & (F.col("sale_score") == 0)
    return scored.agg(F.count_if(silent).alias("no_signal"))


housing_type_map = replaced(categories.with_housing_type, "housing_type")
district_clean = replaced(categories.with_district, "district")
building = replaced(categories.with_building_type, "building_type")
layout = replaced(categories.with_layout, "layout")
bathroom = replaced(categories.with_bathroom, "bathroom")
renovation = replaced(categories.with_renovation, "renovation")
for _name in ("housing_type_map", "district_clean", "building", "layout", "bathroom", "renovation"):
    QUERIES[_name] = globals()[_name]


@query
def district_list(spark, sf_dir):
    rows = categories.with_district(bronze(spark, sf_dir)).select("district")
    return rows.filter(F.col("district").isNotNull()).distinct().orderBy("district")


@query
def district_null_counts(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return accounting.null_counts(rows, categories.with_district(rows), "district")


@query
def renovation_counts(spark, sf_dir):
    rows = categories.with_renovation(bronze(spark, sf_dir))
    known = rows.filter(F.col("renovation").isNotNull())
    return known.groupBy("renovation").agg(F.count("listing_id").alias("listings"))


@query
def amenity_flags(spark, sf_dir):
    rows = categories.with_flags(bronze(spark, sf_dir), "amenities", "amenity", vocab.AMENITIES)
    return rows.select("listing_id", "url", *vocab.AMENITY_FLAGS)


@query
def nearby_flags(spark, sf_dir):
    rows = categories.with_flags(bronze(spark, sf_dir), "nearby", "nearby", vocab.NEARBY_PLACES)
    return rows.select("listing_id", "url", *vocab.NEARBY_FLAGS)


@query
def multi_value_items(spark, sf_dir):
    allowed = (*vocab.NEARBY_PLACES, "Metro")
    return bronze(spark, sf_dir).select(
        "listing_id", "url",
        F.array_join(categories.items(F.col("amenities")), ", ").alias("amenities"),
        F.array_join(categories.items(F.col("nearby"), allowed), ", ").alias("nearby"),
    )


@query
def near_metro(spark, sf_dir):
    rows = categories.with_near_metro(bronze(spark, sf_dir))
    return rows.select("listing_id", "url", "near_metro_mentioned")


# -- silver ----------------------------------------------------------------


@query
def silver_types(spark, sf_dir):
    names = ("commission", "negotiable", "furnished", "floor", "total_floors", "rooms",
             "build_year", "total_area_m2", "ceiling_height", "published_date", "date_scraped")
    rows = bronze(spark, sf_dir)
    return plain(rows.select(
        "listing_id", "url", *(silver.typed_column(name).alias(name) for name in names)
    ))


@query
def silver_full(spark, sf_dir):
    return plain(cleaned(spark, sf_dir))


@query
def incremental_silver(spark, sf_dir):
    """Silver of two batches, the second of which falls into few buckets."""
    root = staged_path(spark, "warehouse")
    rows = bronze(spark, sf_dir)
    late = F.col("listing_id").startswith("D") | F.col("listing_id").startswith("L1-")
    incremental.update(rows.filter(~late), root, run="first")
    incremental.update(rows.filter(late), root, run="second")
    return plain(incremental.current_silver(spark, root, AS_OF))


@query
def merged_area_bounds(spark, sf_dir):
    """Area bounds from counts of three parts."""
    rows = up_to(spark, sf_dir, listings.without_overpriced).select("listing_id", "total_area_m2")
    part = F.pmod(F.xxhash64("listing_id"), F.lit(3))
    counts = stage(
        ordering.value_counts(rows.withColumn("part", part), "total_area_m2", "part"), "counts-of-parts"
    )
    return listings.area_bounds_of_counts(counts)


@query
def rejected_values(spark, sf_dir):
    steps = silver.cleaning_steps(AS_OF)[:-1]  # the last one gives the types
    return silver.rejected_values(silver.apply(bronze(spark, sf_dir), steps))


# -- gold ------------------------------------------------------------------


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return gold.star_schema(stage(cleaned(spark, sf_dir), "silver"))


@query
def dim_property(spark, sf_dir):
    return star.dim_property(cleaned(spark, sf_dir, schemas.PROPERTY_KEY))


@query
def dim_location(spark, sf_dir):
    return star.dim_location(cleaned(spark, sf_dir, schemas.LOCATION_KEY))


@query
def fact_listing(spark, sf_dir):
    return plain(star_tables(spark, sf_dir)["fact_listing"])


@query
def listing_attributes(spark, sf_dir):
    return star.listing_attributes(
        cleaned(spark, sf_dir, ("listing_id", *schemas.ATTRIBUTES))
    )


@query
def star_price_by_district(spark, sf_dir):
    tables = star_tables(spark, sf_dir)
    return star.sale_price_by_place(
        tables["fact_listing"], tables["dim_location"], tables["dim_property"]
    )


@query
def sale_price_by_region(spark, sf_dir):
    rows = up_to(spark, sf_dir, listings.without_overpriced)
    per_sqr = F.col("price_per_sqr").cast("decimal(10,2)")
    sales = rows.filter(F.col("listing_type") == "Sale").groupBy("region")
    return sales.agg(
        F.count(F.lit(1)).alias("listings"),
        (F.sum(per_sqr).cast("double") / F.count(per_sqr)).alias("avg_price_per_sqr"),
    )


# -- checks ----------------------------------------------------------------


@query
def layer_checks(spark, sf_dir):
    raw = bronze(spark, sf_dir)
    rows = stage(cleaned(spark, sf_dir), "silver")
    tables = gold.star_schema(rows)
    return reduce(DataFrame.unionByName, [
        checks.bronze_checks(raw),
        checks.silver_checks(rows, AS_OF),
        checks.gold_checks(
            rows, tables["fact_listing"], tables["dim_property"], tables["dim_location"],
            tables["dim_listing_attributes"],
        ),
    ])


def daily_run(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Folder and checks of a run. Listings of houses from before 1900 or after next year
    fail a check by design and would stop it, so they are left out."""
    root = staged_path(spark, "warehouse")
    likely = F.col("build_year").between(vocab.FIRST_BUILD_YEAR, AS_OF.year + 1)
    rows = bronze(spark, sf_dir).filter(likely)
    return root, run_layers(rows, root, AS_OF).checks


@query
def run_checks(spark, sf_dir):
    return daily_run(spark, sf_dir)[1]


@query
def run_silver(spark, sf_dir):
    root, _ = daily_run(spark, sf_dir)
    rows = publishing.current_table(spark, root, "silver", "listings")
    return plain(rows.drop(schemas.LOAD_TIME))


@query
def run_gold_served(spark, sf_dir):
    root, _ = daily_run(spark, sf_dir)
    publishing.serve(spark, root, "gold", schemas.GOLD)
    return star.sale_price_by_place(*map(spark.table, ("fact_listing", "dim_location", "dim_property")))


@query
def failing_rows(spark, sf_dir):
    return checks.missing_critical(bronze(spark, sf_dir).withColumn(
        "price", F.when(F.col("price") > 0, F.col("price"))
    ))


# -- landing, samples, files -----------------------------------------------


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that stand for an earlier run: those of the first six years."""
    early = F.substring("published_date", -4, 4).between("1992", "1997")
    return bronze(spark, sf_dir).filter(early)


@query
def seen_keys(spark, sf_dir):
    return landing.seen_keys(bronze(spark, sf_dir))


@query
def skip_seen(spark, sf_dir):
    new = landing.unseen(bronze(spark, sf_dir).select("url"), landed(spark, sf_dir))
    return new.select("url")


@query
def skip_seen_by_index(spark, sf_dir):
    """The same from the keys that two landed batches have left, without their listings."""
    root = staged_path(spark, "landing-zone")
    rows = landed(spark, sf_dir).select("listing_id", "url")
    even = F.pmod(F.xxhash64("url"), F.lit(2)) == 0
    landing.append(rows.filter(even), root, "first")
    landing.append(rows.filter(~even), root, "second")
    return landing.unseen_by_index(bronze(spark, sf_dir).select("url"), root).select("url")


@query
def append_new(spark, sf_dir):
    old = landed(spark, sf_dir).select("listing_id", "url")
    new = landing.unseen(bronze(spark, sf_dir).select("listing_id", "url"), old)
    return landing.extended(old, new)


@query
def sample_100(spark, sf_dir):
    texts = fixtures.table(spark, sf_dir, "documents")
    return listings_csv.first_rows(texts, "doc_id", 100)


@query
def landing_batches(spark, sf_dir):
    """Two batches, one of them sent twice, as readers see them."""
    root = staged_path(spark, "landing-zone")
    rows = bronze(spark, sf_dir).select("listing_id", "url")
    landing.append(landed(spark, sf_dir).select("listing_id", "url"), root, "first")
    new = landing.unseen(rows, landing.landed(spark, root))
    for _ in range(2):
        landing.append(new, root, "second")
    return landing.landed(spark, root)


@query
def compacted_batches(spark, sf_dir):
    """Three batches put into one, the old ones removed, and one of them sent again."""
    root = staged_path(spark, "landing-zone")
    rows = bronze(spark, sf_dir).select("listing_id", "url", "price")
    third = F.pmod(F.xxhash64("url"), F.lit(3))
    for i in range(3):
        landing.append(rows.filter(third == i), root, f"batch-{i}")
    landing.compact(spark, root)
    publishing.retire(spark, root, landing.LAYER)
    landing.append(rows.filter(third == 1), root, "batch-1")
    return landing.landed(spark, root)


@query
def retained_runs(spark, sf_dir):
    """Three runs of a table; an old one is read while old ones are removed, and then removed, too.

    One row per state: how many runs there are, and the listings of the run that is read.
    """
    root = staged_path(spark, "warehouse")
    rows = bronze(spark, sf_dir).select("listing_id", "rooms")
    for i, most in enumerate((2, 5, 9)):
        run = f"run-{i}"
        publishing.write_table(rows.filter(F.col("rooms") < most), root, "silver", run, "listings")
        publishing.publish(spark, root, "silver", run)

    def state(name: str, run: str) -> DataFrame:
        count = len(publishing.published_runs(spark, root, "silver"))
        listings_of_run = publishing.read_table(spark, root, "silver", run, "listings")
        return stage(listings_of_run.agg(F.count(F.lit(1)).alias("listings")).select(
            F.lit(name).alias("state"), F.lit(count).cast("long").alias("runs"), "listings"
        ), "states")

    states = [state("published", publishing.current_run(spark, root, "silver"))]
    with publishing.reading(spark, root, "silver", "run-0") as held:
        publishing.retire(spark, root, "silver")
        states.append(state("held", held.folder))
    publishing.retire(spark, root, "silver")
    states.append(state("released", publishing.current_run(spark, root, "silver")))
    return reduce(DataFrame.unionByName, states)


@query
def sample_file(spark, sf_dir):
    texts = fixtures.table(spark, sf_dir, "documents")
    path = staged_path(spark, "sample")
    listings_csv.write_sample(texts, path, key="doc_id")
    return listings_csv.read_listings(spark, path, texts.schema)


def with_empty_texts(rows: DataFrame) -> DataFrame:
    """Some lists are empty texts instead of missing."""
    empty = F.when(F.col("negotiable") == 1, F.coalesce("nearby", F.lit(""))).otherwise(F.col("nearby"))
    return rows.withColumn("nearby", empty)


@query
def csv_roundtrip(spark, sf_dir):
    rows = with_empty_texts(bronze(spark, sf_dir))
    path = staged_path(spark, "csv")
    listings_csv.write_listings(rows, path, compression="lz4")
    return listings_csv.read_listings(spark, path, rows.schema)


@query
def csv_split_roundtrip(spark, sf_dir):
    """Files without a bound on their size, each read by many tasks."""
    rows = with_empty_texts(bronze(spark, sf_dir))
    path = staged_path(spark, "large-csv")
    listings_csv.write_listings(rows, path, file_rows=0)
    return split_csv.read_split_listings(spark, path, rows.schema, range_bytes=2**20)


# -- pages -----------------------------------------------------------------


@query
def page_links(spark, sf_dir):
    pages = fixtures.table(spark, sf_dir, "pages")
    return links.listing_links(pages, BASE, mark="/")


@query
def listing_links(spark, sf_dir):
    pages = fixtures.category_pages(bronze(spark, sf_dir))
    return links.listing_links(pages, BASE).select("position", "url")


@query
def canonical_url(spark, sf_dir):
    pages = fixtures.table(spark, sf_dir, "pages")
    return pages.select("page_id", links.canonical_url(F.col("url"), BASE).alias("url"))


@query
def listing_id_from_url(spark, sf_dir):
    both = bronze(spark, sf_dir).select("url").unionByName(
        fixtures.table(spark, sf_dir, "pages").select("url")
    )
    return both.select("url", landing.listing_id_from_url(F.col("url")).alias("listing_id"))


@query
def field_coercion(spark, sf_dir):
    rows = fixtures.texts(bronze(spark, sf_dir))
    fields = ("rooms", "total_area_m2", "ceiling_height", "build_year", "furnished",
              "commission", "renovation", "layout")
    return rows.select(
        "listing_id", "url", *(values.coerced(c, F.col(f"{c}_text")).alias(c) for c in fields)
    )


@query
def price_text(spark, sf_dir):
    rows = fixtures.texts(bronze(spark, sf_dir))
    return rows.select(
        "listing_id", "url",
        values.amount(F.col("price_text")).alias("price"),
        values.currency(F.col("price_text")).alias("currency"),
    )


@query
def published_date(spark, sf_dir):
    rows = fixtures.texts(bronze(spark, sf_dir))
    return rows.select(
        "listing_id", "url",
        values.published(F.col("published_text"), AS_OF).alias("published_date"),
    )


@query
def place_names(spark, sf_dir):
    rows = fixtures.texts(bronze(spark, sf_dir))
    return rows.select(
        "listing_id", "url",
        values.place(F.col("place_text")).alias("place"),
        values.is_region(values.place(F.col("place_text"))).alias("is_region"),
    )


@query
def tags(spark, sf_dir):
    rows = fixtures.texts(bronze(spark, sf_dir))
    return rows.select(
        "listing_id", "url",
        values.tags(F.col("amenity_text"), vocab.AMENITY_LEAD, vocab.AMENITY_TAGS)
        .alias("amenities"),
        values.tags(F.col("nearby_text"), vocab.NEARBY_LEAD, vocab.NEARBY_TAGS).alias("nearby"),
    )


@query
def json_fields(spark, sf_dir):
    return page_listings(fixtures.data_pages(bronze(spark, sf_dir)), SOURCE, AS_OF)


@query
def page_fields(spark, sf_dir):
    return page_listings(fixtures.pages(bronze(spark, sf_dir)), SOURCE, AS_OF)


@query
def raw_page_listings(spark, sf_dir):
    return page_listings(fixtures.table(spark, sf_dir, "pages"), SOURCE, AS_OF)
