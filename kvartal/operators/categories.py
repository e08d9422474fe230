"""Normalisers of free-text categories, and the sale or rent decision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from kvartal import vocab
from kvartal.functions import text


def with_keyword_scores(df: DataFrame) -> DataFrame:
    """``rent_score`` and ``sale_score``: weighted words found in description and URL."""
    lowered = df.withColumns({
        "_description": F.lower(F.coalesce(F.col("description"), F.lit(""))),
        "_url": F.lower(F.coalesce(F.col("url"), F.lit(""))),
    })

    def score(words: tuple[str, ...]) -> Column:
        return (
            text.count_contained(F.col("_description"), words) * vocab.DESCRIPTION_WEIGHT
            + text.count_contained(F.col("_url"), words) * vocab.URL_WEIGHT
        )

    return lowered.withColumns({
        "rent_score": score(vocab.RENT_WORDS), "sale_score": score(vocab.SALE_WORDS),
    }).drop("_description", "_url")


def listing_type(rent: Column, sale: Column, price: Column) -> Column:
    """Keywords decide unless the price speaks clearly against them."""
    says_sale = (sale > rent) & (price >= vocab.RENT_MAX_PRICE)
    says_rent = (rent > sale) & (price < vocab.SALE_MIN_PRICE)
    cheap_sale = (sale > rent) & (price < vocab.RENT_MAX_PRICE)
    return (
        F.when(says_sale, "Sale")
        .when(says_rent | cheap_sale, "Rent")
        .when(price >= vocab.SALE_MIN_PRICE, "Sale")
        .otherwise("Rent")
    )


def with_listing_type(df: DataFrame) -> DataFrame:
    return (
        with_keyword_scores(df)
        .withColumn(
            "listing_type",
            listing_type(F.col("rent_score"), F.col("sale_score"), F.col("price_usd")),
        )
        .drop("rent_score", "sale_score")
    )


def housing_type(value: Column) -> Column:
    """Exact, case-sensitive match."""
    return text.lookup(value, vocab.HOUSING_TYPES)


def plain(value: Column) -> Column:
    return text.strip(F.lower(value))


def plain_without_dots(value: Column) -> Column:
    return F.replace(plain(value), F.lit("."), F.lit(""))


def building_type(key: Column) -> Column:
    return text.first_rule(key, vocab.BUILDING_RULES)


def layout(key: Column) -> Column:
    return text.first_rule(key, vocab.LAYOUT_RULES)


def bathroom(key: Column) -> Column:
    return text.first_rule(key, vocab.BATHROOM_RULES)


def renovation(key: Column) -> Column:
    return text.first_rule(key, vocab.RENOVATION_RULES)


def district(key: Column) -> Column:
    """Known spellings by table; others without generic words, in Latin, in title case."""
    bare = text.replace_each(key, vocab.DISTRICT_NOISE)
    latin = text.collapse_spaces(text.transliterate(bare, vocab.CYRILLIC_TO_LATIN))
    known = text.lookup(key, vocab.DISTRICT_OVERRIDES)
    usable = (key != "") & ~key.contains(vocab.MARKUP_LEFTOVER)
    return F.when(usable, F.coalesce(known, text.title_case(latin)))


def near_metro(*texts: Column) -> Column:
    """Any of the texts mentions the metro."""
    found = F.lit(False)
    for value in texts:
        found = found | F.coalesce(value.rlike(f"(?iu){vocab.METRO_PATTERN}"), F.lit(False))
    return found


def items(value: Column, allowed: tuple[str, ...] | None = None) -> Column:
    """Multi-value text as an array of known spellings, optionally of allowed items only."""
    spelled = F.transform(
        text.split_items(value),
        lambda item: F.coalesce(text.lookup(F.lower(item), vocab.ITEM_ALIASES), item),
    )
    if allowed is None:
        return spelled
    return F.filter(spelled, lambda item: text.one_of(item, allowed))


def with_flags(df: DataFrame, column: str, prefix: str, names: tuple[str, ...]) -> DataFrame:
    """One yes/no column per item of a fixed list, false where the text is missing."""
    found = f"_{column}"
    return (
        df.withColumn(found, F.coalesce(items(F.col(column)), F.array().cast("array<string>")))
        .withColumns({
            vocab.flag_name(prefix, name): F.array_contains(F.col(found), name) for name in names
        })
        .drop(found)
    )


def _normalised(
    column: str, key: Callable[[Column], Column], decide: Callable[[Column], Column]
) -> Callable[[DataFrame], DataFrame]:
    """Step that replaces a text by ``decide`` of its key; the key is worked out once a row."""
    name = f"_{column}_key"

    def step(df: DataFrame) -> DataFrame:
        keyed = df.withColumn(name, key(F.col(column)))
        return keyed.withColumn(column, decide(F.col(name))).drop(name)

    step.__name__ = f"with_{column}"
    return step


with_district = _normalised("district", plain, district)
with_building_type = _normalised("building_type", plain, building_type)
with_layout = _normalised("layout", plain, layout)
with_bathroom = _normalised("bathroom", plain_without_dots, bathroom)
with_renovation = _normalised("renovation", plain, renovation)


def with_housing_type(df: DataFrame) -> DataFrame:
    return df.withColumn("housing_type", housing_type(F.col("housing_type")))


def with_amenity_flags(df: DataFrame) -> DataFrame:
    return with_flags(df, "amenities", "amenity", vocab.AMENITIES)


def with_nearby_flags(df: DataFrame) -> DataFrame:
    return with_flags(df, "nearby", "nearby", vocab.NEARBY_PLACES)


def with_near_metro(df: DataFrame) -> DataFrame:
    return df.withColumn("near_metro_mentioned", near_metro(F.col("description"), F.col("url")))
