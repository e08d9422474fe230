"""Bronze to silver: the cleaning steps in their order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from kvartal import schemas, vocab
from kvartal.functions import numbers
from kvartal.operators import categories, listings

Step = Callable[[DataFrame], DataFrame]

SILVER_COLUMNS = tuple(schemas.SILVER.fieldNames())

WHOLE_NUMBERS = ("rooms", "floor", "total_floors", "build_year", "age")
FLAGS = ("commission", "negotiable", "furnished")
DAY_PATTERNS = {"published_date": "d/M/yyyy", "date_scraped": "yyyy-MM-dd"}
NUMBERS = tuple(
    f.name for f in schemas.BRONZE if f.dataType == schemas.NUMBER
    and f.name in schemas.CLEANING_INPUT
)


def cleaning_input(bronze: DataFrame) -> DataFrame:
    """The columns the steps read, with NaN turned into NULL."""
    return bronze.select(*(
        numbers.nothing_if_nan(F.col(c)).alias(c) if c in NUMBERS else F.col(c)
        for c in schemas.CLEANING_INPUT
    ))


def typed_column(name: str) -> Column:
    """A silver column in its type; what does not fit becomes NULL."""
    value, kind = F.col(name), schemas.SILVER[name].dataType
    if name in WHOLE_NUMBERS:
        value = numbers.whole(value)
    elif name in FLAGS:
        value = numbers.flag(value)
    elif kind == schemas.DAY:
        value = numbers.day(value, DAY_PATTERNS[name])
    elif isinstance(kind, T.DecimalType):
        value = value.try_cast(kind)
    return value


def typed(df: DataFrame, columns: Sequence[str] = SILVER_COLUMNS) -> DataFrame:
    """Silver columns, in order and in their types."""
    return df.select(*(typed_column(c).alias(c) for c in columns))


def sources_of(column: str) -> tuple[str, ...]:
    """The columns that a silver column is worked out from after the area bounds."""
    if column in vocab.AMENITY_FLAGS:
        return ("amenities",)
    if column in vocab.NEARBY_FLAGS:
        return ("nearby",)
    return {"age": ("build_year",), "near_metro_mentioned": ("description", "url")}.get(
        column, (column,)
    )


def narrowed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What the later steps need for the asked silver columns, and the area and floors."""
    needed = {"total_area_m2", "total_floors", *(s for c in columns for s in sources_of(c))}
    return df.select(*(c for c in df.columns if c in needed))


def priced_steps(per_usd: Mapping[str, float] | None = None) -> list[Step]:
    """Steps that decide which rows the area bounds are found on."""
    return [
        listings.first_per_listing,
        partial(listings.priced, per_usd=per_usd),
        categories.with_listing_type,
        categories.with_housing_type,
        listings.with_few_rooms,
        listings.with_price_per_sqr,
        listings.without_overpriced,
        categories.with_district,
    ]


def refining_steps(as_of: date, columns: Sequence[str] = SILVER_COLUMNS) -> list[Step]:
    """Steps after the area bounds that the asked columns need, each looking at one row."""
    makes = {
        categories.with_building_type: ("building_type",),
        categories.with_layout: ("layout",),
        partial(listings.with_age, year=as_of.year): ("age",),
        categories.with_bathroom: ("bathroom",),
        categories.with_renovation: ("renovation",),
        categories.with_amenity_flags: vocab.AMENITY_FLAGS,
        categories.with_nearby_flags: vocab.NEARBY_FLAGS,
        categories.with_near_metro: ("near_metro_mentioned",),
    }
    return [
        listings.with_few_floors,
        *(step for step, made in makes.items() if not set(made).isdisjoint(columns)),
    ]


def cleaning_steps(
    as_of: date,
    per_usd: Mapping[str, float] | None = None,
    columns: Sequence[str] = SILVER_COLUMNS,
) -> list[Step]:
    return [
        cleaning_input,
        *priced_steps(per_usd),
        partial(narrowed, columns=columns),
        partial(listings.with_usual_area, few_floors=True),
        *refining_steps(as_of, columns),
        partial(typed, columns=columns),
    ]


def apply(df: DataFrame, steps: list[Step]) -> DataFrame:
    return reduce(lambda rows, step: rows.transform(step), steps, df)


def clean(
    bronze: DataFrame,
    as_of: date,
    per_usd: Mapping[str, float] | None = None,
    columns: Sequence[str] = SILVER_COLUMNS,
) -> DataFrame:
    """Silver rows of a bronze table. ``as_of`` replaces the clock.

    With fewer ``columns`` the rows staged for the area bounds hold only what those need.
    """
    return apply(bronze, cleaning_steps(as_of, per_usd, columns))


def rejected_values(untyped: DataFrame) -> DataFrame:
    """Values that ``typed`` turns into NULL, counted per column in one pass.

    ``untyped`` holds the rows just before ``typed``.
    """
    names = [f.name for f in schemas.SILVER if f.dataType not in (schemas.TEXT, schemas.FLAG)]
    lost = untyped.agg(*(
        F.count_if(F.col(c).isNotNull() & typed_column(c).isNull()).alias(c) for c in names
    ))
    rows = F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(c).alias("rejected")) for c in names
    ))
    return lost.select(F.inline(rows))
