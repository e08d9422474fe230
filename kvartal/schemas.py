"""Column contracts of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

from kvartal import vocab

TEXT, NUMBER, WHOLE, FLAG, DAY = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.DateType(),
)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


BRONZE = _struct(
    ("listing_id", TEXT),
    ("source", TEXT),
    ("seller_type", TEXT),
    ("housing_type", TEXT),
    ("region", TEXT),
    ("district", TEXT),
    ("rooms", NUMBER),
    ("living_area_m2", NUMBER),
    ("kitchen_area_m2", NUMBER),
    ("total_area_m2", NUMBER),
    ("floor", NUMBER),
    ("total_floors", NUMBER),
    ("building_type", TEXT),
    ("layout", TEXT),
    ("build_year", NUMBER),
    ("ceiling_height", NUMBER),
    ("bathroom", TEXT),
    ("furnished", NUMBER),
    ("renovation", TEXT),
    ("commission", NUMBER),
    ("amenities", TEXT),
    ("nearby", TEXT),
    ("negotiable", NUMBER),
    ("price", NUMBER),
    ("currency", TEXT),
    ("published_date", TEXT),
    ("description", TEXT),
    ("date_scraped", TEXT),
    ("url", TEXT),
)

# Columns the cleaning steps read; the scan of bronze stops at these.
NOT_CLEANED = ("living_area_m2", "kitchen_area_m2")
CLEANING_INPUT = tuple(name for name in BRONZE.fieldNames() if name not in NOT_CLEANED)

# Longest text each bronze column may hold.
BRONZE_LENGTHS = {
    "listing_id": 64,
    "source": 100,
    "seller_type": 50,
    "housing_type": 50,
    "region": 100,
    "district": 100,
    "building_type": 100,
    "layout": 100,
    "renovation": 100,
    "currency": 10,
    "published_date": 20,
    "date_scraped": 20,
}

SILVER_FLAGS = (*vocab.AMENITY_FLAGS, *vocab.NEARBY_FLAGS, "near_metro_mentioned")

SILVER = _struct(
    ("listing_id", TEXT),
    ("price_usd", T.DecimalType(12, 2)),
    ("price_per_sqr", T.DecimalType(10, 2)),
    ("listing_type", TEXT),
    ("commission", FLAG),
    ("negotiable", FLAG),
    ("published_date", DAY),
    ("date_scraped", DAY),
    ("url", TEXT),
    ("description", TEXT),
    ("housing_type", TEXT),
    ("rooms", WHOLE),
    ("total_area_m2", T.DecimalType(10, 2)),
    ("floor", WHOLE),
    ("total_floors", WHOLE),
    ("building_type", TEXT),
    ("layout", TEXT),
    ("build_year", WHOLE),
    ("age", WHOLE),
    ("ceiling_height", T.DecimalType(3, 2)),
    ("bathroom", TEXT),
    ("furnished", FLAG),
    ("renovation", TEXT),
    ("seller_type", TEXT),
    ("region", TEXT),
    ("district", TEXT),
    *((flag, FLAG) for flag in SILVER_FLAGS),
)
SILVER_LENGTHS = {"listing_type": 4, "housing_type": 15}
LOAD_TIME = "dwh_created_date"

PROPERTY_KEY = ("housing_type", "building_type", "layout", "bathroom", "furnished", "renovation")
LOCATION_KEY = ("region", "district")
MEASURES = (
    "rooms", "total_area_m2", "floor", "total_floors", "build_year", "age", "ceiling_height",
    "seller_type", "price_usd", "price_per_sqr", "listing_type", "negotiable", "commission",
    "date_scraped", "description",
)
ATTRIBUTES = (
    *vocab.AMENITY_FLAGS,
    "nearby_bus_stop", "nearby_cafe", "nearby_clinic", "nearby_entertainment",
    "nearby_green_area", "nearby_hospital", "nearby_kindergarten", "nearby_park",
    "nearby_parking", "nearby_playground", "near_metro_mentioned", "nearby_restaurant",
    "nearby_school", "nearby_shops", "nearby_supermarket",
)


def _kinds(names: tuple[str, ...]) -> list[tuple[str, T.DataType]]:
    return [(name, SILVER[name].dataType) for name in names]


DIM_PROPERTY = _struct(("property_dim_id", WHOLE), *_kinds(PROPERTY_KEY))
DIM_LOCATION = _struct(("location_dim_id", WHOLE), *_kinds(LOCATION_KEY))
FACT_LISTING = _struct(
    ("listing_id", TEXT), ("property_dim_id", WHOLE), ("location_dim_id", WHOLE),
    *_kinds(MEASURES),
)
LISTING_ATTRIBUTES = _struct(("listing_id", TEXT), *_kinds(ATTRIBUTES))
GOLD = {
    "dim_property": DIM_PROPERTY,
    "dim_location": DIM_LOCATION,
    "fact_listing": FACT_LISTING,
    "dim_listing_attributes": LISTING_ATTRIBUTES,
}
