"""Silver to gold: dimensions are written before the fact looks up their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kvartal.operators import star
from kvartal.sources.publishing import write_table
from kvartal.sources.staging import stage


def star_schema(silver: DataFrame) -> dict[str, DataFrame]:
    """The four gold tables of a written silver table, staged; the jobs run at once."""
    properties = stage(star.dim_property(silver), "dim_property")
    locations = stage(star.dim_location(silver), "dim_location")
    return {
        "dim_property": properties,
        "dim_location": locations,
        "fact_listing": stage(star.fact_listing(silver, properties, locations), "fact_listing"),
        "dim_listing_attributes": stage(star.listing_attributes(silver), "dim_listing_attributes"),
    }


def write_gold(silver: DataFrame, root: str, run: str) -> dict[str, DataFrame]:
    """Write the four gold tables of a written silver table, dimensions first."""
    written = {}

    def write(name: str, df: DataFrame) -> None:
        written[name] = write_table(df, root, "gold", run, name)

    write("dim_property", star.dim_property(silver))
    write("dim_location", star.dim_location(silver))
    write(
        "fact_listing",
        star.fact_listing(silver, written["dim_property"], written["dim_location"]),
    )
    write("dim_listing_attributes", star.listing_attributes(silver))
    return written
