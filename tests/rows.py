"""Bronze rows for edge cases."""

from kvartal import schemas

DEFAULTS = {
    "listing_id": "a", "source": "web", "seller_type": "private", "region": "R",
    "district": "Chilanzar District", "rooms": 2.0, "total_area_m2": 50.0, "floor": 1.0,
    "total_floors": 5.0, "build_year": 2000.0, "ceiling_height": 2.7, "price": 30000.0,
    "currency": "USD", "published_date": "03/05/2026", "description": "for sale",
    "date_scraped": "2026-05-03", "url": "https://e.uz/d/obyavlenie/x-IDa.html",
}


def bronze(spark, *rows):
    """One row per dict; columns not given take a plain value that passes every filter."""
    names = schemas.BRONZE.fieldNames()
    full = [{**DEFAULTS, **row} for row in rows]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in full], schemas.BRONZE)


def numbered(spark, column, values, **more):
    """Rows that differ in one column, with ids 0, 1, 2, ..."""
    return bronze(
        spark, *({**more, "listing_id": str(i), column: v} for i, v in enumerate(values))
    )


def column(df, name, key="listing_id"):
    return [r[name] for r in sorted(df.select(key, name).collect(), key=lambda r: int(r[key]))]
