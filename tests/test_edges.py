"""Edge rows per cleaning step."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kvartal import vocab
from kvartal.operators import accounting, categories, listings
from kvartal.plans import silver
from rows import bronze, column, numbered

TODAY = date(2026, 5, 3)


def kept(df):
    return sorted(int(r[0]) for r in df.select("listing_id").collect())


def test_first_row_wins_by_order_and_nulls_come_last(spark):
    rows = bronze(
        spark, {"price": None, "url": "u1"}, {"price": 100.0, "url": "u2"},
        {"price": 100.0, "url": "u0"}, {"listing_id": None}, {"listing_id": None},
    )
    found = {r.listing_id: (r.price, r.url) for r in listings.first_per_listing(rows).collect()}
    assert found["a"] == (100.0, "u0")
    assert len(found) == 2 and None in found


def test_price_in_dollars(spark):
    cases = [
        (12700.0, "UZS", 1.0), (600.0, "UZS", None), (100.0, "EUR", 100.0), (0.0, "USD", None),
        (-5.0, "USD", None), (None, "USD", None), (3175.0, "UZS", 0.2), (4445.0, "UZS", 0.4),
        (7.0, None, 7.0),
    ]
    rows = bronze(spark, *(
        {"listing_id": str(i), "price": p, "currency": c} for i, (p, c, _) in enumerate(cases)
    ))
    got = {int(r.listing_id): r.price_usd for r in listings.priced(rows).collect()}
    assert got == {i: usd for i, (_, _, usd) in enumerate(cases) if usd is not None}


def test_other_rates_can_be_given(spark):
    rows = bronze(spark, {"price": 200.0, "currency": "RUB"}, {"price": 5.0, "currency": "UZS"})
    got = {r.currency: r.price_usd for r in listings.priced(rows, {"RUB": 80}).collect()}
    assert got == {"RUB": 2.5, "UZS": 5.0}


@pytest.mark.parametrize("text, price, expected", [
    ("Sotiladi", 1999.99, "Rent"), ("Sotiladi", 2000.0, "Sale"),
    ("ijaraga", 9999.99, "Rent"), ("ijaraga", 10000.0, "Sale"),
    ("for sale, for rent", 9999.0, "Rent"), ("for sale, for rent", 10000.0, "Sale"),
    (None, 9999.0, "Rent"), (None, 10000.0, "Sale"),
])
def test_listing_type(spark, text, price, expected):
    rows = bronze(spark, {"description": text, "price": price, "url": None})
    assert categories.with_listing_type(listings.priced(rows)).first().listing_type == expected


def test_keyword_scores(spark):
    rows = numbered(spark, "description", [
        "ijaraga beriladi", "сдам сдам СДАМ", "flat", "Продам. Ипотека", None,
    ], url="https://e.uz/sdam-for sale")
    scored = categories.with_keyword_scores(rows)
    assert column(scored, "rent_score") == [9, 3, 0, 0, 0]
    assert column(scored, "sale_score") == [1, 1, 1, 7, 1]


def test_housing_type_is_exact(spark):
    rows = numbered(spark, "housing_type", [
        "НОВОСТРОЙКА", "Новостройка.", "Вторичка,кирпичный дом.", "resale", None,
    ])
    assert column(categories.with_housing_type(rows), "housing_type") == [
        None, "new building", "resale", "resale", None,
    ]


def test_row_filters(spark):
    rooms = numbered(spark, "rooms", [None, 7.0, 6.0, -1.0, 6.5])
    assert kept(listings.with_few_rooms(rooms)) == [2, 3, 4]
    floors = numbered(spark, "total_floors", [None, 99.0, 100.0])
    assert kept(listings.with_few_floors(floors)) == [1]


def test_price_per_sqr(spark):
    cases = [
        ("Rent", 100000.0, 1.0, None, True), ("Sale", 100.0, 0.0, None, True),
        ("Sale", 100.0, None, None, True), ("Sale", 50000.0, 1.0, 50000.0, True),
        ("Sale", 50000.01, 1.0, 50000.01, False), ("Sale", 100.0, 3.0, 33.33, True),
    ]
    rows = spark.createDataFrame(
        [(str(i), *case[:3]) for i, case in enumerate(cases)],
        "listing_id string, listing_type string, price_usd double, total_area_m2 double",
    )
    priced = listings.with_price_per_sqr(rows)
    assert column(priced, "price_per_sqr") == [case[3] for case in cases]
    assert kept(listings.without_overpriced(priced)) == [
        i for i, case in enumerate(cases) if case[4]
    ]


def test_district(spark):
    cases = {
        "yunusabad district": "Yunusabad", "Алмазарский район": "Almazar",
        "Щербинка": "Shcherbinka", "yangi-hayot o'rta": "Yangi-Hayot O'Rta", "css-12": None,
        "  ": None, None: None, "2nd мкр": "2Nd Mkr", "Чиланзарский  район": "Chilanzar",
        "ский": "", "Ёлка ЪЬ щука": "Yolka Shchuka", "Қўқон ғҳ": "Qoqon Gh",
    }
    rows = numbered(spark, "district", list(cases))
    assert column(categories.with_district(rows), "district") == list(cases.values())


def test_area_bounds_and_filter(spark):
    areas = [None, 400.0, 400.01, 9.0, 10.0, 20.0, 100.0, 200.0, 300.0, 50.0]
    rows = numbered(spark, "total_area_m2", areas).select("listing_id", "total_area_m2")
    assert kept(listings.with_usual_area(rows)) == [1, 4, 5, 6, 7, 8, 9]


def test_area_fence_binds(spark):
    areas = [100.0 + i for i in range(100)] + [11.0]
    rows = numbered(spark, "total_area_m2", areas).select("listing_id", "total_area_m2")
    bounds = listings.area_bounds(rows).first()
    assert (bounds.q1, bounds.q3) == (124.0, 174.0)
    assert bounds.lower == bounds.fence == 49.0
    assert kept(listings.with_usual_area(rows)) == list(range(100))


@pytest.mark.parametrize("step, name, cases", [
    (categories.with_building_type, "building_type", {
        "ГАЗОБЛОК": "block", "кирпич-панель": "brick", "css-block": None, "other": None,
        " Monolith ": "monolith", "деревянный": "wood", None: None,
    }),
    (categories.with_layout, "layout", {
        "смежно-раздельная": "adjacent_separate", "смежная": "adjacent", "separate room": None,
        "separate": "separate", "-": None, "студия раздельная": "studio", "adjacent": "adjacent",
        "многоуровневая": "multi_level", "малосемейка": "small_family", "css": None,
        "Пентхаус свободная": "free_layout", "": None,
    }),
    (categories.with_bathroom, "bathroom", {
        "2.": "2+ bathrooms", "совмещенный": "combined", "-": None, "2 санузла раздельные":
        "2+ bathrooms", "раздельный": "separate", "css-2+": None, "1": None, "2 та": "2+ bathrooms",
        "алоҳида": "separate",
    }),
    (categories.with_renovation, "renovation", {
        "нет": "needs_renovation", "shell and core": "shell_and_core", "average condition":
        "average_condition", "есть": "average_condition", "без ремонта евро": "needs_renovation",
        "нет ремонта": None, "Дизайнерский евроремонт": "designer_renovation", "css": None,
        "предчистовая": "pre_finished", "yo‘q": "needs_renovation", "LUX": "euro_renovation",
    }),
])
def test_ordered_rules(spark, step, name, cases):
    assert column(step(numbered(spark, name, list(cases))), name) == list(cases.values())


def test_age(spark):
    rows = numbered(spark, "build_year", [1899.0, 1900.0, 2026.0, 2027.0, None])
    assert column(listings.with_age(rows, 2026), "age") == [None, 126.0, 0.0, None, None]


def test_flags_from_lists(spark):
    rows = numbered(spark, "nearby", ["School, Park ,метро,Junk", None, "", "Parking"])
    flagged = categories.with_flags(rows, "nearby", "nearby", vocab.NEARBY_PLACES)
    assert column(flagged, "nearby_school") == [True, False, False, False]
    assert column(flagged, "nearby_park") == [True, False, False, False]
    assert column(flagged, "nearby_parking") == [False, False, False, True]
    items = flagged.select("listing_id", F.array_join(
        categories.items(F.col("nearby"), (*vocab.NEARBY_PLACES, "Metro")), "|").alias("nearby"))
    assert column(items, "nearby")[0] == "School|Park|Metro"


def test_near_metro(spark):
    rows = bronze(
        spark, {"listing_id": "0", "description": "рядом МЕТРО", "url": "u"},
        {"listing_id": "1", "description": None, "url": "near-METRO"},
        {"listing_id": "2", "description": "x", "url": None},
    )
    assert column(categories.with_near_metro(rows), "near_metro_mentioned") == [True, True, False]


def test_types(spark):
    rows = bronze(
        spark,
        {"listing_id": "0", "commission": None, "furnished": 0.5, "negotiable": 1.0,
         "published_date": "31/02/2026", "rooms": 2.5, "ceiling_height": 10.0},
        {"listing_id": "1", "published_date": "3/5/2026", "price": 24.685, "total_area_m2": 60.0,
         "rooms": float("nan")},
        {"listing_id": "2", "published_date": "3/5/2026", "price": 24.685, "total_area_m2": 60.0},
    )
    found = {r.listing_id: r for r in silver.clean(rows, TODAY).collect()}
    assert set(found) == {"0", "2"}
    first = found["0"]
    assert (first.commission, first.furnished, first.negotiable) == (False, False, True)
    assert (first.published_date, first.rooms, first.ceiling_height) == (None, None, None)
    assert found["2"].published_date == date(2026, 5, 3)
    assert found["2"].price_usd == Decimal("24.69")
    lost = silver.rejected_values(silver.apply(
        silver.cleaning_input(rows), [listings.first_per_listing, listings.priced,
        categories.with_listing_type, listings.with_price_per_sqr,
        *silver.refining_steps(TODAY)],
    ))
    counts = {r.column: r.rejected for r in lost.collect()}
    assert (counts["published_date"], counts["rooms"], counts["ceiling_height"]) == (1, 1, 1)


def test_drop_reasons_add_up(spark):
    rows = bronze(
        spark, {"listing_id": "k"}, {"listing_id": "k"}, {"listing_id": "p", "price": None},
        {"listing_id": "z", "price": 0.0}, {"listing_id": "r", "rooms": None},
        {"listing_id": "s", "rooms": 9.0}, {"listing_id": "o", "price": 9e6},
        {"listing_id": "n", "total_area_m2": None}, {"listing_id": "w", "total_area_m2": 500.0},
        {"listing_id": "f", "total_floors": None},
    )
    found = {r.reason: r.listings for r in accounting.drop_reasons(rows).collect()}
    assert found == {
        "kept": 1, "duplicate": 1, "missing price": 1, "price not positive": 1,
        "rooms unknown": 1, "too many rooms": 1, "overpriced": 1, "area unknown": 1,
        "area unusual": 1, "too many floors": 1,
    }
