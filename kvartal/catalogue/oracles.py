"""The same results in DuckDB SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

from kvartal import fixtures, vocab

AS_OF_YEAR = 2026
AS_OF_TEXT, DAY_BEFORE_TEXT = "03/05/2026", "02/05/2026"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _map(table) -> str:
    return f"MAP {{{', '.join(f'{_text(k)}: {_text(str(v))}' for k, v in table.items())}}}"


SPACES = _text(vocab.WHITE_SPACE)


def _strip(column: str) -> str:
    return f"trim({column}, {SPACES})"


def _rules(value: str, rules) -> str:
    parts = []
    for label, contains, equals in rules:
        tests = [f"v = {_text(e)}" for e in equals] + [f"contains(v, {_text(c)})" for c in contains]
        parts.append(f"WHEN {' OR '.join(tests)} THEN {'NULL' if label is None else _text(label)}")
    # v is bound once by a one-element list
    return (
        f"(list_transform([{value}], lambda v: CASE WHEN v IS NULL THEN NULL "
        f"{' '.join(parts)} ELSE NULL END))[1]"
    )


def _score(words, weight_url: str = "url", text: str = "description") -> str:
    def count(column: str) -> str:
        return (
            f"len(list_filter({_list(words)}, "
            f"lambda w: contains(lower(coalesce({column}, '')), w)))"
        )

    return f"CAST(3 * {count(text)} + {count(weight_url)} AS INTEGER)"


def _district(column: str) -> str:
    key = _strip(f"lower({column})")
    bare = key
    for noise in (" district", " район", "ский", "ская", "ское"):
        bare = f"replace({bare}, {_text(noise)}, '')"
    for letter, target in (
        ("ё", "yo"), ("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("щ", "shch"),
        ("ш", "sh"), ("ъ", ""), ("ь", ""), ("ю", "yu"), ("я", "ya"),
    ):
        bare = f"replace({bare}, {_text(letter)}, {_text(target)})"
    bare = f"translate({bare}, 'абвгдезийклмнопрстуфыэўқғҳ', 'abvgdeziyklmnoprstufyeoqgh')"
    bare = _strip(rf"regexp_replace({bare}, '\s+', ' ', 'g')")
    titled = (
        rf"array_to_string(list_transform(regexp_extract_all({bare}, '\p{{L}}+|\P{{L}}+'), "
        "lambda r: upper(r[1]) || r[2:]), '')"
    )
    known = f"{_map(vocab.DISTRICT_OVERRIDES)}[{key}]"
    return (
        f"CASE WHEN {key} = '' OR contains({key}, 'css') THEN NULL "
        f"WHEN {column} IS NULL THEN NULL ELSE coalesce({known}, {titled}) END"
    )


def _flag(items: str, name: str) -> str:
    return f"coalesce(list_contains({items}, {_text(name)}), false)"


def _items(column: str) -> str:
    return (
        f"list_transform(string_split({column}, ','), lambda i: "
        f"CASE lower({_strip('i')}) WHEN 'метро' THEN 'Metro' WHEN 'metro' THEN 'Metro' "
        f"ELSE {_strip('i')} END)"
    )


def _whole(column: str) -> str:
    return f"CASE WHEN {column} = floor({column}) THEN TRY_CAST({column} AS INTEGER) END"


def _bool(column: str) -> str:
    return f"coalesce(trunc({column}), 0) <> 0"


def _decimal(column: str, kind: str) -> str:
    return f"TRY_CAST(CAST({column} AS VARCHAR) AS DECIMAL({kind}))"


def _day(column: str, form: str) -> str:
    return f"CAST(CAST(try_strptime({column}, '{form}') AS DATE) AS VARCHAR)"


METRO = "coalesce(regexp_matches({c}, '(?i)metro|метро'), false)"
NEAR_METRO = f"{METRO.format(c='description')} OR {METRO.format(c='url')}"

AMENITY_COLUMNS = (
    ("amenity_air_conditioning", "Air Conditioning"), ("amenity_balcony", "Balcony"),
    ("amenity_cable_tv", "Cable TV"), ("amenity_internet", "Internet"),
    ("amenity_kitchen", "Kitchen"), ("amenity_refrigerator", "Refrigerator"),
    ("amenity_tv", "TV"), ("amenity_telephone", "Telephone"),
    ("amenity_washing_machine", "Washing Machine"),
)
NEARBY_COLUMNS = (
    ("nearby_bus_stop", "Bus Stop"), ("nearby_cafe", "Cafe"), ("nearby_clinic", "Clinic"),
    ("nearby_entertainment", "Entertainment"), ("nearby_green_area", "Green Area"),
    ("nearby_hospital", "Hospital"), ("nearby_kindergarten", "Kindergarten"),
    ("nearby_park", "Park"), ("nearby_parking", "Parking"), ("nearby_playground", "Playground"),
    ("nearby_restaurant", "Restaurant"), ("nearby_school", "School"), ("nearby_shops", "Shops"),
    ("nearby_supermarket", "Supermarket"),
)
AMENITIES = ", ".join(f"{_flag(_items('amenities'), v)} AS {c}" for c, v in AMENITY_COLUMNS)
NEARBY = ", ".join(f"{_flag(_items('nearby'), v)} AS {c}" for c, v in NEARBY_COLUMNS)
FLAG_NAMES = ", ".join(c for c, _ in (*AMENITY_COLUMNS, *NEARBY_COLUMNS))

STEPS = {
    "listings": fixtures.LISTINGS_SQL,
    "firsts": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id
          ORDER BY price NULLS LAST, total_area_m2 NULLS LAST, description NULLS LAST,
                   url NULLS LAST, source NULLS LAST, seller_type NULLS LAST,
                   housing_type NULLS LAST, region NULLS LAST, district NULLS LAST,
                   rooms NULLS LAST, floor NULLS LAST, total_floors NULLS LAST,
                   building_type NULLS LAST, layout NULLS LAST, build_year NULLS LAST,
                   ceiling_height NULLS LAST, bathroom NULLS LAST, furnished NULLS LAST,
                   renovation NULLS LAST, commission NULLS LAST, amenities NULLS LAST,
                   nearby NULLS LAST, negotiable NULLS LAST, currency NULLS LAST,
                   published_date NULLS LAST) AS rn FROM listings) WHERE rn = 1""",
    "priced": """
        SELECT * FROM (SELECT *, CASE WHEN currency = 'UZS'
            THEN round_even(price / 12700 * 10, 0) / 10 ELSE price END AS price_usd
          FROM firsts WHERE price IS NOT NULL) WHERE price_usd > 0""",
    "scored": f"""
        SELECT *, {_score(vocab.RENT_WORDS)} AS rent, {_score(vocab.SALE_WORDS)} AS sale
        FROM priced""",
    "judged": """
        SELECT * EXCLUDE (rent, sale), CASE
            WHEN sale > rent THEN CASE WHEN price_usd >= 2000 THEN 'Sale' ELSE 'Rent' END
            WHEN price_usd >= 10000 THEN 'Sale' ELSE 'Rent' END AS listing_type,
          rent = 0 AND sale = 0 AS silent
        FROM scored""",
    "roomy": "SELECT * FROM judged WHERE rooms < 7",
    "valued": """
        SELECT *, CASE WHEN listing_type = 'Sale' AND total_area_m2 > 0
            THEN round_even(price_usd / total_area_m2 * 100, 0) / 100 END AS price_per_sqr
        FROM roomy""",
    "sane": "SELECT * FROM valued WHERE NOT coalesce(price_per_sqr > 50000, false)",
    "quartiles": """
        SELECT quantile_cont(total_area_m2, 0.25) AS q1, quantile_cont(total_area_m2, 0.75) AS q3
        FROM sane""",
    "bounds": """
        SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS fence,
               greatest(q1 - 1.5 * (q3 - q1), 10.0::DOUBLE) AS lower, 400.0::DOUBLE AS upper
        FROM quartiles""",
    "usual": """
        SELECT sane.* FROM sane, bounds WHERE total_area_m2 >= bounds.lower
          AND total_area_m2 <= bounds.upper""",
    "low": "SELECT * FROM usual WHERE total_floors < 100",
    "exact": f"""
        SELECT listing_id,
          {_decimal('price_usd', '12,2')} AS price_usd,
          {_decimal('price_per_sqr', '10,2')} AS price_per_sqr,
          listing_type, {_bool('commission')} AS commission, {_bool('negotiable')} AS negotiable,
          {_day('published_date', '%d/%m/%Y')} AS published_date,
          {_day('date_scraped', '%Y-%m-%d')} AS date_scraped,
          url, description,
          {_map(vocab.HOUSING_TYPES)}[housing_type] AS housing_type,
          {_whole('rooms')} AS rooms,
          {_decimal('total_area_m2', '10,2')} AS total_area_m2,
          {_whole('floor')} AS floor, {_whole('total_floors')} AS total_floors,
          {_rules(_strip('lower(building_type)'), vocab.BUILDING_RULES)} AS building_type,
          {_rules(_strip('lower(layout)'), vocab.LAYOUT_RULES)} AS layout,
          {_whole('build_year')} AS build_year,
          CASE WHEN build_year >= 1900 AND build_year <= {AS_OF_YEAR}
            THEN CAST({AS_OF_YEAR} - build_year AS INTEGER) END AS age,
          {_decimal('ceiling_height', '3,2')} AS ceiling_height,
          {_rules(f"replace({_strip('lower(bathroom)')}, '.', '')", vocab.BATHROOM_RULES)}
            AS bathroom,
          {_bool('furnished')} AS furnished,
          {_rules(_strip('lower(renovation)'), vocab.RENOVATION_RULES)} AS renovation,
          seller_type, region, {_district('district')} AS district,
          {AMENITIES}, {NEARBY}, {NEAR_METRO} AS near_metro_mentioned
        FROM low""",
    "silver": """
        SELECT * REPLACE (CAST(price_usd AS DOUBLE) AS price_usd,
          CAST(price_per_sqr AS DOUBLE) AS price_per_sqr,
          CAST(total_area_m2 AS DOUBLE) AS total_area_m2,
          CAST(ceiling_height AS DOUBLE) AS ceiling_height) FROM exact""",
    "dim_property": """
        SELECT CAST(row_number() OVER (ORDER BY housing_type NULLS FIRST,
            building_type NULLS FIRST, layout NULLS FIRST, bathroom NULLS FIRST,
            furnished NULLS FIRST, renovation NULLS FIRST) AS INTEGER) AS property_dim_id, *
        FROM (SELECT DISTINCT housing_type, building_type, layout, bathroom, furnished,
                renovation FROM exact)""",
    "dim_location": """
        SELECT CAST(row_number() OVER (ORDER BY region NULLS FIRST, district NULLS FIRST)
            AS INTEGER) AS location_dim_id, *
        FROM (SELECT DISTINCT region, district FROM exact)""",
    "fact": """
        SELECT s.listing_id, p.property_dim_id, l.location_dim_id, s.rooms, s.total_area_m2,
          s.floor, s.total_floors, s.build_year, s.age, s.ceiling_height, s.seller_type,
          s.price_usd, s.price_per_sqr, s.listing_type, s.negotiable, s.commission,
          s.date_scraped, s.description
        FROM exact s
        JOIN dim_property p ON s.housing_type IS NOT DISTINCT FROM p.housing_type
          AND s.building_type IS NOT DISTINCT FROM p.building_type
          AND s.layout IS NOT DISTINCT FROM p.layout
          AND s.bathroom IS NOT DISTINCT FROM p.bathroom
          AND s.furnished IS NOT DISTINCT FROM p.furnished
          AND s.renovation IS NOT DISTINCT FROM p.renovation
        JOIN dim_location l ON s.region IS NOT DISTINCT FROM l.region
          AND s.district IS NOT DISTINCT FROM l.district""",
    "texts": fixtures.TEXTS_SQL,
    "landed": """
        SELECT * FROM listings WHERE right(published_date, 4) BETWEEN '1992' AND '1997'""",
    "url_ids": r"""
        SELECT *, coalesce(nullif(regexp_extract(url, '-ID([A-Za-z0-9]+)\.html', 1), ''), url)
            AS url_id FROM listings""",
    "seen": r"""
        SELECT listing_id AS seen FROM landed WHERE listing_id IS NOT NULL UNION
        SELECT coalesce(nullif(regexp_extract(url, '-ID([A-Za-z0-9]+)\.html', 1), ''), url)
        FROM landed WHERE url IS NOT NULL""",
}
NEEDS = {
    "firsts": "listings", "priced": "firsts", "scored": "priced", "judged": "scored",
    "roomy": "judged", "valued": "roomy", "sane": "valued", "quartiles": "sane",
    "bounds": "quartiles", "usual": "bounds", "low": "usual", "exact": "low",
    "silver": "exact", "dim_property": "exact", "dim_location": "dim_property",
    "fact": "dim_location", "texts": "listings", "landed": "listings", "url_ids": "listings",
    "seen": "landed",
}


def _after(last: str, select: str, *more: str) -> str:
    """``select`` over the chain of steps up to ``last``."""
    chain = []

    def add(step: str) -> None:
        if step in NEEDS:
            add(NEEDS[step])
        if step not in chain:
            chain.append(step)

    for step in (last, *more):
        add(step)
    steps = ", ".join(f"{step} AS ({STEPS[step]})" for step in chain)
    return f"WITH {steps} {select}"


def _of_listings(*columns: str) -> str:
    return _after("listings", f"SELECT listing_id, url, {', '.join(columns)} FROM listings")


def _checks(layer: str, source: str, rows: list[tuple[str, str, str, float, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS \"check\", '{severity}' AS severity, "
        f"CAST(o AS DOUBLE) AS observed, {threshold}::DOUBLE AS threshold, o {passed} AS passed "
        f"FROM (SELECT {observed} AS o {source})"
        for name, severity, observed, threshold, passed in rows
    )


BRONZE_CHECKS = _checks("bronze", "FROM listings", [
    ("not empty", "fail", "count(*)", 1, ">= 1"),
    ("listing_id or url missing", "fail",
     "count(*) FILTER (listing_id IS NULL OR url IS NULL)", 0, "= 0"),
    ("text too long", "fail",
     "count(*) FILTER (length(listing_id) > 64 OR length(source) > 100 "
     "OR length(seller_type) > 50 OR length(housing_type) > 50 OR length(region) > 100 "
     "OR length(district) > 100 OR length(building_type) > 100 OR length(layout) > 100 "
     "OR length(renovation) > 100 OR length(currency) > 10 OR length(published_date) > 20 "
     "OR length(date_scraped) > 20)", 0, "= 0"),
])
SILVER_CHECKS = _checks("silver", "FROM exact", [
    ("duplicate listing_id", "warn", "count(*) - count(DISTINCT listing_id)", 0, "= 0"),
    ("price_usd not positive", "fail", "count(*) FILTER (price_usd <= 0)", 0, "= 0"),
    ("rooms negative", "fail", "count(*) FILTER (rooms < 0)", 0, "= 0"),
    ("build_year implausible", "fail",
     f"count(*) FILTER (build_year < 1900 OR build_year > {AS_OF_YEAR} + 1)", 0, "= 0"),
    ("listing_id missing", "fail", "count(*) FILTER (listing_id IS NULL)", 0, "= 0"),
    ("price_usd missing", "fail", "count(*) FILTER (price_usd IS NULL)", 0, "= 0"),
    ("text too long", "fail",
     "count(*) FILTER (length(listing_type) > 4 OR length(housing_type) > 15)", 0, "= 0"),
])
GOLD_CHECKS = " UNION ALL ".join([
    _checks("gold", "", [
        ("fact rows differ from silver", "fail",
         "(SELECT count(*) FROM fact) - (SELECT count(*) FROM exact)", 0, "= 0"),
        ("fact not empty", "fail", "(SELECT count(*) FROM fact)", 1, ">= 1"),
        ("dim_property to fact ratio", "fail",
         "(SELECT count(*) FROM dim_property)::DOUBLE / (SELECT count(*) FROM fact)", 0.5,
         "<= 0.5"),
        ("fact listing_id repeated", "fail",
         "(SELECT count(*) - count(DISTINCT listing_id) FROM fact)", 0, "= 0"),
        ("attributes listing_id repeated", "fail",
         "(SELECT count(*) - count(DISTINCT listing_id) FROM exact)", 0, "= 0"),
        ("dim_property combination repeated", "fail",
         "(SELECT count(*) FROM dim_property) - (SELECT count(*) FROM (SELECT DISTINCT "
         "housing_type, building_type, layout, bathroom, furnished, renovation "
         "FROM dim_property))", 0, "= 0"),
        ("dim_location combination repeated", "fail",
         "(SELECT count(*) FROM dim_location) - (SELECT count(*) FROM (SELECT DISTINCT "
         "region, district FROM dim_location))", 0, "= 0"),
        ("property_dim_id repeated", "fail",
         "(SELECT count(*) - count(DISTINCT property_dim_id) FROM dim_property)", 0, "= 0"),
        ("location_dim_id repeated", "fail",
         "(SELECT count(*) - count(DISTINCT location_dim_id) FROM dim_location)", 0, "= 0"),
        ("property_dim_id not found", "fail",
         "(SELECT count(*) FROM fact WHERE property_dim_id NOT IN "
         "(SELECT property_dim_id FROM dim_property))", 0, "= 0"),
        ("location_dim_id not found", "fail",
         "(SELECT count(*) FROM fact WHERE location_dim_id NOT IN "
         "(SELECT location_dim_id FROM dim_location))", 0, "= 0"),
        ("attributes listing_id not found", "fail",
         "(SELECT count(*) FROM exact WHERE listing_id NOT IN "
         "(SELECT listing_id FROM fact))", 0, "= 0"),
    ]),
])

FIRST_REASON = """
    CASE WHEN price IS NULL THEN 'missing price'
      WHEN price_usd <= 0 THEN 'price not positive'
      WHEN rooms IS NULL THEN 'rooms unknown' WHEN rooms >= 7 THEN 'too many rooms'
      WHEN listing_id NOT IN (SELECT listing_id FROM sane) THEN 'overpriced'
      WHEN total_area_m2 IS NULL THEN 'area unknown'
      WHEN listing_id NOT IN (SELECT listing_id FROM usual) THEN 'area unusual'
      WHEN listing_id NOT IN (SELECT listing_id FROM low) THEN 'too many floors'
      ELSE 'kept' END
"""


def _coerced() -> str:
    number = r"TRY_CAST(replace(regexp_extract({t}, '[0-9.,]+'), ',', '.') AS DOUBLE)"
    ceiling = number.format(t="ceiling_height_text")
    translate = lambda field: (
        f"coalesce({_map(vocab.VALUE_TRANSLATIONS[field])}[lower({_strip(field + '_text')})], "
        f"{_strip(field + '_text')})"
    )
    return f"""
      SELECT listing_id, url,
        TRY_CAST(regexp_extract(rooms_text, '[0-9]+') AS DOUBLE) AS rooms,
        {number.format(t='total_area_m2_text')} AS total_area_m2,
        CASE WHEN m >= 2 AND m <= 6 THEN CAST(printf('%.2f', m) AS DOUBLE) END AS ceiling_height,
        CAST(list_max(list_transform(
          regexp_extract_all(build_year_text, '\\b(?:19|20)[0-9]{{2}}\\b'),
          lambda y: CAST(y AS INTEGER))) AS DOUBLE) AS build_year,
        CASE WHEN lower(furnished_text) IN ('да', 'yes', 'есть', 'мебелирована') THEN 1.0::DOUBLE
          ELSE 0.0::DOUBLE END AS furnished,
        CASE WHEN lower(trim(commission_text)) IN ('нет', 'no', 'без комиссии', '0')
          THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS commission,
        {translate('renovation')} AS renovation, {translate('layout')} AS layout
      FROM (SELECT *, CASE WHEN c >= 100 THEN c / 100 WHEN c >= 10 THEN c / 10 ELSE c END AS m
            FROM (SELECT *, {ceiling} AS c FROM texts))"""


def _tagged(column: str, lead: str, table) -> str:
    cases = " ".join(f"WHEN contains(lower(i), {_text(k)}) THEN {_text(v)}" for k, v in table.items())
    phrase = f"nullif(regexp_extract({column}, '(?i)^{lead}\\s*(.+)', 1), '')"
    mapped = (
        f"list_transform(list_transform(string_split({phrase}, ','), lambda r: {_strip('r')}), "
        f"lambda i: CASE {cases} ELSE i END)"
    )
    return (
        f"CASE WHEN {phrase} IS NOT NULL THEN "
        f"array_to_string(list_transform(list_filter(list_zip({mapped}, "
        f"range(1, len({mapped}) + 1)), lambda z: list_position({mapped}, z[1]) = z[2]), "
        "lambda z: z[1]), ', ') END"
    )


def _place(column: str) -> str:
    spaced = rf"trim(regexp_replace({column}, '\s+', ' ', 'g'), ' ,')"
    bare = (
        rf"regexp_replace({spaced}, "
        r"'(?i)^(?:Продажа|Аренда(?:\s+долгосрочная)?|Посуточно)\s*-\s*', '')"
    )
    key = f"replace(replace(lower({bare}), '’', ''''), '`', '''')"
    return (
        f"CASE WHEN {bare} = '' OR list_contains({_list(vocab.BREADCRUMB_SKIP)}, {key}) "
        f"THEN NULL ELSE coalesce({_map(vocab.PLACE_ALIASES)}[{key}], {bare}) END"
    )


PUBLISHED = f"""
    SELECT listing_id, url, CASE
        WHEN raw = '' THEN NULL
        WHEN lower(raw) LIKE '%сегодня%' OR lower(raw) LIKE '%today%' THEN '{AS_OF_TEXT}'
        WHEN lower(raw) LIKE '%вчера%' OR lower(raw) LIKE '%yesterday%' THEN '{DAY_BEFORE_TEXT}'
        WHEN regexp_matches(lower(raw), '[0-9]{{1,2}}\\s+[а-яa-z]+\\s+[0-9]{{4}}')
          THEN lpad(regexp_extract(lower(raw), '([0-9]{{1,2}})\\s+([а-яa-z]+)\\s+([0-9]{{4}})', 1),
                 2, '0') || '/' || lpad(coalesce({_map(vocab.MONTHS)}[regexp_extract(lower(raw),
                 '([0-9]{{1,2}})\\s+([а-яa-z]+)\\s+([0-9]{{4}})', 2)], '1'), 2, '0') || '/' ||
               regexp_extract(lower(raw), '([0-9]{{1,2}})\\s+([а-яa-z]+)\\s+([0-9]{{4}})', 3)
        ELSE raw END AS published_date
    FROM (SELECT *, trim(regexp_extract(published_text, '(?i)(?:Опубликовано|Published)\\s*(.+)', 1))
            AS raw FROM texts)
"""

# What a page rendered from a listing has to give back.
TRANSLATED = lambda field: (
    f"coalesce({_map(vocab.VALUE_TRANSLATIONS[field])}[lower({field})], {field}) AS {field}"
    if field in vocab.VALUE_TRANSLATIONS else f"{_strip(field)} AS {field}"
)
TIDY_LIST = lambda column: (
    f"array_to_string(list_transform(string_split({column}, ','), lambda i: {_strip('i')}), ', ') "
    f"AS {column}"
)
PAGE_FIELDS = f"""
    SELECT regexp_extract(url, '-ID([A-Za-z0-9]+)\\.html', 1) AS listing_id, 'web' AS source,
      seller_type, {TRANSLATED('housing_type')},
      CASE WHEN floor > 6 THEN 'Tashkent City' WHEN district IS NOT NULL THEN region END AS region,
      coalesce(trim(regexp_replace(district, '\\s+', ' ', 'g'), ' ,'),
        CASE WHEN floor > 6 THEN region ELSE 'Юнусабадскийрайон' END) AS district,
      rooms, floor(total_area_m2) + 0.5 AS total_area_m2, floor(total_area_m2 / 2) + 0.25 AS living_area_m2,
      rooms * 2 AS kitchen_area_m2, floor, total_floors,
      {TRANSLATED('building_type')}, {TRANSLATED('layout')},
      CASE WHEN build_year BETWEEN 1900 AND 2099 THEN build_year END AS build_year,
      CASE WHEN ceiling_height <= 6 THEN ceiling_height END AS ceiling_height,
      {TRANSLATED('bathroom')},
      CASE WHEN furnished = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS furnished,
      {TRANSLATED('renovation')},
      CASE WHEN commission = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS commission,
      {TIDY_LIST('amenities')}, {TIDY_LIST('nearby')}, negotiable,
      floor(price) AS price,
      CASE WHEN price IS NULL THEN 'USD' ELSE currency END AS currency,
      CASE published_date WHEN 'today' THEN '{AS_OF_TEXT}' ELSE published_date END
        AS published_date,
      CASE WHEN floor = 9 AND (length({_strip('description')}) <= 60 OR regexp_matches(
          left({_strip('description')}, 50), '\\d{{5,}}|USD|UZS|у\\.е\\.')) THEN NULL
        WHEN length({_strip('description')}) > 20 THEN {_strip('description')} END AS description,
      date_scraped, url
    FROM listings
"""
# What the data script of a listing has to give back: a label without a value is an empty text.
_GIVEN = lambda field: TRANSLATED(field).replace(f"({field}", f"(coalesce({field}, '')").replace(
    f", {field})", f", coalesce({field}, ''))")
JSON_FIELDS = f"""
    SELECT listing_id, 'web' AS source, seller_type,
      {_GIVEN('housing_type')}, region, trim(regexp_replace(district, '\\s+', ' ', 'g'), ' ,') AS district,
      rooms, floor(total_area_m2 / 2) + 0.25 AS living_area_m2, rooms * 2 AS kitchen_area_m2,
      floor(total_area_m2) + 0.5 AS total_area_m2, floor, total_floors,
      {_GIVEN('building_type')}, {_GIVEN('layout')},
      CASE WHEN build_year BETWEEN 1900 AND 2099 THEN build_year END AS build_year,
      CASE WHEN ceiling_height <= 6 THEN ceiling_height END AS ceiling_height, {_GIVEN('bathroom')},
      CASE WHEN furnished = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS furnished, {_GIVEN('renovation')},
      CASE WHEN commission = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS commission,
      NULL::VARCHAR AS amenities, NULL::VARCHAR AS nearby, 0.0::DOUBLE AS negotiable, price,
      CASE WHEN price IS NULL THEN 'USD' ELSE currency END AS currency, NULL::VARCHAR AS published_date,
      nullif({_strip('description')}, '') AS description, '2026-05-03' AS date_scraped, url
    FROM listings
"""

# The given pages: the last two links of the list name a place unless a region is known, and the
# description is the longest of the blocks, whose texts stand with one blank between them.
_TEXTS = lambda html: (
    f"array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace({html}, "
    f"'<!--.*?-->', '', 'g'), '<[^>]+>'), lambda x: {_strip(_UNESCAPED.format(t='x'))}), lambda x: x <> ''), ' ')"
)
_UNESCAPED = (
    "replace(replace(replace(replace(replace(replace({t}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
    "'&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
)
RAW_PAGES = f"""
WITH p AS (
    SELECT url, html, list_filter(list_transform(
        regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a [^>]*>([^<]*)</a>', 1),
        lambda a: {_place(_UNESCAPED.format(t='a'))}), lambda n: n IS NOT NULL) AS names,
      list_filter(list_transform([regexp_extract(html, '<div class="ad">(.*?)</div>', 1),
          regexp_extract(html, '(?s)<article>(.*)</article>', 1)], lambda b: {_TEXTS('b')}),
        lambda b: length(b) > 60 AND NOT regexp_matches(left(b, 50), '\\d{{5,}}|USD|UZS|у\\.е\\.')) AS blocks
    FROM pages),
k AS (
    SELECT *, list_position(list_transform(names, lambda n: list_contains({_list(vocab.REGIONS)}, lower(n))), true) AS known
    FROM p)
SELECT CASE WHEN regexp_matches(url, '-ID[A-Za-z0-9]+\\.html')
      THEN regexp_extract(url, '-ID([A-Za-z0-9]+)\\.html', 1) ELSE url END AS listing_id, 'web' AS source,
    CASE WHEN known > 0 THEN names[known] WHEN len(names) >= 2 THEN names[-2] END AS region,
    CASE WHEN known > 0 THEN CASE WHEN known < len(names) THEN names[-1] END
      WHEN len(names) >= 2 THEN names[-1] END AS district,
    (list_sort(list_transform(blocks, lambda b: struct_pack(n := -length(b), b := b))))[1].b AS description,
    {", ".join(f"NULL::VARCHAR AS {c}" for c in ("seller_type", "housing_type", "building_type", "layout", "bathroom", "renovation", "amenities", "nearby", "published_date"))},
    {", ".join(f"NULL::DOUBLE AS {c}" for c in ("rooms", "living_area_m2", "kitchen_area_m2", "total_area_m2", "floor", "total_floors", "build_year", "ceiling_height", "furnished", "commission", "price"))},
    0.0::DOUBLE AS negotiable, 'USD' AS currency, '2026-05-03' AS date_scraped, url
FROM k
"""

_value = lambda column, expression: _of_listings(f"{expression} AS {column}")

ORACLES: dict[str, str] = {
    "listings_dedup": _after("firsts", "SELECT * FROM firsts"),
    "duplicate_report": _after(
        "listings", "SELECT count(*) - count(DISTINCT listing_id) AS listings FROM listings"),
    "duplicate_numbers": _after(
        "listings", "SELECT listing_id, row_number() OVER (PARTITION BY listing_id "
        "ORDER BY listing_id) AS check_duplicates FROM listings"),
    "price_usd": _after("listings", """
        SELECT * FROM (SELECT listing_id, url, CASE WHEN currency = 'UZS'
          THEN round_even(price / 12700 * 10, 0) / 10 ELSE price END AS price_usd
        FROM listings) WHERE price_usd > 0"""),
    "rooms_filter": _after("listings", "SELECT listing_id, url, rooms FROM listings WHERE rooms < 7"),
    "floors_filter": _after(
        "listings", "SELECT listing_id, url, total_floors FROM listings WHERE total_floors < 100"),
    "price_per_sqr": _after(
        "sane", "SELECT listing_id, price_usd, listing_type, price_per_sqr FROM sane"),
    "area_bounds": _after("bounds", "SELECT * FROM bounds"),
    "area_outliers": _after("usual", "SELECT listing_id, total_area_m2 FROM usual"),
    "drop_reasons": _after("low", f"""
        , judged_firsts AS (SELECT f.*, CASE WHEN currency = 'UZS'
            THEN round_even(price / 12700 * 10, 0) / 10 ELSE price END AS price_usd FROM firsts f)
        SELECT {FIRST_REASON} AS reason, count(*) AS listings FROM judged_firsts GROUP BY 1
        UNION ALL
        SELECT 'duplicate', count(*) - count(DISTINCT listing_id) FROM listings"""),
    "building_age": _of_listings("build_year", f"""
        CASE WHEN build_year >= 1900 AND build_year <= {AS_OF_YEAR}
          THEN {AS_OF_YEAR} - build_year END AS age"""),
    "keyword_scores": _of_listings(
        f"{_score(vocab.RENT_WORDS)} AS rent_score", f"{_score(vocab.SALE_WORDS)} AS sale_score"),
    "document_keyword_scores": f"""
        SELECT doc_id, {_score(vocab.RENT_WORDS, 'source', 'text')} AS rent_score,
          {_score(vocab.SALE_WORDS, 'source', 'text')} AS sale_score FROM documents""",
    "listing_type": _after("judged", "SELECT listing_id, price_usd, listing_type FROM judged"),
    "listing_type_counts": _after(
        "judged", "SELECT listing_type, count(*) AS listings FROM judged GROUP BY 1"),
    "no_keyword_listings": _after(
        "judged", "SELECT count(*) FILTER (silent) AS no_signal FROM judged"),
    "housing_type_map": _value("housing_type", f"{_map(vocab.HOUSING_TYPES)}[housing_type]"),
    "district_clean": _value("district", _district("district")),
    "district_list": _after("listings", f"""
        SELECT DISTINCT d AS district FROM (SELECT {_district('district')} AS d FROM listings)
        WHERE d IS NOT NULL"""),
    "district_null_counts": _after("listings", f"""
        SELECT count(*) FILTER (district IS NULL) AS nulls_before,
          count(*) FILTER (({_district('district')}) IS NULL) AS nulls_after FROM listings"""),
    "building": _value(
        "building_type", _rules(_strip("lower(building_type)"), vocab.BUILDING_RULES)),
    "layout": _value("layout", _rules(_strip("lower(layout)"), vocab.LAYOUT_RULES)),
    "bathroom": _value("bathroom", _rules(
        f"replace({_strip('lower(bathroom)')}, '.', '')", vocab.BATHROOM_RULES)),
    "renovation": _value(
        "renovation", _rules(_strip("lower(renovation)"), vocab.RENOVATION_RULES)),
    "renovation_counts": _after("listings", f"""
        SELECT r AS renovation, count(listing_id) AS listings FROM (SELECT listing_id,
          {_rules(_strip('lower(renovation)'), vocab.RENOVATION_RULES)} AS r FROM listings)
        WHERE r IS NOT NULL GROUP BY 1"""),
    "amenity_flags": _of_listings(AMENITIES),
    "nearby_flags": _of_listings(NEARBY),
    "multi_value_items": _of_listings(
        f"array_to_string({_items('amenities')}, ', ') AS amenities",
        f"array_to_string(list_filter({_items('nearby')}, lambda i: list_contains("
        f"{_list([v for _, v in NEARBY_COLUMNS] + ['Metro'])}, i)), ', ') AS nearby"),
    "near_metro": _of_listings(f"{NEAR_METRO} AS near_metro_mentioned"),
    "silver_types": _of_listings(
        f"{_bool('commission')} AS commission", f"{_bool('negotiable')} AS negotiable",
        f"{_bool('furnished')} AS furnished", f"{_whole('floor')} AS floor",
        f"{_whole('total_floors')} AS total_floors", f"{_whole('rooms')} AS rooms",
        f"{_whole('build_year')} AS build_year",
        f"CAST({_decimal('total_area_m2', '10,2')} AS DOUBLE) AS total_area_m2",
        f"CAST({_decimal('ceiling_height', '3,2')} AS DOUBLE) AS ceiling_height",
        f"{_day('published_date', '%d/%m/%Y')} AS published_date",
        f"{_day('date_scraped', '%Y-%m-%d')} AS date_scraped"),
    "silver_full": _after("silver", "SELECT * FROM silver"),
    "rejected_values": _after("silver", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (b.{c} IS NOT NULL AND s.{c} IS NULL) "
        "AS rejected FROM low_with_age b JOIN silver s USING (listing_id)"
        for c in ("price_usd", "price_per_sqr", "published_date", "date_scraped", "rooms",
                  "total_area_m2", "floor", "total_floors", "build_year", "age",
                  "ceiling_height"))).replace(" SELECT 'price_usd'", f""",
        low_with_age AS (SELECT *, CASE WHEN build_year >= 1900 AND build_year <= {AS_OF_YEAR}
          THEN {AS_OF_YEAR} - build_year END AS age FROM low) SELECT 'price_usd'""", 1),
    "dim_property": _after("dim_property", "SELECT * FROM dim_property"),
    "dim_location": _after("dim_location", "SELECT * FROM dim_location"),
    "fact_listing": _after("fact", """
        SELECT * REPLACE (CAST(price_usd AS DOUBLE) AS price_usd,
          CAST(price_per_sqr AS DOUBLE) AS price_per_sqr,
          CAST(total_area_m2 AS DOUBLE) AS total_area_m2,
          CAST(ceiling_height AS DOUBLE) AS ceiling_height) FROM fact"""),
    "listing_attributes": _after(
        "exact", f"SELECT listing_id, {FLAG_NAMES}, near_metro_mentioned FROM exact"),
    "star_price_by_district": _after("fact", """
        SELECT region, district, housing_type, count(*) AS listings,
          CAST(sum(price_per_sqr) AS DOUBLE) / count(price_per_sqr) AS avg_price_per_sqr
        FROM fact JOIN dim_location USING (location_dim_id) JOIN dim_property USING (property_dim_id)
        WHERE listing_type = 'Sale' GROUP BY ALL"""),
    "sale_price_by_region": _after("sane", f"""
        SELECT region, count(*) AS listings, CAST(sum(p) AS DOUBLE) / count(p) AS avg_price_per_sqr
        FROM (SELECT region, {_decimal('price_per_sqr', '10,2')} AS p FROM sane
              WHERE listing_type = 'Sale') GROUP BY 1"""),
    "layer_checks": _after("fact", f"{BRONZE_CHECKS} UNION ALL {SILVER_CHECKS} UNION ALL {GOLD_CHECKS}"),
    "failing_rows": _after("listings", """
        SELECT listing_id, CASE WHEN price > 0 THEN price END AS price, url, source, published_date
        FROM listings WHERE listing_id IS NULL OR url IS NULL OR NOT coalesce(price > 0, false)
        ORDER BY listing_id NULLS FIRST, url NULLS FIRST LIMIT 5"""),
    "seen_keys": _after("url_ids", """
        SELECT listing_id AS seen FROM listings WHERE listing_id IS NOT NULL UNION
        SELECT url_id FROM url_ids WHERE url_id IS NOT NULL"""),
    "skip_seen": _after("seen", """
        SELECT min(url) AS url FROM url_ids u
        WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.seen = u.url_id) GROUP BY url_id""",
        "url_ids"),
    "append_new": _after("seen", """
        SELECT listing_id, url FROM landed UNION ALL
        SELECT listing_id, url FROM (SELECT listing_id, url, row_number() OVER (
            PARTITION BY url_id ORDER BY url, listing_id) AS rn FROM url_ids u
          WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.seen = u.url_id)) WHERE rn = 1""",
        "url_ids"),
    "sample_100": "SELECT * FROM documents ORDER BY doc_id LIMIT 100",
    "csv_roundtrip": _after("listings", """
        SELECT * REPLACE (CASE WHEN negotiable = 1 THEN coalesce(nearby, '') ELSE nearby END
          AS nearby) FROM listings"""),
    "csv_split_roundtrip": _after("listings", """
        SELECT * REPLACE (CASE WHEN negotiable = 1 THEN coalesce(nearby, '') ELSE nearby END
          AS nearby) FROM listings"""),
    "page_links": r"""
        SELECT page_id, CAST(position - 1 AS INTEGER) AS position, url FROM (
          SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY first) AS position
          FROM (SELECT page_id, url, min(i) AS first FROM (
            SELECT page_id, i, split_part(CASE WHEN href[1] = '/' THEN 'https://example.uz' || href
              ELSE href END, '?', 1) AS url
            FROM (SELECT page_id, unnest(h) AS href, unnest(range(1, len(h) + 1)) AS i FROM (
              SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages))
            WHERE contains(href, '/')) GROUP BY 1, 2))""",
    "listing_links": _after("listings", """
        SELECT unnest(['https://example.uz' || split_part(url, 'https://example.uz', 2),
            'https://other.example/d/obyavlenie/' || listing_id || '.html']) AS url,
          unnest([0::INTEGER, 1::INTEGER]) AS position FROM listings"""),
    "canonical_url": """
        SELECT page_id, split_part(CASE WHEN url[1] = '/' THEN 'https://example.uz' || url
          ELSE url END, '?', 1) AS url FROM pages""",
    "listing_id_from_url": _after("listings", r"""
        SELECT url, CASE WHEN regexp_matches(url, '-ID[A-Za-z0-9]+\.html')
          THEN regexp_extract(url, '-ID([A-Za-z0-9]+)\.html', 1) ELSE url END AS listing_id
        FROM (SELECT url FROM listings UNION ALL SELECT url FROM pages)"""),
    "field_coercion": _after("texts", _coerced()),
    "price_text": _after("texts", r"""
        SELECT listing_id, url, TRY_CAST(replace(regexp_replace(
            regexp_extract(price_text, '[0-9\s]+(?:[.,][0-9]+)?'), '\s', '', 'g'), ',', '.')
            AS DOUBLE) AS price,
          CASE WHEN price_text LIKE '%сум%' THEN 'UZS' WHEN price_text LIKE '%руб%' THEN 'RUB'
            WHEN price_text LIKE '%€%' THEN 'EUR' WHEN price_text LIKE '%£%' THEN 'GBP'
            ELSE 'USD' END AS currency FROM texts"""),
    "published_date": _after("texts", PUBLISHED),
    "place_names": _after("texts", f"""
        SELECT listing_id, url, place, coalesce(list_contains({_list(vocab.REGIONS)},
          lower({_place('place')})), false) AS is_region
        FROM (SELECT listing_id, url, {_place('place_text')} AS place FROM texts)"""),
    "tags": _after("texts", f"""
        SELECT listing_id, url,
          {_tagged('amenity_text', vocab.AMENITY_LEAD, vocab.AMENITY_TAGS)} AS amenities,
          {_tagged('nearby_text', vocab.NEARBY_LEAD, vocab.NEARBY_TAGS)} AS nearby FROM texts"""),
    "json_fields": _after("listings", JSON_FIELDS),
    "page_fields": _after("listings", PAGE_FIELDS),
    "raw_page_listings": RAW_PAGES,
}

# A run takes the listings of houses from 1900 to next year.
_likely_years = lambda name: ORACLES[name].replace(
    fixtures.LISTINGS_SQL, f"SELECT * FROM ({fixtures.LISTINGS_SQL}) WHERE build_year BETWEEN 1900 AND {AS_OF_YEAR} + 1"
)
ORACLES |= {
    "run_checks": _likely_years("layer_checks"),
    "run_silver": _likely_years("silver_full"),
    "run_gold_served": _likely_years("star_price_by_district"),
    "incremental_silver": ORACLES["silver_full"],
    "merged_area_bounds": ORACLES["area_bounds"],
    "landing_batches": ORACLES["append_new"],
    "skip_seen_by_index": ORACLES["skip_seen"],
    "compacted_batches": _after("listings", "SELECT listing_id, url, price FROM listings"),
    "retained_runs": _after("listings", """
        SELECT 'published' AS state, 3::BIGINT AS runs, count(*) FILTER (rooms < 9) AS listings FROM listings
        UNION ALL SELECT 'held', 2, count(*) FILTER (rooms < 2) FROM listings
        UNION ALL SELECT 'released', 1, count(*) FILTER (rooms < 9) FROM listings"""),
    "sample_file": ORACLES["sample_100"],
}
