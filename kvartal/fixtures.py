"""Listing-shaped bronze rows derived from the given tables, for tests and benches.

One SQL text that Spark and DuckDB both run unchanged. Every lineitem becomes a
listing; the whole text of a document describes the listings of the order that
bears its number, and a document whose number no order with lines bears becomes a
listing of its own. The word lists are picked so that every branch of the cleaners,
repeated ids, missing and zero prices, blank lists and missing districts occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kvartal.session import compiled_methods

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LISTINGS_SQL = """
SELECT 'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS listing_id,
 'synthetic' AS source,
 split_part('private|business', '|', CAST(l_suppkey % 2 AS INT) + 1) AS seller_type,
 NULLIF(split_part('new building|resale|Новостройка|новостройка|Новостройка.|Вторичка,кирпичный дом.|другое|', '|', CAST(l_orderkey % 8 AS INT) + 1), '') AS housing_type,
 r_name AS region,
 NULLIF(split_part('Mirzo-Ulugbek District|Алмазарский район|  МИРАБАД |Щербинка ский  район|css-12|yangi-hayot o''rta|', '|', CAST(n_nationkey % 7 AS INT) + 1), '') AS district,
 CASE WHEN p_size % 11 = 0 THEN NULL ELSE CAST(p_size % 9 AS DOUBLE) END AS rooms,
 CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN 900.0 ELSE l_quantity * 2 + p_size END AS total_area_m2,
 CAST(1 + p_size % 9 AS DOUBLE) AS floor,
 CASE WHEN p_size = 10 THEN NULL WHEN p_size = 12 THEN 120.0 ELSE CAST(1 + p_size % 20 AS DOUBLE) END AS total_floors,
 NULLIF(split_part('Кирпичный дом|Monolith|ПАНЕЛЬ|газоблок|дерево|css-1x|unknown|', '|', CAST(l_partkey % 8 AS INT) + 1), '') AS building_type,
 NULLIF(split_part('раздельная|смежно-раздельная|смежная|studio|free layout|пентхаус|-|', '|', CAST(l_orderkey % 8 AS INT) + 1), '') AS layout,
 CAST(1890 + l_partkey % 150 AS DOUBLE) AS build_year,
 CAST(CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 7 = 1 THEN 15.0 ELSE 2.5 + (l_suppkey % 7) * 0.25 END AS DOUBLE) AS ceiling_height,
 NULLIF(split_part('раздельный|совмещенный|2 санузла|2.|css|-|combined|', '|', CAST(l_partkey % 8 AS INT) + 1), '') AS bathroom,
 CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(l_suppkey % 2 AS DOUBLE) END AS furnished,
 NULLIF(split_part('нет|без ремонта|shell and core|pre-finished|авторский|евроремонт|average condition|', '|', CAST(l_partkey % 8 AS INT) + 1), '') AS renovation,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber % 2 AS DOUBLE) END AS commission,
 NULLIF(split_part('Internet, Balcony|Balcony,TV , Kitchen|Air Conditioning||Washing Machine, Internet', '|', CAST(l_orderkey % 5 AS INT) + 1), '') AS amenities,
 NULLIF(split_part('School, Park|метро, Bus Stop|Metro,Junk|', '|', CAST(l_orderkey % 4 AS INT) + 1), '') AS nearby,
 CAST(l_linenumber % 3 % 2 AS DOUBLE) AS negotiable,
 CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN 0.0
      WHEN l_returnflag = 'R' THEN l_extendedprice / 50
      WHEN l_linestatus = 'O' AND l_orderkey % 29 = 0 THEN l_extendedprice * 100
      WHEN l_linestatus = 'F' THEN l_extendedprice * 12700 ELSE l_extendedprice END AS price,
 CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'F' THEN 'UZS' WHEN l_suppkey % 10 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
 CASE WHEN l_orderkey % 71 = 0 THEN '31/02/2026' WHEN l_orderkey % 73 = 0 THEN 'today' ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) END AS published_date,
 CASE WHEN l_orderkey % 79 = 0 THEN NULL ELSE coalesce(d.text || ' ', '') || split_part('СДАЁТСЯ|Sotiladi kvartira|ijaraga beriladi|Продажа, ипотека|метро рядом|МЕТРО for rent|x', '|', CAST(l_partkey % 7 AS INT) + 1) END AS description,
 '2026-05-03' AS date_scraped,
 'https://example.uz/d/obyavlenie/' || split_part('kvartira-sotiladi|sdam-ijara|near-metro|flat', '|', CAST(l_suppkey % 4 AS INT) + 1) || '-ID' || CAST(l_orderkey AS STRING) || 'x' || CAST(l_linenumber AS STRING) || '.html' AS url
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN documents d ON d.doc_id = l_orderkey
UNION ALL
SELECT 'D' || CAST(doc_id AS STRING), 'synthetic', 'private', 'resale', 'ASIA', 'Mirzo-Ulugbek District',
 CAST(doc_id % 9 AS DOUBLE), CAST(40 + doc_id % 60 AS DOUBLE), CAST(1 + doc_id % 9 AS DOUBLE),
 CAST(9 + doc_id % 3 AS DOUBLE), 'Monolith', 'studio', CAST(1960 + doc_id % 60 AS DOUBLE), CAST(2.75 AS DOUBLE),
 'combined', CAST(doc_id % 2 AS DOUBLE), 'евроремонт', CAST(doc_id % 2 AS DOUBLE), 'Internet, Balcony', 'School, Park',
 CAST(doc_id % 2 AS DOUBLE), CAST(20000 + doc_id AS DOUBLE), 'USD', '03/05/1996', text, '2026-05-03',
 'https://example.uz/d/obyavlenie/document-ID0d' || CAST(doc_id AS STRING) || '.html'
FROM documents WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = doc_id)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Spark SQL: the same joins with what moves kept narrow. A customer meets the orders, which are fewer
# than the lines, so a line moves to its order only once, and texts are made after that.
_JOINS = LISTINGS_SQL[LISTINGS_SQL.index("FROM lineitem"):LISTINGS_SQL.index("UNION ALL")]
_NARROW_JOINS = """FROM (
  SELECT {lines} l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
   l_linestatus, p_size
  FROM lineitem JOIN part ON l_partkey = p_partkey
 )
JOIN (
  SELECT {orders} o_orderkey, o_orderdate, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
 ) ON l_orderkey = o_orderkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN documents d ON d.doc_id = l_orderkey
"""
_WITH_LINES = "(SELECT 1 FROM lineitem WHERE l_orderkey = doc_id)"
_NARROW_WITH_LINES = "(SELECT 1 FROM (SELECT {lines} l_orderkey FROM lineitem) WHERE l_orderkey = doc_id)"
#: listings in one shuffle partition, so that a task's memory does not grow with the tables
PARTITION_ROWS = 250_000


def narrow_listings_sql(partitions: int | None) -> str:
    """``LISTINGS_SQL`` with narrow joins; lines meet orders, and documents the numbers of orders with
    lines, in so many partitions, if a number is given."""
    hints = {
        side: f"/*+ REPARTITION({partitions}, {key}) */" if partitions else ""
        for side, key in (("lines", "l_orderkey"), ("orders", "o_orderkey"))
    }
    return LISTINGS_SQL.replace(_JOINS, _NARROW_JOINS.format(**hints)).replace(
        _WITH_LINES, _NARROW_WITH_LINES.format(**hints)
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like listings with the 27 columns the cleaning steps read.

    Where the session's shuffle partitions are too few for the lines (counted from the files'
    footers) their number is raised; run-time re-planning merges those that turn out small. The row of
    27 columns is a large method of generated code, which the JVM has to be able to compile.
    """
    used = ("lineitem", "orders", "part", "customer", "nation", "region", "documents")
    for name in used:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    compiled_methods(spark)
    setting = "spark.sql.shuffle.partitions"
    needed = -(-spark.table("lineitem").count() // PARTITION_ROWS)
    many = needed > int(spark.conf.get(setting))
    if many:
        spark.conf.set(setting, str(needed))
    return spark.sql(narrow_listings_sql(needed if many else None))


RUSSIAN_MONTHS = (
    "января|февраля|марта|апреля|мая|июня|июля|августа|сентября|октября|ноября|декабря"
)

# Spark SQL: a listing rendered as a page. Labels and values come as one text, as
# neighbours, and as neighbours of the element around; digit groups are set apart by a
# non-breaking blank; a short text carries the price. Upper floors lie in a known region, a
# place without links has a text, and the description is marked in one of four ways, or, on the
# ninth floor, not at all.
PAGE_SQL = rf"""
SELECT xxhash64(url) AS page_id, url, concat(
 '<!DOCTYPE html><html><head><title>page</title><script>var a = "<p>no</p>";</script></head><body>',
 '<nav><ul><li><a href="/">Главная</a></li><li><a href="/k">Квартиры</a></li>',
 CASE WHEN floor > 6 THEN '<li><a href="/t">Ташкент</a></li>' ELSE '' END,
 '<li><a href="/r">Продажа - ', region, '</a></li>',
 coalesce(concat('<li><a href="/d">', district, '</a></li>'), ''), '</ul></nav><!-- ad -->',
 '<div><strong>', coalesce(concat(
   CAST(CAST(floor(price) AS BIGINT) DIV 1000 AS STRING), '\u00a0',
   lpad(CAST(CAST(floor(price) AS BIGINT) % 1000 AS STRING), 3, '0'),
   CASE currency WHEN 'UZS' THEN ' сум' WHEN 'EUR' THEN ' €' ELSE ' у.е.' END), '-'), '</strong></div>',
 CASE WHEN negotiable = 1 THEN '<span>Договорная</span>' ELSE '' END,
 '<div><span>Опубликовано</span><span>',
 CASE WHEN published_date = 'today' THEN 'сегодня в 13:26' ELSE concat(
   CAST(CAST(split_part(published_date, '/', 1) AS INT) AS STRING), ' ',
   split_part('{RUSSIAN_MONTHS}', '|', CAST(split_part(published_date, '/', 2) AS INT)), ' ',
   split_part(published_date, '/', 3), ' г.') END, '</span></div>',
 CASE WHEN district IS NULL THEN '<span>Юнусабадский <b>район</b></span>' ELSE '' END,
 '<p>', CASE seller_type WHEN 'private' THEN 'Пользователь' ELSE 'Бизнес' END, '</p>',
 '<ul><li><p>Количество комнат: ', coalesce(CAST(CAST(rooms AS INT) AS STRING), 'нет'), '</p></li>',
 '<li><p>Этаж</p><p>', CAST(CAST(floor AS INT) AS STRING), '</p></li>',
 '<li><div><b>Этажность дома:</b></div><div>', coalesce(CAST(CAST(total_floors AS INT) AS STRING), '-'), '</div></li>',
 '<li><p>Общая площадь: ', coalesce(concat(CAST(CAST(total_area_m2 AS INT) AS STRING), ',5 м²'), '-'), '</p></li>',
 '<li><p>Жилая площадь: ', coalesce(concat(CAST(CAST(total_area_m2 / 2 AS INT) AS STRING), '.25 м²'), '-'), '</p></li>',
 '<li><div>Площадь кухни:</div><div>', coalesce(concat(CAST(CAST(rooms * 2 AS INT) AS STRING), ' м²'), '-'), '</div></li>',
 coalesce(concat('<li><p>Тип жилья: ', housing_type, '</p></li>'), ''),
 '<li><p>Год постройки/сдачи: сдан в ', CAST(CAST(build_year AS INT) AS STRING), ' году</p></li>',
 '<li><p>Высота потолков: ', coalesce(CAST(CAST(ceiling_height * 100 AS INT) AS STRING), '-'), '</p></li>',
 coalesce(concat('<li><p>Тип строения: ', building_type, '</p></li>'), ''),
 coalesce(concat('<li><p>Планировка: ', layout, '</p></li>'), ''),
 coalesce(concat('<li><p>Санузел</p><p>', bathroom, '</p></li>'), ''),
 coalesce(concat('<li><p>Ремонт: ', renovation, '</p></li>'), ''),
 '<li><p>Меблирована: ', CASE WHEN furnished = 1 THEN 'Да' ELSE 'Нет' END, '</p></li>',
 '<li><p>Комиссионные: ', CASE WHEN commission = 1 THEN 'Да' ELSE 'Нет' END, '</p></li></ul>',
 coalesce(concat('<p>В квартире есть: ', replace(replace(replace(amenities, 'Internet', 'Интернет'),
   'Balcony', 'Балкон'), 'Washing Machine', 'Стиральная машина'), '</p>'), ''),
 coalesce(concat('<p>Рядом есть: ', replace(replace(nearby, 'School', 'Школа'), 'Park', 'Парк'), '</p>'), ''),
 CASE WHEN floor = 9 THEN '<div><p>' ELSE CASE CAST(floor AS INT) % 4 WHEN 0 THEN '<div data-cy="ad_description"><p>'
   WHEN 1 THEN '<div itemprop="description"><p>' WHEN 2 THEN '<div id="ad-Description-1"><p>'
   ELSE '<div class="x the-Description"><p>' END END,
 coalesce(replace(replace(replace(description, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), ''),
 '</p></div><footer>end</footer></body></html>') AS html
FROM {{listings}}
"""

# Spark SQL: the same listing as the data script of an otherwise empty page, with every label.
_PARAMS = {
    "Количество комнат": "CAST(CAST(rooms AS INT) AS STRING)",
    "Этаж": "concat(CAST(CAST(floor AS INT) AS STRING), ' этаж')",
    "Этажность дома": "CAST(CAST(total_floors AS INT) AS STRING)",
    "Общая площадь": "concat(CAST(CAST(total_area_m2 AS INT) AS STRING), ',5 м²')",
    "Жилая площадь": "concat(CAST(CAST(total_area_m2 / 2 AS INT) AS STRING), '.25 м²')",
    "Площадь кухни": "concat(CAST(CAST(rooms * 2 AS INT) AS STRING), ' м²')",
    "Тип жилья": "housing_type",
    "Тип продавца": "CASE seller_type WHEN 'private' THEN 'Частное лицо' ELSE 'Бизнес' END",
    "Тип строения": "building_type",
    "Планировка": "layout",
    "Год постройки": "concat('сдан в ', CAST(CAST(build_year AS INT) AS STRING))",
    "Высота потолков": "CAST(CAST(ceiling_height * 100 AS INT) AS STRING)",
    "Санузел": "bathroom",
    "Меблирована": "CASE furnished WHEN 1 THEN 'Да' WHEN 0 THEN 'Нет' END",
    "Ремонт": "renovation",
    "Комиссионные": "CASE WHEN commission = 1 THEN 'Да' ELSE 'Нет' END",
    "unknown": "'x'",
}
DATA_PAGE_SQL = r"""
SELECT xxhash64(url) AS page_id, url, concat(
 '<html><head><script id="__NEXT_DATA__" type="application/json">',
 replace(to_json(named_struct('props', named_struct('pageProps', named_struct('ad', named_struct(
   'id', listing_id,
   'price', CASE WHEN price IS NOT NULL THEN named_struct('value', price, 'currency', currency) END,
   'description', description,
   'params', array(""" + ", ".join(
    f"named_struct('key', '{label}', 'value', named_struct('label', {value}))" for label, value in _PARAMS.items()
) + r"""),
   'location', named_struct('region', named_struct('name', region),
     'district', CASE WHEN negotiable = 1 THEN named_struct('name', district) END,
     'city', named_struct('name', district))))))), '</', '<\\/'),
 '</script></head><body></body></html>') AS html
FROM {listings}
"""


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all shuffle partitions: parsing pages costs more than moving them."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def pages(rows: DataFrame) -> DataFrame:
    """Listings rendered as ``(page_id, url, html)``."""
    return rows.sparkSession.sql(PAGE_SQL, listings=spread(rows))


def data_pages(rows: DataFrame) -> DataFrame:
    """Listings rendered as pages that hold nothing but their data script."""
    return rows.sparkSession.sql(DATA_PAGE_SQL, listings=spread(rows))


# Spark SQL and DuckDB: texts as a page would show them, with the forms the value parsers
# have to tell apart.
TEXTS_SQL = """
SELECT listing_id, url,
 CASE WHEN rooms IS NULL THEN 'нет' ELSE 'комнат: ' || CAST(CAST(rooms AS INT) AS STRING) || ' из 9' END AS rooms_text,
 CASE WHEN total_area_m2 IS NULL THEN '-' ELSE ' ' || CAST(CAST(total_area_m2 AS INT) AS STRING) || ',25 м²' END AS total_area_m2_text,
 CASE WHEN ceiling_height IS NULL THEN 'высокие'
      WHEN floor > 6 THEN CAST(CAST(ceiling_height * 100 AS INT) AS STRING) || ' см'
      WHEN floor > 3 THEN CAST(CAST(floor(ceiling_height * 10) AS INT) AS STRING)
      WHEN floor > 1 THEN CAST(CAST(2 + rooms % 4 AS INT) AS STRING) || ',' || lpad(CAST(CAST(build_year AS INT) * 7 % 1000 AS STRING), 3, '0')
      ELSE CAST(CAST(floor(ceiling_height) AS INT) AS STRING) || ',5 м' END AS ceiling_height_text,
 'начат 1980, сдан ' || CAST(CAST(build_year AS INT) AS STRING) || ' г.' AS build_year_text,
 CASE WHEN furnished IS NULL THEN 'частично' WHEN furnished = 1 THEN 'ДА' ELSE 'Нет' END AS furnished_text,
 CASE WHEN commission IS NULL THEN 'Без комиссии' WHEN commission = 1 THEN '50%' ELSE ' нет ' END AS commission_text,
 CASE WHEN renovation IS NULL THEN 'Черновая отделка' ELSE renovation END AS renovation_text,
 CASE WHEN layout IS NULL THEN 'Свободная' ELSE layout END AS layout_text,
 CASE WHEN price IS NULL THEN 'Договорная' ELSE
   CAST(CAST(floor(price) AS BIGINT) AS STRING) || CASE WHEN currency = 'UZS' THEN ' сум' WHEN currency = 'EUR' THEN ',5 €'
   WHEN negotiable = 1 THEN ' £' WHEN commission = 1 THEN ' руб.' ELSE ' у.е.' END END AS price_text,
 CASE WHEN published_date = 'today' THEN 'Опубликовановчера в 10:00'
      WHEN published_date = '31/02/2026' THEN 'Published Today at 9'
      WHEN split_part(published_date, '/', 2) = '02' THEN 'published ' || split_part(published_date, '/', 1) || ' brumaire ' || split_part(published_date, '/', 3)
      WHEN split_part(published_date, '/', 2) = '03' THEN 'Опубликовано давно'
      WHEN split_part(published_date, '/', 2) = '05' THEN 'Цена'
      ELSE 'Опубликовано ' || CAST(CAST(split_part(published_date, '/', 1) AS INT) AS STRING) || ' '
        || split_part('ЯНВАРЯ|x|x|апреля|x|июня|July|августа|Сентября|october|ноября|декабря', '|', CAST(split_part(published_date, '/', 2) AS INT))
        || ' ' || split_part(published_date, '/', 3) || ' г.' END AS published_text,
 split_part('Продажа - Ташкент|  Аренда долгосрочная  -  навои|Посуточно-Farg’ona|O`z|Квартиры|Tashkent City|, Чиланзарский  район ,|Самарканд|Republic of Karakalpakstan', '|', CAST(floor AS INT)) AS place_text,
 CASE WHEN amenities IS NOT NULL THEN 'в квартире есть: ' || replace(amenities, 'Internet', 'быстрый интернет, Интернет') END AS amenity_text,
 CASE WHEN nearby IS NULL THEN 'рядом нет' ELSE 'Рядом есть:' || replace(replace(nearby, 'School', 'Остановка, остановки'), 'Park', 'Парковка') END AS nearby_text
FROM listings
"""

# Spark SQL: a category page that links a listing twice, beside links that do not count.
CATEGORY_PAGE_SQL = """
SELECT xxhash64(url) AS page_id, url, concat(
 '<html><body><a href="/nedvizhimost/">x</a><!-- <a href="/d/obyavlenie/old-ID1.html">x</a> -->',
 '<div><a class="t" href="', substring(url, 19), '?reason=a&amp;b=1"><b>', listing_id, '</b></a>',
 '<a href=', chr(39), url, chr(39), '>again</a><a name="top">x</a>',
 '<a data-x="a>b" href="https://other.example/d/obyavlenie/', listing_id, '.html?x">',
 '</a></div><script>var s = "<a href=/d/obyavlenie/js-ID2.html>";</script></body></html>') AS html
FROM {listings}
"""


def texts(rows: DataFrame) -> DataFrame:
    """Listings as texts for the value parsers."""
    rows.createOrReplaceTempView("listings")
    return rows.sparkSession.sql(TEXTS_SQL)


def category_pages(rows: DataFrame) -> DataFrame:
    """One category page per listing."""
    return rows.sparkSession.sql(CATEGORY_PAGE_SQL, listings=rows)
