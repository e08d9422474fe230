"""Word lists, lookup tables and thresholds.

Everything in this module is a fixed value: results are only right when these
lists, maps and numbers are exactly what they are. Operators hold no literals
of their own; they read them from here.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """``label`` applies when a text holds one of ``contains`` or is one of ``equals``."""

    label: str | None
    contains: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()


# --------------------------------------------------------------------------
# Characters that count as white space when a text is stripped
# --------------------------------------------------------------------------
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# --------------------------------------------------------------------------
# money
# --------------------------------------------------------------------------
UNITS_PER_USD = {"UZS": 12700.0}
DEFAULT_CURRENCY = "USD"

# --------------------------------------------------------------------------
# thresholds
# --------------------------------------------------------------------------
RENT_MAX_PRICE = 2000
SALE_MIN_PRICE = 10000
ROOMS_BELOW = 7
MAX_PRICE_PER_SQR = 50000
MIN_AREA = 10
MAX_AREA = 400
IQR_FACTOR = 1.5
TOTAL_FLOORS_BELOW = 100
FIRST_BUILD_YEAR = 1900
MAX_DIM_TO_FACT_RATIO = 0.5
DESCRIPTION_WEIGHT = 3
URL_WEIGHT = 1

# --------------------------------------------------------------------------
# Keywords that speak for rent or for sale
# --------------------------------------------------------------------------
RENT_WORDS = (
    "сдаётся", "сдается", "сдам", "сдаю", "аренда", "аренду",
    "посуточно", "помесячно",
    "ижарага", "ижара", "ijaraga", "ijara", "ijaraga beriladi",
    "topshiriladi", "арендага",
    "for rent", "to rent", "lease", "tenant",
)
SALE_WORDS = (
    "продаётся", "продается", "продам", "продаю", "продажа",
    "сотилади", "sotiladi", "sotaman", "sotuv", "sotish",
    "ипотека", "рассрочка", "ipoteka",
    "for sale", "sell", "selling", "mortgage",
)

# --------------------------------------------------------------------------
# Category tables of the cleaning steps
# --------------------------------------------------------------------------
HOUSING_TYPES = {
    "new building": "new building",
    "resale": "resale",
    "Новостройка": "new building",
    "новостройка": "new building",
    "Новостройка.": "new building",
    "Вторичка,кирпичный дом.": "resale",
}

MARKUP_LEFTOVER = "css"

BUILDING_RULES = (
    Rule(None, contains=("css",)),
    Rule("brick", contains=("кирп", "brick")),
    Rule("panel", contains=("панел", "panel")),
    Rule("monolith", contains=("монолит", "monolith")),
    Rule("block", contains=("блок", "block", "газоблок")),
    Rule("wood", contains=("дерев",)),
)

LAYOUT_RULES = (
    Rule(None, contains=("css",), equals=("-", "")),
    Rule("studio", contains=("studio", "студ")),
    Rule("free_layout", contains=("free layout", "свобод")),
    Rule("penthouse", contains=("пентхаус", "penthouse")),
    Rule("multi_level", contains=("многоуров",)),
    Rule("small_family", contains=("малосем",)),
    Rule("adjacent_separate", contains=("смежно", "см-раз", "см раз", "сможно")),
    Rule("adjacent", contains=("смеж",)),
    Rule("separate", contains=("раздел", "раздель", "алоҳида", "alohida"), equals=("separate",)),
    Rule("adjacent", contains=("adjacent",)),
)

BATHROOM_RULES = (
    Rule(None, contains=("css",), equals=("", "-")),
    Rule(
        "2+ bathrooms",
        contains=("2+", "2 сан", "2 та", "3 сан", "4 сан"),
        equals=("2", "3", "4", "2 та"),
    ),
    Rule("separate", contains=("separate", "раздель", "раздел", "алоҳида", "alohida")),
    Rule("combined", contains=("combined", "совмещ", "совмеш", "совмещение")),
)

RENOVATION_RULES = (
    Rule(None, contains=("css",), equals=("", "-")),
    Rule(
        "needs_renovation",
        contains=("без ремонта", "требуется ремонт", "needs renovation", "ремонт керак"),
        equals=("йок", "йўқ", "yo'q", "yoq", "yuq", "yo‘q", "нет", "none", "no"),
    ),
    Rule("shell_and_core", contains=("shell", "core", "коробка", "чернов")),
    Rule("pre_finished", contains=("pre-finished", "white box", "предчист")),
    Rule("designer_renovation", contains=("designer", "дизайнер", "авторск", "haytec")),
    Rule("euro_renovation", contains=("euro", "евро", "люкс", "lux", "современ", "комфорт")),
    Rule(
        "average_condition",
        contains=(
            "average", "сред", "хорош", "яхши", "чистый", "космет",
            "как на фото", "с ремонтом",
        ),
        equals=("есть",),
    ),
)

# --------------------------------------------------------------------------
# District names
# --------------------------------------------------------------------------
DISTRICT_OVERRIDES = {
    "mirzo-ulugbek district": "Mirzo Ulugbek",
    "yunusabad district": "Yunusabad",
    "yakkasaray district": "Yakkasaray",
    "mirabad district": "Mirabad",
    "yashnabad district": "Yashnabad",
    "chilanzar district": "Chilanzar",
    "shaykhantakhur district": "Shaykhantakhur",
    "sergeli district": "Sergeli",
    "uchtepa district": "Uchtepa",
    "алмазарский район": "Almazar",
    "бектемирский район": "Bektemir",
    "мирабад": "Mirabad",
    "учтепа": "Uchtepa",
    "samarkand": "Samarkand",
    "bukhara": "Bukhara",
    "navoiy": "Navoiy",
}
DISTRICT_NOISE = (" district", " район", "ский", "ская", "ское")

CYRILLIC_TO_LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d",
    "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i",
    "й": "y", "к": "k", "л": "l", "м": "m", "н": "n",
    "о": "o", "п": "p", "р": "r", "с": "s", "т": "t",
    "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "",
    "э": "e", "ю": "yu", "я": "ya",
    "ў": "o", "қ": "q", "ғ": "g", "ҳ": "h",
}

# --------------------------------------------------------------------------
# Multi-value lists
# --------------------------------------------------------------------------
AMENITIES = (
    "Air Conditioning", "Balcony", "Cable TV", "Internet", "Kitchen",
    "Refrigerator", "TV", "Telephone", "Washing Machine",
)
NEARBY_PLACES = (
    "Bus Stop", "Cafe", "Clinic", "Entertainment", "Green Area", "Hospital",
    "Kindergarten", "Park", "Parking", "Playground", "Restaurant", "School",
    "Shops", "Supermarket",
)
ITEM_ALIASES = {"метро": "Metro", "metro": "Metro"}
METRO_PATTERN = "metro|метро"

# --------------------------------------------------------------------------
# Links and ids
# --------------------------------------------------------------------------
LISTING_LINK_MARK = "/d/obyavlenie/"
LISTING_ID_PATTERN = r"-ID([A-Za-z0-9]+)\.html"

# --------------------------------------------------------------------------
# Labels on a listing page and the column each one fills,
# in the order they are tried
# --------------------------------------------------------------------------
PAGE_LABELS = {
    "Тип жилья": "housing_type",
    "Тип объявителя": "seller_type",
    "Тип продавца": "seller_type",
    "Количество комнат": "rooms",
    "Жилая площадь": "living_area_m2",
    "Общая площадь": "total_area_m2",
    "Площадь кухни": "kitchen_area_m2",
    "Этаж": "floor",
    "Этажность дома": "total_floors",
    "Тип строения": "building_type",
    "Планировка": "layout",
    "Год постройки/сдачи": "build_year",
    "Год постройки": "build_year",
    "Year built": "build_year",
    "Год сдачи": "build_year",
    "Высота потолков": "ceiling_height",
    "Ceiling height": "ceiling_height",
    "Санузел": "bathroom",
    "Меблирована": "furnished",
    "Ремонт": "renovation",
    "Комиссионные": "commission",
}
COUNT_FIELDS = ("rooms", "floor", "total_floors")
AREA_FIELDS = ("living_area_m2", "total_area_m2", "kitchen_area_m2")
FURNISHED_WORDS = ("да", "yes", "есть", "мебелирована")
NO_COMMISSION_WORDS = ("нет", "no", "без комиссии", "0")
MIN_CEILING = 2.0
MAX_CEILING = 6.0

VALUE_TRANSLATIONS = {
    "housing_type": {
        "новостройки": "new building",
        "вторичный рынок": "resale",
        "вторичное": "resale",
    },
    "seller_type": {"частное лицо": "private", "бизнес": "business"},
    "building_type": {
        "кирпичный": "brick",
        "панельный": "panel",
        "монолитный": "monolith",
        "блочный": "block",
    },
    "layout": {
        "раздельная": "separate",
        "смежная": "adjacent",
        "свободная": "free layout",
        "студия": "studio",
    },
    "bathroom": {
        "раздельный": "separate",
        "раздельная": "separate",
        "совмещенный": "combined",
        "совмещённый": "combined",
        "2 санузла и более": "2+ bathrooms",
    },
    "renovation": {
        "евроремонт": "euro renovation",
        "авторский проект": "designer renovation",
        "средний": "average condition",
        "требует ремонта": "needs renovation",
        "черновая отделка": "shell and core",
        "предчистовая отделка": "pre-finished",
    },
}

# --------------------------------------------------------------------------
# Phrases on a listing page
# --------------------------------------------------------------------------
AMENITY_LEAD = "В квартире есть:"
AMENITY_TAGS = {
    "интернет": "Internet",
    "телефон": "Telephone",
    "холодильник": "Refrigerator",
    "телевизор": "TV",
    "кондиционер": "Air Conditioning",
    "кабельное": "Cable TV",
    "стиральная": "Washing Machine",
    "кухня": "Kitchen",
    "балкон": "Balcony",
}
NEARBY_LEAD = "Рядом есть:"
NEARBY_TAGS = {
    "больница": "Hospital",
    "поликлиника": "Clinic",
    "школа": "School",
    "детская площадка": "Playground",
    "детский сад": "Kindergarten",
    "остановка": "Bus Stop",
    "остановки": "Bus Stop",
    "парк": "Park",
    "зелёная зона": "Green Area",
    "зеленая зона": "Green Area",
    "развлекательные": "Entertainment",
    "ресторан": "Restaurant",
    "кафе": "Cafe",
    "стоянка": "Parking",
    "парковка": "Parking",
    "супермаркет": "Supermarket",
    "магазин": "Shops",
}
NEGOTIABLE_MARK = "договорн"
NEGOTIABLE_BELOW = 60
SELLER_WORDS = {
    "пользователь": "private",
    "частное лицо": "private",
    "бизнес": "business",
    "агент": "business",
    "агентство": "business",
}
SELLER_UP_TO = 60
PUBLISHED_MARKS = ("Опубликовано", "Published")
TODAY_WORDS = ("сегодня", "today")
YESTERDAY_WORDS = ("вчера", "yesterday")
MONTHS = {
    "января": 1, "февраля": 2, "марта": 3, "апреля": 4,
    "мая": 5, "июня": 6, "июля": 7, "августа": 8,
    "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12,
    "january": 1, "february": 2, "march": 3, "april": 4,
    "may": 5, "june": 6, "july": 7, "august": 8,
    "september": 9, "october": 10, "november": 11, "december": 12,
}
DISTRICT_WORD = "район"
DISTRICT_TEXT_BELOW = 80

# --------------------------------------------------------------------------
# Price texts. Markers are tried in this order.
# --------------------------------------------------------------------------
PRICE_TEXT_PATTERN = (
    r"[$€£]\s*[\d\s.,]+|[\d\s.,]+(?:у\.е\.|сум|UZS|USD|EUR|RUB|руб|\$|€|£)"
)
PRICE_TEXT_BELOW = 40
PRICE_NUMBER_PATTERN = r"[\d\s]+(?:[.,]\d+)?"
CURRENCY_MARKS = (
    ("UZS", ("сум", "uzs")),
    ("RUB", ("rub", "руб")),
    ("EUR", ("eur", "€")),
    ("GBP", ("gbp", "£")),
)

# --------------------------------------------------------------------------
# descriptions
# --------------------------------------------------------------------------
JSON_DESCRIPTION_LENGTH = 1000
PAGE_DESCRIPTION_LENGTH = 2000
DESCRIPTION_OVER = 20
BLOCK_OVER = 60
BLOCK_BELOW = 5000
NOT_A_DESCRIPTION = r"\d{5,}|USD|UZS|у\.е\."
NOT_A_DESCRIPTION_HEAD = 50

# --------------------------------------------------------------------------
# Place names in breadcrumbs
# --------------------------------------------------------------------------
BREADCRUMB_SKIP = (
    "главная", "недвижимость", "квартиры", "квартира",
    "дома", "продажа", "аренда", "uzbekistan", "olx",
    "o'z", "oz", "o‘z", "o`z", "узбекистан",
)
PLACE_PREFIX_PATTERN = r"^(?:Продажа|Аренда(?:\s+долгосрочная)?|Посуточно)\s*-\s*"
REGIONS = (
    "tashkent region",
    "tashkent city",
    "andijan region",
    "bukhara region",
    "fergana region",
    "jizzakh region",
    "khorezm region",
    "namangan region",
    "navoiy region",
    "kashkadarya region",
    "samarkand region",
    "sirdaryo region",
    "surxondaryo region",
    "republic of karakalpakstan",
)
PLACE_ALIASES = {
    "toshkent": "Tashkent City",
    "tashkent": "Tashkent City",
    "город ташкент": "Tashkent City",
    "ташкент": "Tashkent City",
    "ташкентская область": "Tashkent Region",
    "toshkent viloyati": "Tashkent Region",
    "andijon": "Andijan Region",
    "андижанская область": "Andijan Region",
    "buxoro": "Bukhara Region",
    "бухарская область": "Bukhara Region",
    "farg'ona": "Fergana Region",
    "fergana": "Fergana Region",
    "ферганская область": "Fergana Region",
    "jizzax": "Jizzakh Region",
    "джизакская область": "Jizzakh Region",
    "xorazm": "Khorezm Region",
    "хорезмская область": "Khorezm Region",
    "namangan": "Namangan Region",
    "наманганская область": "Namangan Region",
    "navoiy": "Navoiy Region",
    "навоийская область": "Navoiy Region",
    "навои\u0306ская область": "Navoiy Region",
    "навойская область": "Navoiy Region",
    "qashqadaryo": "Kashkadarya Region",
    "кашкадарьинская область": "Kashkadarya Region",
    "samarqand": "Samarkand Region",
    "самаркандская область": "Samarkand Region",
    "sirdaryo": "Sirdaryo Region",
    "сырдарьинская область": "Sirdaryo Region",
    "surxondaryo": "Surxondaryo Region",
    "сурхандарьинская область": "Surxondaryo Region",
    "qoraqalpog'iston": "Republic of Karakalpakstan",
    "каракалпакстан": "Republic of Karakalpakstan",
    "мирзо-улугбекский район": "Mirzo-Ulugbek District",
    "мирабадский район": "Mirabad District",
    "яккасарайский район": "Yakkasaray District",
    "юнусабадский район": "Yunusabad District",
    "шайхантахурский район": "Shaykhantakhur District",
    "чиланзарский район": "Chilanzar District",
    "яшнабадский район": "Yashnabad District",
    "сергелийский район": "Sergeli District",
    "учтепинский район": "Uchtepa District",
    "навои": "Navoiy",
    "бухара": "Bukhara",
    "самарканд": "Samarkand",
}


def flag_name(prefix: str, item: str) -> str:
    """Column name of the yes/no flag for one item of a multi-value list."""
    return f"{prefix}_{item.lower().replace(' ', '_')}"


AMENITY_FLAGS = tuple(flag_name("amenity", item) for item in AMENITIES)
NEARBY_FLAGS = tuple(flag_name("nearby", item) for item in NEARBY_PLACES)
