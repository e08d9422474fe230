"""Text expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from os.path import commonprefix

from pyspark.sql import Column, functions as F

from kvartal import vocab


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind, not just blanks."""
    return F.btrim(text, F.lit(vocab.WHITE_SPACE))


def _literal(value: object) -> str:
    if not isinstance(value, str):
        return str(value)
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def word_array(words: Iterable[str]) -> Column:
    """Literal array, sent to the JVM as one expression."""
    return F.expr(f"array({', '.join(_literal(word) for word in words)})")


def one_of(text: Column, words: Iterable[str]) -> Column:
    return F.array_contains(word_array(words), text)


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """Value of ``key`` in a literal table, NULL where it has none."""
    pairs = ", ".join(_literal(part) for pair in table.items() for part in pair)
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(word) for word in words))


def count_contained(text: Column, words: Sequence[str]) -> Column:
    """How many of the words the text holds; a word counts once.

    Words that begin alike are looked for only where their common beginning occurs,
    which saves most of the scans over a long text.
    """
    alike: dict[str, list[str]] = {}
    for word in words:
        alike.setdefault(word[:3], []).append(word)

    def count(whole: Column, group: list[str]) -> Column:
        return reduce(lambda a, b: a + b, (whole.contains(w).cast("int") for w in group))

    def counts(whole: Column) -> Column:
        parts = []
        for group in alike.values():
            found = count(whole, group)
            if len(group) > 1:
                found = F.when(whole.contains(commonprefix(group)), found).otherwise(0)
            parts.append(found)
        return reduce(lambda a, b: a + b, parts)

    return bound(text, counts)


def first_rule(text: Column, rules: Sequence[vocab.Rule]) -> Column:
    """Label of the first rule that holds for the text, else NULL."""
    chain = None
    for rule in rules:
        tests = []
        if rule.equals:
            tests.append(one_of(text, rule.equals))
        if rule.contains:
            tests.append(contains_any(text, rule.contains))
        held = reduce(lambda a, b: a | b, tests)
        label = F.lit(rule.label).cast("string")
        chain = F.when(held, label) if chain is None else chain.when(held, label)
    return chain


def replace_each(text: Column, parts: Iterable[str], by: str = "") -> Column:
    return reduce(lambda c, part: F.replace(c, F.lit(part), F.lit(by)), parts, text)


def transliterate(text: Column, table: Mapping[str, str]) -> Column:
    """Replace single characters; a target may hold none, one or several characters.

    Targets must not contain source characters, so the order of replacing is free.
    """
    for source, target in table.items():
        if len(target) > 1:
            text = F.replace(text, F.lit(source), F.lit(target))
    one_to_one = {s: t for s, t in table.items() if len(t) == 1}
    removed = "".join(s for s, t in table.items() if t == "")
    return F.translate(text, "".join(one_to_one) + removed, "".join(one_to_one.values()))


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def title_case(text: Column) -> Column:
    """First letter of every run of letters in upper case: "o'rta-2nd" gives "O'Rta-2Nd"."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    capital = lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substring(run, 2, 1 << 30))
    return F.array_join(F.transform(runs, capital), "")


def nothing_if_blank(text: Column) -> Column:
    return F.when(text != "", text)


def split_items(text: Column) -> Column:
    """Comma-separated text as an array of stripped items."""
    return F.transform(F.split(text, ","), strip)
