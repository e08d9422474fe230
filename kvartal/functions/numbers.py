"""Number, flag and date expressions. Nothing here raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(number: Column, digits: int) -> Column:
    """Scale, round to the nearest even, scale back."""
    scale = float(10**digits)
    return F.rint(number * F.lit(scale)) / F.lit(scale)


def nearest_hundredth(number: Column) -> Column:
    """Rounded as the number is, to its last bit: to even only if it lies exactly between two.

    200 times the number is taken apart into what a double holds and what it drops, so a
    product that only looks like a midpoint goes to the side it is on.
    """
    high = F.lit(134217729.0) * number - (F.lit(134217729.0) * number - number)
    doubled = number * 200.0
    dropped = (high * 200.0 - doubled) + (number - high) * 200.0
    looks_between = (doubled == F.rint(doubled)) & (doubled % 2 != 0)
    return (
        F.when(looks_between & (dropped > 0), (doubled + 1) / 2)
        .when(looks_between & (dropped < 0), (doubled - 1) / 2)
        .otherwise(F.rint(number * 100.0))
    ) / 100.0


def nothing_if_nan(number: Column) -> Column:
    return F.nanvl(number, F.lit(None).cast("double"))


def whole(number: Column) -> Column:
    """As an integer; NULL when it has a fraction or does not fit."""
    return F.when(number == F.rint(number), number.try_cast("int"))


def flag(number: Column) -> Column:
    """NULL and fractions below one are false."""
    return F.coalesce(number.try_cast("int"), F.lit(0)) != F.lit(0)


def day(text: Column, pattern: str) -> Column:
    """Date in the given pattern, else NULL."""
    return F.try_to_date(text, pattern)
