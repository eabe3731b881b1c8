"""Column expressions: dates, education at a reference date, person numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MAX_AGE_DAYS = 5 * 365  # a diagnosis counts as childhood onset up to this many days after birth
PRE_DAYS = 365
POST_DAYS = 5 * 365
PARENT_AGE_MIN, PARENT_AGE_MAX = 15, 50
MAX_FAMILY_SIZE = 10
ADULT_AGE, YOUNG_ADULT_AGE = 18, 25
# Seventh digit of a person number by birth year: (first year, last year, lowest digit, highest digit).
CENTURY_DIGITS = [(1800, 1899, 5, 7), (1900, 1936, 0, 3), (1937, 1999, 4, 9), (2000, 2099, 0, 3)]
CENTURY_DIGITS_ELSE = (4, 9)


def known_at(value: Column, value_date: Column, ref_date: Column, default: str = "Unknown") -> Column:
    """``value`` if it and its date exist and the date is not after ``ref_date``, else ``default``."""
    known = value.isNotNull() & value_date.isNotNull() & (value_date <= ref_date)
    return F.when(known, value).otherwise(F.lit(default))


def first_known_at(records: Column, ref_date: Column, default: str = "Unknown") -> Column:
    """List form of :func:`known_at`: first ``value`` of an array of ``(date, value)`` dated by then."""
    dated = F.filter(records, lambda r: r["date"] <= ref_date)
    return F.coalesce(F.get(dated, F.lit(0))["value"], F.lit(default))


def cap_start(start: Column, end: Column) -> Column:
    """A start date later than the end date becomes the end date."""
    return F.when(start > end, end).otherwise(start)


def age_at(birth_date: Column, ref_date: Column) -> Column:
    """Age in years of 365.25 days."""
    return F.datediff(ref_date, birth_date) / F.lit(365.25)


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def date_digits(day: Column) -> Column:
    """DDMMYY."""
    return F.concat(_two(F.day(day)), _two(F.month(day)), _two(F.year(day) % 100))


def century_digit_bounds(birth_date: Column) -> tuple[Column, Column]:
    """Lowest and highest allowed seventh digit for a birth date."""
    low, high = F.lit(CENTURY_DIGITS_ELSE[0]), F.lit(CENTURY_DIGITS_ELSE[1])
    for first, last, lo, hi in CENTURY_DIGITS:
        inside = F.year(birth_date).between(first, last)
        low, high = F.when(inside, lo).otherwise(low), F.when(inside, hi).otherwise(high)
    return low, high


def person_number_rules(number: Column, birth_date: Column, sex: Column) -> dict[str, Column]:
    """Violations of ``DDMMYY-SXXX``: form, date part, century digit, parity of the last digit (K even, M odd).

    A NULL number, or one of another form, is ``malformed``; the other rules judge what they can read of it.
    """
    seventh = F.substring(number, 8, 1).try_cast("int")
    last = F.substring(number, 11, 1).try_cast("int")
    low, high = century_digit_bounds(birth_date)
    return {
        "malformed": ~F.coalesce(number.rlike("^[0-9]{6}-[0-9]{4}$"), F.lit(False)),
        "birth_date": F.substring(number, 1, 6) != date_digits(birth_date),
        "century_digit": ~seventh.between(low, high),
        "sex_parity": (last % 2) != F.when(sex == "K", 0).otherwise(1),
    }
