"""Dates of diary headers and arithmetic on YYYY-MM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names by their first three letters, Roman months, German names.
MONTH_HEADS = {"jan": 1, "jän": 1, "feb": 2, "mar": 3, "mär": 3, "apr": 4, "mai": 5, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "okt": 10, "oct": 10, "nov": 11, "dez": 12, "dec": 12}
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii")
GERMAN_MONTHS = {"januar": 1, "jänner": 1, "februar": 2, "märz": 3, "maerz": 3, "april": 4, "mai": 5, "juni": 6, "juli": 7, "august": 8, "september": 9, "oktober": 10, "november": 11, "dezember": 12}


def _lookup(values: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", year, month, day)


def header_date(raw: Column) -> Column:
    """(date_norm, year, month, day, month_source, year_form) of ``7. IV. 18``; two digits are of the 1900s. Days up to 31, no calendar check."""
    pattern = r"(?i)^\s*(\d{1,2})\.?\s*([a-zäöü]+)\.?[\s.]*(1[5-9]\d{2}|20\d{2}|\d{2})?"
    day, name, year = (F.regexp_extract(raw, pattern, i) for i in (1, 2, 3))
    key = F.lower(name)
    roman = _lookup({r: i + 1 for i, r in enumerate(ROMAN)}, key)
    month = F.coalesce(roman, _lookup(MONTH_HEADS, F.substring(key, 1, 3)))
    y = F.when(F.length(year) == 4, year.try_cast("int")).when(F.length(year) == 2, 1900 + year.try_cast("int"))
    d = day.try_cast("int")
    return F.when(day != "", F.struct(
        F.when(y.isNotNull() & month.isNotNull() & d.between(1, 31), _iso(y, month, d)).alias("date_norm"), y.alias("year"), month.alias("month"), d.alias("day"),
        F.when(roman.isNotNull(), "roman").otherwise("name").alias("month_source"),
        F.when(F.length(year) == 4, "4-digit").when(F.length(year) == 2, "2-digit→19xx").alias("year_form"),
    ))


def iso_or_null(text: Column) -> Column:
    """A real calendar date between the years 1000 and 2100 as it stands, else null."""
    t = F.trim(text)
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(t, "yyyy-MM-dd").isNotNull() & F.substring(t, 1, 4).between("1000", "2100")
    return F.when(ok, t)


def german_date(text: Column) -> Column:
    """The first ``7. April 1917`` of a text as ISO, null if the calendar has no such day."""
    pattern = r"(\d{1,2})\.?\s*([A-Za-zäöüÄÖÜ]+)\s+(\d{4})"
    day, name, year = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    month = _lookup(GERMAN_MONTHS, F.lower(name))
    made = _iso(year.try_cast("int"), month, day.try_cast("int"))
    return F.when(month.isNotNull() & F.try_to_date(made, "yyyy-MM-dd").isNotNull(), made)


def entry_date(raw: Column, norm: Column) -> Column:
    """The date that came with the entry if it is one, else the one in its header."""
    return F.coalesce(iso_or_null(norm), german_date(raw))


def clock_time(text: Column, whole: bool = False) -> Column:
    """The hours and minutes that a text begins with, as ``07:05``. whole: nothing may follow, and ``7h05`` counts."""
    pattern = r"^(\d{1,2})[:.h](\d{2})$" if whole else r"^(\d{1,2})[:.](\d{2})"
    hour, minute = (F.regexp_extract(F.trim(text), pattern, i).try_cast("int") for i in (1, 2))
    return F.when(hour.between(0, 23) & minute.between(0, 59), F.format_string("%02d:%02d", hour, minute))


def month_index(ym: Column) -> Column:
    """Months since year 0 of a string that begins with YYYY-MM."""
    return F.substring(ym, 1, 4).cast("int") * 12 + F.substring(ym, 6, 2).cast("int") - 1


def add_months(ym: Column, k: Column | int) -> Column:
    n = month_index(ym) + k
    return F.format_string("%04d-%02d", F.floor(n / 12).cast("int"), (F.pmod(n, F.lit(12)) + 1).cast("int"))


def months_between(a: Column, b: Column) -> Column:
    return F.abs(month_index(a) - month_index(b))


def in_span(ym: Column, start: Column, end: Column, tolerance: int = 0) -> Column:
    """Whether a month lies in a closed span that is widened on both sides."""
    return month_index(ym).between(month_index(start) - tolerance, month_index(end) + tolerance)


def digit_distance(a: Column, b: Column) -> Column:
    """Places in which two strings differ, and what one is longer."""
    both = F.least(F.length(a), F.length(b))
    same = F.aggregate(F.sequence(F.lit(1), both), F.lit(0), lambda acc, i: acc + (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))).cast("int"))
    return same + F.abs(F.length(a) - F.length(b))


def year_token(verbatim: Column) -> Column:
    """The last number of a written date, as it was read."""
    return F.nullif(F.regexp_extract(F.trim(verbatim), r"(\d{2,4})\s*[.)]?\s*$", 1), F.lit(""))
