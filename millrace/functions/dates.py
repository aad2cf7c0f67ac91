"""Dates of commercial texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "9999-01-01"


def make_day(year: Column, month: Column, day: Column) -> Column:
    """A date, or null if there is no such day."""
    zero = F.lit(0)
    return F.try_make_timestamp(year, month, day, zero, zero, zero).cast("date")


def ymd_date(a: Column, b: Column, c: Column, strict_reference: bool = False) -> Column:
    """A date from three numbers in the order that fits first.

    In turn: year-month-day, day-month-year, month-day-year with a full year; the
    last two with a two-digit year from 16, then with a single digit up to 8; else
    9999-01-01.  ``strict_reference`` keeps an old behaviour that refuses December
    in day-month-year, so 25/12/2017 becomes year 4017.  No such day gives null.
    """
    day = lambda x: x.between(1, 31)
    month = lambda x: x.between(1, 12)
    full = lambda x: x.between(2010, 9998)
    last = 11 if strict_reference else 12
    rules = [
        (full(a) & month(b) & day(c), (a, b, c)),
        (full(c) & b.between(1, last) & day(a), (c, b, a)),
        (full(c) & month(a) & day(b), (c, a, b)),
        (c.between(16, 9999) & month(b) & day(a), (c + 2000, b, a)),
        (c.between(16, 9999) & month(a) & day(b), (c + 2000, a, b)),
        (c.between(0, 8) & month(b) & day(a), (c + 2010, b, a)),
        (c.between(0, 8) & month(a) & day(b), (c + 2010, a, b)),
    ]
    found = None
    for fits, parts in rules:
        found = F.when(fits, make_day(*parts)) if found is None else found.when(fits, make_day(*parts))
    return found.otherwise(F.lit(UNKNOWN).cast("date"))


def normalise_year(year: Column, to_year: Column) -> Column:
    """A year in full: missing takes ``to_year`` (this year if that is 9999), 10-99 are 20xx, 1-9 are 201x."""
    missing = F.when(to_year == 9999, F.year(F.current_date())).otherwise(to_year)
    return F.when(year.isNull() | (year == 0), missing).when(year.between(10, 99), year + 2000).when(year.between(1, 9), year + 2010).otherwise(year)


def clamp_day(year: Column, month: Column, day: Column) -> Column:
    """The day, or the month's last day if the month is shorter."""
    return F.coalesce(make_day(year, month, day), F.last_day(make_day(year, month, F.lit(1))))


def text_date(text: Column) -> Column:
    """``10Oct17`` or ``10-Oct-17`` as a date of this century."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("d-MMM-yy")), F.try_to_timestamp(text, F.lit("dMMMyy"))).cast("date")


MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def spoken_date(text: Column, to_year: Column) -> Column:
    """The date a text begins with, whatever its form.

    Until further notice is 9999-12-31, as is a year outside 2011 to 2024; a day and a
    month without a year take ``to_year``; a day after its month's end is that end;
    three numbers go by :func:`ymd_date`.  Null for a text without a date.
    """
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    month_of = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m), F.lit(i + 1))])
    full, short, three = r"^(\d{1,2})[ -]?([a-z]{3})[a-z]*[ -]?(\d{2,4})", r"^(\d{1,2})[ -]?([a-z]{3})[a-z]*$", r"^(\d{1,4})[-/ .](\d{1,2})[-/ .](\d{1,4})"
    part = lambda pattern, n: F.regexp_extract(low, pattern, n)
    number = lambda pattern, n: part(pattern, n).try_cast("int")
    named = lambda pattern: month_of[part(pattern, 2)]
    year = normalise_year(number(full, 3), to_year)
    open_end = F.lit("9999-12-31").cast("date")
    return (
        F.when(low.rlike(r"\b(ufn|onwards|further notice)\b"), open_end)
        .when(named(full).isNotNull(), F.when(year.between(2011, 2024), clamp_day(year, named(full), number(full, 1))).otherwise(open_end))
        .when(named(short).isNotNull(), clamp_day(to_year, named(short), number(short, 1)))
        .when(low.rlike(three), ymd_date(number(three, 1), number(three, 2), number(three, 3)))
    )


def extension(ext: Column, body: Column, from_name: Column) -> Column:
    """struct(extension_date, effective_date, days): the body's date if 1 to 30 days before, else the file name's.

    An extension of a year backwards comes from a wrong year: a date in 2016 moves
    a year on, otherwise the effective date moves a year back.
    """
    from_body = F.datediff(ext, body)
    effective = F.when((from_body > 0) & (from_body <= 30), body).otherwise(from_name)
    days = F.datediff(ext, effective)
    late = days < -350
    moved_ext = F.when(late & (F.year(ext) == 2016), F.add_months(ext, 12)).otherwise(ext)
    moved_effective = F.when(late & (F.year(ext) != 2016), F.add_months(effective, -12)).otherwise(effective)
    return F.struct(moved_ext.alias("extension_date"), moved_effective.alias("effective_date"), F.datediff(moved_ext, moved_effective).alias("days"))


def inherit_year(from_month: Column, from_day: Column, to: Column) -> Column:
    """A start without a year takes the end's, or the year before if its month is later."""
    return make_day(F.year(to) - (from_month > F.month(to)).cast("int"), from_month, from_day)


def parse_percent(text: Column) -> Column:
    """struct(value, unit): the number before a closing ``%``, unit P; T without one."""
    number = F.regexp_extract(text, r"(\d+)[^%]*%\s*$", 1)
    return F.struct(F.nullif(number, F.lit("")).try_cast("int").alias("value"), F.when(number != "", "P").otherwise("T").alias("unit"))
