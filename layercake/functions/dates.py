"""Tolerant date parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from layercake.functions._util import ColumnOrName, col

# Fixed values. Accepted shapes of a date string for `lenient_date`: optional
# leading whitespace; a 1-6 digit year, one separator out of '-', '/', ' ' used
# twice, a 1-2 digit month and day; then only whitespace, or 'T' / whitespace and
# a time 'h:m[:s]' (hour 0-24, minute and second 0-59, 1-2 digits each) followed
# by anything. This is the string->DATE cast of the SQL engine whose results the
# silver layer reproduces (checked value by value on 60+ shapes).
DATE_SHAPE = (
    r"^\s*(\d{1,6})([-/ ])(\d{1,2})\2(\d{1,2})"
    r"(?:\s*|(?:T|\s+)(?:[01]?\d|2[0-4]):[0-5]?\d(?::[0-5]?\d(?!\d)|(?!\d)(?!:\d)).*)$"
)

# Fixed values. Integer dates such as 20101229 (yyyymmdd) have exactly 8 digits.
INT_DATE_MIN = 10_000_000
INT_DATE_MAX = 99_999_999


# Prefix marking a value the shape matched (a control character that cannot
# start a value of the shape; a value that already starts with it is rejected).
_MATCHED = "\u0001"


def lenient_date(c: ColumnOrName) -> Column:
    """String -> DATE, NULL when the text is not a calendar date.

    Spark's own ``try_cast`` is both too lax ('2025', '2025-01', '2025-01-05 10'
    give a date) and too strict ('2025/01/05', 3-digit years give NULL), so the
    shape is checked with ``DATE_SHAPE`` and the date is rebuilt from its parts
    as zero-padded 'yyyy-mm-dd' for a (calendar-checking) ``try_cast``. Year 0
    gives NULL (the SQL engine answers 1 BC, which has no DATE here).

    Every step is exception-free and evaluated unconditionally, so Spark shares
    the single regex pass between them (inside a CASE branch it would not).
    """
    c = col(c)
    rebuilt = F.regexp_replace(c, DATE_SHAPE, _MATCHED + "$1-$3-$4")
    matched = rebuilt.startswith(_MATCHED) & ~c.startswith(_MATCHED)
    parts = F.split(F.substr(rebuilt, F.lit(2)), "-")

    def part(i: int, width: int) -> Column:
        text = F.try_element_at(parts, F.lit(i))
        return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)

    year = F.try_element_at(parts, F.lit(1)).try_cast("int")
    iso = F.concat_ws("-", part(1, 4), part(2, 2), part(3, 2)).try_cast("date")
    return F.when(matched & (year >= 1), iso)


def parse_int_date(c: ColumnOrName) -> Column:
    """yyyymmdd integer -> DATE; NULL for NULL, 0, anything that does not print
    as exactly 8 characters (so negatives and 5- or 9-digit values) and for an
    impossible calendar date (month 13, Feb 29 of a common year...).

    Pure integer arithmetic: the day is counted from the first of a month that always
    exists, and holds if it prints as the same number -- no string round trip and no parser
    exceptions on the (frequent) bad values. Every step is evaluated unconditionally, so that
    Spark shares it and the generated code stays small (methods of more than 8000 bytes are
    never compiled by the JVM, whatever the session's settings).
    """
    c = col(c)
    n = F.when(c.between(INT_DATE_MIN, INT_DATE_MAX), c).cast("int")  # positive, exactly 8 digits
    month = F.least(F.greatest(F.call_function("div", n, F.lit(100)) % 100, F.lit(1)), F.lit(12))
    first = F.make_date(F.call_function("div", n, F.lit(10000)).cast("int"), month.cast("int"), F.lit(1))
    date = F.date_add(first, n % 100 - 1)
    return F.when(F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date) == n, date)


def as_date_literal(as_of: str | dt.date | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def null_if_future(c: ColumnOrName, as_of: str | dt.date | Column) -> Column:
    """Tolerant string -> DATE, NULL when after ``as_of`` (``as_of`` itself is kept).

    ``as_of`` is an explicit business date so that re-running an old partition
    gives the same answer. Dates from the day after on are cut to that day, which then
    counts as NULL: the date itself stands in the expression once.
    """
    day_after = F.date_add(as_date_literal(as_of), 1)
    return F.nullif(F.least(lenient_date(c), day_after), day_after)


def previous_day(c: ColumnOrName) -> Column:
    return F.date_sub(col(c), 1)
