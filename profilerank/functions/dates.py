"""Date columns from ISO strings, and the two month differences in use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def date_parse_strict(text: Column) -> Column:
    """A date when the whole string is ``yyyy-MM-dd``, else NULL."""
    return F.when(text.rlike(_ISO_DAY), F.try_to_date(text, "yyyy-MM-dd"))


def date_parse_prefix(text: Column) -> Column:
    """A date from the first ten characters, else NULL; trailing text is allowed."""
    return date_parse_strict(F.substring(text, 1, 10))


def months_cal(start: Column, end: Column) -> Column:
    """Calendar months between two dates; the day of the month does not count."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def months_whole(start: Column, end: Column) -> Column:
    """Completed months between two dates, never below zero; NULL when a date is missing."""
    months = months_cal(start, end) - F.when(F.dayofmonth(end) < F.dayofmonth(start), 1).otherwise(0)
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(months, F.lit(0)))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)
