"""Numbers: rounding, printing, flags and coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(value, digits)


def clamp(value: Column, low: float, high: float) -> Column:
    """Bring a value into [low, high]; NULL stays NULL although greatest/least skip NULLs."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def number_text(value: Column) -> Column:
    """12.0 as ``12`` and 5.9 as ``5.9``; NULL as the empty string."""
    return F.coalesce(_whole_text(value), value.cast("string"), F.lit(""))


def _whole_text(value: Column) -> Column:
    """The digits of a whole number, NULL for others and for numbers of more than 38 digits."""
    number = value.cast("double")
    return F.when(number == F.rint(number), number.try_cast("decimal(38,0)").cast("string"))


def fmt_value(value: Column) -> Column:
    """A feature value for a sentence: whole numbers plain, others with two decimals."""
    number = value.cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit("unknown")).otherwise(
        F.coalesce(_whole_text(number), F.format_string("%.2f", number)))


def flag_parse(raw: Column) -> Column:
    """true/1/yes and false/0/no in any case as a boolean; anything else is NULL."""
    text = F.lower(F.trim(raw.cast("string")))
    return F.when(text.isin("true", "1", "yes"), F.lit(True)).when(text.isin("false", "0", "no"), F.lit(False))


def num_coerce(raw: Column) -> Column:
    """A double, or NULL where the value is no number."""
    return raw.try_cast("double")


def null_clean(value: Column) -> Column:
    """NULL and NaN as 0, for values that are about to be printed."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
