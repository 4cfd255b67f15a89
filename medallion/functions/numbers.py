"""Number cleaning and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.text import strip


def to_number(value: Column, dtype: T.DataType) -> Column:
    """Double, or null where the value is not a finite number.

    A cast alone would also take the suffixes and hexadecimal forms of Java
    literals ("5d", "0x1p3"), hence the letter guard.
    """
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return value.cast("double")
    if isinstance(dtype, T.StringType):
        plain = ~value.rlike("[dDfFxXpP]")
        value = strip(value)
    else:
        plain = F.lit(True)
    number = value.try_cast("double")
    finite = (number > F.lit(float("-inf"))) & (number < F.lit(float("inf")))
    return F.when(plain & finite, number)


def clean_money(value: Column, dtype: T.DataType) -> Column:
    """Null and negative amounts count as zero."""
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(to_number(value, dtype), zero), zero)


def clip_price(value: Column, dtype: T.DataType) -> Column:
    """Negative prices become zero, unknown prices stay unknown."""
    number = to_number(value, dtype)
    return F.when(number < 0, F.lit(0.0)).otherwise(number)


def round_half_even(value: Column, digits: int = 2) -> Column:
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column) -> Column:
    """Share of the whole in per cent, two decimals; null over zero."""
    return round_half_even(part / F.nullif(whole, F.lit(0)) * 100)


def margin_pct(price: Column, cost: Column) -> Column:
    return percent(price - cost, price)


def first_integer(text: Column) -> Column:
    digits = F.regexp_extract(text, r"(\p{Nd}+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")
