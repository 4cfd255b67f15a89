"""Text cleaning and masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: stored length of an error text.
ERROR_LENGTH = 5000


def strip(text: Column) -> Column:
    """Cut white space of every kind at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_upper(text: Column) -> Column:
    return F.upper(strip(text))


def normal_email(text: Column) -> Column:
    return F.lower(strip(text))


def full_name(first: Column, last: Column) -> Column:
    none = F.lit("")
    return strip(F.concat(F.coalesce(first, none), F.lit(" "), F.coalesce(last, none)))


def mask_all(text: Column) -> Column:
    """A star for each character; line breaks stay."""
    return F.regexp_replace(text, r"[^\n]", "*")


def mask_phone(text: Column) -> Column:
    """A star for each digit that four more digits follow directly."""
    return F.regexp_replace(text, r"\p{Nd}(?=\p{Nd}{4})", "*")


def cut_error(text: Column) -> Column:
    return F.substring(text, 1, ERROR_LENGTH)
