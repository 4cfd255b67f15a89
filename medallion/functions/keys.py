"""Surrogate keys and hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_LENGTH = 16


def surrogate_key(prefix: str, value: Column, dtype: T.DataType) -> Column:
    """First 16 hex digits of the SHA-256 of "prefix|value".

    A fractional id (an integer column that once held nulls) is written as
    the integer it stands for.
    """
    if isinstance(dtype, T.FractionalType):
        value = value.cast("bigint")
    text = F.concat_ws("|", F.lit(prefix), value.cast("string"))
    return F.substring(F.sha2(text, 256), 1, KEY_LENGTH)


def bucket(keys: list[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
