"""Nested values: JSON text, review counts, struct fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.numbers import to_number
from medallion.functions.text import strip


def json_text(value: Column, dtype: T.DataType) -> Column:
    """JSON text of a nested value; text passes through, null stays null."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string")


def review_count(value: Column, dtype: T.DataType) -> Column:
    """Length of a list, 1 for an object, else the number itself, else 0."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.size(value), F.lit(0))
    if isinstance(dtype, (T.StructType, T.MapType)):
        return F.when(value.isNotNull(), 1).otherwise(0)
    number = to_number(value, dtype).try_cast("int")
    if isinstance(dtype, T.StringType):
        # Only text that can be a list or an object is parsed as JSON.
        text = strip(value)
        number = (
            F.when(text.startswith("["), F.json_array_length(text))
            .when(text.startswith("{"), F.when(F.json_object_keys(text).isNotNull(), 1))
            .otherwise(number)
        )
    return F.coalesce(number, F.lit(0))


def has_path(dtype: T.DataType, path: str) -> bool:
    for name in path.split("."):
        if not isinstance(dtype, T.StructType) or name not in dtype.fieldNames():
            return False
        dtype = dtype[name].dataType
    return True


def field(df: DataFrame, path: str) -> Column:
    """Nested field, or null where the schema does not have it."""
    return F.col(path) if has_path(df.schema, path) else F.lit(None).cast("string")
