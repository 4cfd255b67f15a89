"""Keep the copy of each key that arrived last.

Written as an aggregate, not as a ranking window: every task reduces its rows
to one per key before the shuffle, so a key that holds a third of all rows
sends one row per task instead of all of them to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _arrival(df: DataFrame, order: list[str]) -> list[Column]:
    """Sort key of arrival; an unknown time arrives after all known ones."""
    key = []
    for i, name in enumerate(order):
        if df.schema[name].nullable:
            key.append(F.col(name).isNull().alias(f"_unknown_{i}"))
        key.append(F.col(name))
    return key


def _unpack(picked: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in columns])


def _pick(df: DataFrame, keys: list[str], order: list[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    row = F.struct(*_arrival(df, order), *rest)
    return _unpack(df.groupBy(*keys).agg(choose(row).alias("_row")), keys, df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by ``order``, ties settled by the other columns.

    The row itself is the value that is maximised, so it is carried once.
    All columns must be orderable; see ``keep_last_by`` for the others.
    """
    return _pick(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, order, F.min)


def keep_last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As ``keep_last``, for rows with values that have no order (variants,
    maps): ``order`` must then be total by itself."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*_arrival(df, order))).alias("_row"))
    return _unpack(last, keys, df.columns)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def drop_duplicates(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the last copy, whatever the column types are."""
    order = [c for c in order if c in df.columns]
    if all(_orderable(f.dataType) for f in df.schema.fields):
        return keep_last(df, keys, order)
    ties = [f.name for f in df.schema.fields
            if _orderable(f.dataType) and f.name not in keys and f.name not in order]
    return keep_last_by(df, keys, order + ties)


def dedup_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after; only the keys are shuffled."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )
