"""Data-quality gate: not empty, no required column missing, none null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A data set did not pass its gate."""


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def gate_metrics(columns: list[str]) -> list[Column]:
    """Aggregates to observe on a write, so that the gate needs no own scan."""
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
    ]


def require_columns(df: DataFrame, dataset: str, required: list[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise QualityError(f"{dataset}: required columns are missing: {missing}")


def enforce(metrics: dict[str, int], dataset: str, required: list[str]) -> None:
    if metrics["rows"] == 0:
        raise QualityError(f"{dataset}: no rows")
    nulls = {c: metrics[f"nulls_{c}"] for c in required if metrics[f"nulls_{c}"]}
    if nulls:
        raise QualityError(f"{dataset}: nulls in required columns: {nulls}")


def quality_report(df: DataFrame, dataset: str, required: list[str]) -> DataFrame:
    """One row per required column, from a single aggregate."""
    present = [c for c in required if c in df.columns]
    totals = df.agg(*gate_metrics(present))

    def line(name: str) -> Column:
        nulls = F.col(f"nulls_{name}") if name in present else F.lit(None).cast("bigint")
        status = (
            F.when(F.col("rows") == 0, "EMPTY")
            .when(F.lit(name not in present), "MISSING")
            .when(nulls > 0, "NULLS")
            .otherwise("PASSED")
        )
        return F.struct(
            F.lit(dataset).alias("dataset"), F.lit(name).alias("column_name"),
            F.col("rows").alias("row_count"), nulls.alias("null_count"),
            status.alias("status"),
        )

    return totals.select(F.explode(F.array(*[line(c) for c in required])).alias("l")).select("l.*")
