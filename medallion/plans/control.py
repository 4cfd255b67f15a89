"""Control log: high-water marks and run metrics."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion import contracts
from medallion.functions.text import cut_error
from medallion.functions.times import as_utc, from_micros, instant, now_utc, to_utc
from medallion.operators.commit import commit, writing
from medallion.operators.lake import Lake, clustered, write_step

log = logging.getLogger(__name__)

SUCCESS, FAILED = "SUCCESS", "FAILED"
# Fixed value: the stored text of a failure without a message.
NO_DETAILS = "No exception details available."


def latest_watermarks(marks: DataFrame) -> DataFrame:
    """Highest mark of the successful runs, per pipeline."""
    good = marks.where(F.col("status") == SUCCESS)
    return good.groupBy("pipeline_name").agg(F.max("watermark_value").alias("watermark_value"))


def get_watermark(lake: Lake, pipeline: str) -> datetime | None:
    """None means a full load."""
    marks = lake.table("control", "etl_watermarks").where(F.col("pipeline_name") == pipeline)
    row = latest_watermarks(marks).select(F.unix_micros("watermark_value")).first()
    return from_micros(row[0]) if row else None


# Rows come one at a time, each in a file of its own; beyond so many files a log is written anew.
COMPACT_FILES = 64
# Branches of a run log side by side, so a writer waits its turn.
WAIT_SECONDS = 300.0
ORDER = {"etl_watermarks": ["pipeline_name", "recorded_at"], "pipeline_run_metrics": ["dag_id", "recorded_at"]}


def append_control(lake: Lake, table: str, rows: DataFrame) -> None:
    columns = {"etl_watermarks": contracts.WATERMARKS,
               "pipeline_run_metrics": contracts.RUN_METRICS}[table]
    rows = rows.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])
    with writing(lake.place("control", table), WAIT_SECONDS):
        rows.write.insertInto(lake.name("control", table))


def compact(lake: Lake, table: str, files: int = COMPACT_FILES) -> bool:
    """Gather a log of more than ``files`` files, clustered by its first key and time."""
    place = lake.place("control", table)
    with writing(place, WAIT_SECONDS) as version:
        lake.spark.catalog.refreshTable(place.name)
        rows = lake.spark.table(place.name)
        if len(rows.inputFiles()) <= files:
            return False
        write_step(clustered(rows, ORDER[table]), version.data)
        commit(version)
        return True


def _one_row(lake: Lake, values: dict[str, Column]) -> DataFrame:
    one = lake.spark.range(1, numPartitions=1)
    return one.select(*[v.alias(c) for c, v in values.items()])


def set_watermark(lake: Lake, pipeline: str, value: datetime, status: str = SUCCESS,
                  rows: int = 0, recorded_at: datetime | None = None) -> None:
    append_control(lake, "etl_watermarks", _one_row(lake, {
        "pipeline_name": F.lit(pipeline), "watermark_value": instant(value),
        "status": F.lit(status), "rows_loaded": F.lit(rows),
        "recorded_at": instant(recorded_at or now_utc()),
    }))


def mark_metrics(df: DataFrame, candidates: tuple[str, ...]) -> list[Column]:
    """Highest instant of each candidate column, in microseconds.

    A maximum does not change when a task is repeated, so these may be
    observed anywhere in the plan.
    """
    return [
        F.max(F.unix_micros(to_utc(F.col(c), df.schema[c].dataType))).alias(c)
        for c in candidates if c in df.columns
    ]


def pick_mark(metrics: dict, candidates: tuple[str, ...]) -> datetime | None:
    """The first candidate with a value, not the greatest one."""
    for c in candidates:
        if metrics.get(c) is not None:
            return from_micros(metrics[c])
    return None


def next_watermark(df: DataFrame, candidates: tuple[str, ...]) -> DataFrame:
    found = [F.max(to_utc(F.col(c), df.schema[c].dataType)) for c in candidates if c in df.columns]
    mark = F.coalesce(*found) if found else F.lit(None).cast("timestamp")
    return df.agg(mark.alias("next_watermark"))


def advance_watermark(lake: Lake, pipeline: str, rows: int, mark: datetime | None,
                      recorded_at: datetime | None = None) -> bool:
    """Only a branch that loaded rows moves its mark."""
    if rows <= 0 or mark is None:
        return False
    set_watermark(lake, pipeline, mark, rows=rows, recorded_at=recorded_at)
    return True


def incremental_gate(counts: dict[str, int]) -> bool:
    """True if any branch loaded rows; a negative count is an error."""
    wrong = {name: n for name, n in counts.items() if n < 0}
    if wrong:
        raise ValueError(f"invalid row counts: {wrong}")
    if not any(counts.values()):
        log.warning("no rows loaded by any branch; watermarks stay as they are")
        return False
    return True


def incremental_gate_report(counts: DataFrame) -> DataFrame:
    """The same gate over a log of counts: run_id, dataset, rows_loaded."""
    total = F.sum("rows_loaded")
    status = (
        F.when(F.min("rows_loaded") < 0, "INVALID").when(total == 0, "NO_ROWS").otherwise("PASSED")
    )
    return counts.groupBy("run_id").agg(total.alias("rows_loaded"), status.alias("status"))


def rows_loaded_by_run(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("run_id").agg(F.sum("rows_loaded").alias("rows_loaded"))


def elapsed(start: datetime | None, end: datetime) -> float | None:
    if start is None:
        return None
    return round((as_utc(end) - as_utc(start)).total_seconds(), 2)


def record_metric(lake: Lake, dag_id: str, task_id: str, run_id: str, run_type: str,
                  status: str, rows_loaded: int = 0, duration_seconds: float | None = None,
                  error_message: str | None = None, recorded_at: datetime | None = None) -> bool:
    """Add one row about a step; False, and a line in the log, if that fails.
    Bookkeeping is not worth losing a load that went well."""
    try:
        append_control(lake, "pipeline_run_metrics", _one_row(lake, {
            "dag_id": F.lit(dag_id), "task_id": F.lit(task_id), "run_id": F.lit(run_id),
            "run_type": F.lit(run_type), "status": F.lit(status),
            "rows_loaded": F.lit(int(rows_loaded or 0)),
            "duration_seconds": F.lit(duration_seconds),
            "error_message": cut_error(F.lit(error_message).cast("string")),
            "recorded_at": instant(recorded_at or now_utc()),
        }))
        return True
    except Exception:
        log.exception("run metric not recorded")
        return False


def record_failure(lake: Lake, dag_id: str, task_id: str, run_id: str,
                   error: BaseException | None, started: datetime | None = None,
                   recorded_at: datetime | None = None) -> bool:
    end = recorded_at or now_utc()
    return record_metric(
        lake, dag_id, task_id, run_id, run_type="task_failure", status=FAILED,
        duration_seconds=elapsed(started, end),
        error_message=str(error) if error else NO_DETAILS, recorded_at=end,
    )


def failures_of(runs: DataFrame) -> DataFrame:
    """Failure rows of a run log, in the form in which they are recorded."""
    failed = runs.where(F.col("status") == FAILED)
    return failed.withColumns({
        "run_type": F.lit("task_failure"), "rows_loaded": F.lit(0).cast("bigint"),
        "error_message": cut_error(F.coalesce("error_message", F.lit(NO_DETAILS))),
    })
