"""The daily full run and the hourly incremental run."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from medallion import contracts
from medallion.contracts import Entity
from medallion.functions.times import instant, now_utc
from medallion.operators.lake import Lake, replace
from medallion.operators.merge import upsert
from medallion.operators.quality import enforce, require_columns
from medallion.plans import control
from medallion.plans.entities import transform_orders, transform_products, transform_users
from medallion.plans.warehouse import build_analytics, build_staging

# Names of the pipelines, of their kinds of run, and of the steps in the run log.
FULL, INCREMENTAL = "etl_main_pipeline", "etl_incremental_pipeline"
DAILY_FULL, HOURLY_INCREMENTAL = "daily_full", "hourly_incremental"
PERSIST_METRICS, STAGING, ANALYTICS = "persist_metrics", "build_staging", "build_analytics"
LOAD, UPSERT, VALIDATE, MARKS = "load_{}", "upsert_{}", "validate_incremental_loads", "update_watermarks"

TRANSFORMS: dict[str, Callable[[DataFrame, datetime], DataFrame]] = {
    "orders": transform_orders, "users": transform_users, "products": transform_products,
}


@dataclass
class Run:
    lake: Lake
    run_id: str
    dag_id: str
    run_type: str
    started: datetime

    def finish(self, counts: dict[str, int]) -> None:
        control.record_metric(
            self.lake, self.dag_id, PERSIST_METRICS, self.run_id, self.run_type,
            control.SUCCESS, rows_loaded=sum(counts.values()),
            duration_seconds=control.elapsed(self.started, now_utc()),
        )
        for log in ("etl_watermarks", "pipeline_run_metrics"):
            self.task(PERSIST_METRICS, lambda: control.compact(self.lake, log))

    def task(self, name: str, work: Callable):
        """Run one step; its failure is recorded and raised again."""
        try:
            return work()
        except Exception as error:
            control.record_failure(self.lake, self.dag_id, name, self.run_id, error, self.started)
            raise

    def branches(self, names: list[str], step: str, work: Callable[[str], tuple]) -> dict[str, tuple]:
        """Run a branch for each entity side by side; all end before the first failure is raised."""
        with ThreadPoolExecutor(max(1, len(names))) as pool:
            begun = {name: pool.submit(self.task, step.format(name), lambda name=name: work(name)) for name in names}
        return {name: branch.result() for name, branch in begun.items()}


def load_entity(lake: Lake, entity: Entity, clean: DataFrame, run_ts: datetime,
                full: bool, gated: bool, restamp: bool = True) -> int:
    """Products are replaced in a full run; everything else is merged."""
    required = list(entity.gate)
    if gated:
        require_columns(clean, entity.name, required)
    check = (lambda seen: enforce(seen, entity.name, required)) if gated else None
    if full and entity.name == contracts.PRODUCTS.name:
        return replace(lake, clean, entity, instant(run_ts), check)
    # the transforms leave one row for each key
    return upsert(lake, clean, entity, instant(run_ts), check, unique=True, restamp=restamp)


def run_full(lake: Lake, sources: dict[str, DataFrame | Callable[[], DataFrame]], run_id: str,
             run_ts: datetime | None = None) -> dict[str, int]:
    """Load every entity behind its quality gate, then rebuild both layers.

    Each source is read once: gate and row count come from the same pass that
    stages the rows.  A source may be a function, so that a reader that fails
    is a failed step of the run.
    """
    run_ts = run_ts or now_utc()
    run = Run(lake, run_id, FULL, DAILY_FULL, run_ts)

    def load(name: str) -> int:
        raw = sources[name]() if callable(sources[name]) else sources[name]
        clean = TRANSFORMS[name](raw, run_ts)
        return load_entity(lake, contracts.ENTITIES[name], clean, run_ts, full=True, gated=True)

    counts = run.branches(list(sources), LOAD, load)
    run.task(STAGING, lambda: build_staging(lake))
    run.task(ANALYTICS, lambda: build_analytics(lake))
    run.finish(counts)
    return counts


def run_incremental(lake: Lake, sources: dict[str, Callable[[datetime | None], DataFrame]],
                    run_id: str, run_ts: datetime | None = None, overlap: timedelta | None = None) -> dict[str, int]:
    """Pull what changed since each mark, merge it, then move the marks.

    The next mark is the maximum over the rows as extracted, observed while
    they pass by, so mark and load see the same rows.

    ``overlap``: pull from this long before each mark, which catches rows that
    were committed behind it later.  Rows that are known already and have not
    changed are left alone, their times of transform and extraction too.
    """
    run_ts = run_ts or now_utc()
    run = Run(lake, run_id, INCREMENTAL, HOURLY_INCREMENTAL, run_ts)

    def load(name: str) -> tuple[int, datetime | None]:
        entity = contracts.ENTITIES[name]
        mark = control.get_watermark(lake, entity.watermark_name)
        raw = sources[name](mark - overlap if mark and overlap else mark)
        seen = Observation()
        metrics = control.mark_metrics(raw, entity.marks) or [F.count(F.lit(1)).alias("rows")]
        clean = TRANSFORMS[name](raw.observe(seen, *metrics), run_ts)
        rows = load_entity(lake, entity, clean, run_ts, full=False, gated=False, restamp=not overlap)
        return rows, control.pick_mark(seen.get, entity.marks)

    loaded = run.branches(list(sources), UPSERT, load)
    counts = {name: rows for name, (rows, _) in loaded.items()}
    run.task(VALIDATE, lambda: control.incremental_gate(counts))

    def advance() -> None:
        for name, (rows, mark) in loaded.items():
            control.advance_watermark(lake, contracts.ENTITIES[name].watermark_name, rows, mark)

    run.task(MARKS, advance)
    run.finish(counts)
    return counts
