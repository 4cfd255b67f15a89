"""Upsert into a partitioned parquet table, and insert of absent rows.

Only the partitions that hold a changed row, before or after the change, are
rewritten.  Steps of an upsert:

1. stage   the source, counted and checked, so its lineage runs once
2. hits    target rows with a source key: key, partition, unmentioned columns,
           and whether the source changes anything in them
3. fresh   the source without such rows, if there are any; where nothing is
           left, the table stays as it is
4. version the touched partitions as they shall be, which the table then
           switches to

An upsert that was interrupted before the switch was recorded has changed
nothing; afterwards the next writer of the table finishes it (``recover``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.contracts import Entity
from medallion.operators.commit import PART, Version, commit, writing
from medallion.operators.dedup import keep_first
from medallion.operators.lake import (BUCKETS, DIGEST, ROWS, Lake, complete, conform, digest, laid_out, stamps,
                                      write_step)
from medallion.operators.quality import gate_metrics

MATCHED, SAME, OLD_PART = "_matched", "_same", "_old_part"
# Increments of up to so many rows look their keys up one by one; larger ones by their range.
LOOKUP_KEYS = 1_000
# Property of a table: the last merged batch of each stream.
BATCH = "medallion.batch"


class DuplicateKeyError(ValueError):
    """Two source rows claim the same target row."""


def null_key(keys: list[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found |= F.col(key).isNull()
    return found


def _range_metrics(keys: list[str]) -> list[Column]:
    """Range of each key, seen while the stage is written."""
    return [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("low", F.min), ("high", F.max))]


def _refuse_copies(stage: DataFrame, keys: list[str], table: str) -> None:
    copies = stage.where(~null_key(keys)).groupBy(*keys).count().where("count > 1").limit(1).collect()
    if copies:
        raise DuplicateKeyError(f"{table}: source has {copies[0]['count']} rows of one key")


def _in_range(keys: list[str], stats: dict, schema: T.StructType) -> Column:
    """Lets the scan skip row groups outside the range of the source keys."""
    inside = F.lit(True)
    for key in keys:
        if isinstance(schema[key].dataType, (T.IntegralType, T.StringType)):
            low, high = stats[f"low_{key}"], stats[f"high_{key}"]
            # observed beside nulls of other keys, so a wider range than needed at most
            inside &= F.col(key).between(F.lit(low), F.lit(high))
    return inside


def _looked_up(entity: Entity, stage: DataFrame, stats: dict) -> Column:
    """Lets the scan skip row groups whose Bloom filters or dictionaries hold none of the source keys.

    The keys of a small increment only (``LOOKUP_KEYS``), counted when it was staged: they become a list in the plan.
    The table's rows that match are the same with and without it.
    """
    inside = F.lit(True)
    if stats["rows"] > LOOKUP_KEYS:
        return inside
    # where all rows have one value, the range is that value
    named = [k for k in entity.keys if isinstance(stage.schema[k].dataType, (T.IntegralType, T.StringType))
             and stats[f"low_{k}"] != stats[f"high_{k}"]]
    rows = stage.where(~null_key(list(entity.keys))).select(*named).collect() if named else []
    for key in named:
        inside &= F.col(key).isin(sorted({r[key] for r in rows}))
    return inside


def _values(df: DataFrame) -> list[str]:
    """Partition names: as many as the table has partitions, at most."""
    return [r[0] for r in df.distinct().collect()]


def upsert(lake: Lake, df: DataFrame, entity: Entity, loaded_at: Column, check=None,
           unique: bool = False, batch: tuple[str, int] | None = None, restamp: bool = True) -> int:
    """Update matched rows, insert the others; returns the source row count.

    Columns the source does not have keep the target's value on update and
    get their default on insert.  A null key matches nothing.  ``unique``:
    the caller has made the keys unique, so they need not be checked.

    ``batch``: the name of a stream and the number of its batch, which the
    commit records.  A batch that is not newer than the recorded one has been
    merged before: nothing is read or written, and the count is 0.

    Source rows that change nothing are left out, so a repeated pull writes
    nothing.  ``restamp``: other times of extraction or transform are changes
    too.  Without it a row that differs in those alone keeps its old ones, and
    a pull may overlap the one before, to catch what was committed late.
    """
    keys = list(entity.keys)
    with writing(lake.raw_place(entity)) as version:
        seal = {f"{BATCH}.{batch[0]}": batch[1]} if batch else {}
        if batch and lake.number(entity, f"{BATCH}.{batch[0]}", -1) >= batch[1]:
            return 0
        source = conform(df, entity.columns)
        stage, seen = write_step(source, version.step("stage"), gate_metrics(list(entity.gate)) + _range_metrics(keys))
        if check:
            check(seen)
        if seen["rows"]:
            if not unique:
                _refuse_copies(stage, keys, entity.table)
            defaults = {"_loaded_at": loaded_at}
            if lake.spark.table(lake.raw(entity)).isEmpty():
                _load_first(lake, version, stage, entity, defaults, seen["rows"], seal)
            else:
                touched, properties = prepare(lake, version, entity, stage, seen, defaults, restamp)
                if touched or seal:
                    commit(version, touched, properties | seal)
        return seen["rows"]


def _load_first(lake: Lake, version: Version, rows: DataFrame, entity: Entity, defaults: dict[str, Column],
                count: int, seal: dict[str, int]) -> None:
    """The first rows of a table; their number sets its buckets."""
    buckets = lake.buckets_for(count)
    rows = complete(rows, entity.columns, defaults).withColumns({DIGEST: digest(entity), PART: lake.part_of(entity, buckets)})
    write_step(laid_out(rows, entity), version.data, partitioned=True, keys=entity.keys)
    commit(version, properties=seal | ({} if entity.date_key else {ROWS: count, BUCKETS: buckets}))


def _target(lake: Lake, entity: Entity, stage: DataFrame, stats: dict, *columns) -> DataFrame:
    """Target rows in the range of the source keys, of a small source with its keys, and of buckets that can hold them.
    Only the named columns are scanned."""
    found = lake.spark.table(lake.raw(entity)).where(_in_range(list(entity.keys), stats, stage.schema))
    found = found.where(_looked_up(entity, stage, stats))
    if not entity.date_key:
        found = found.where(F.col(PART).isin(lake.holders(stage, entity)))
    return found.select(*entity.keys, F.col(PART).alias(OLD_PART), *columns)


def _find_hits(lake: Lake, version: Version, entity: Entity, keyed: DataFrame, stats: dict, unmentioned: list[str],
               restamp: bool) -> tuple[DataFrame, dict]:
    """Target rows with a source key, and whether the source row changes nothing (``SAME``); their counts.

    Whether the keys are broadcast or both sides shuffled is Spark's choice,
    which knows the size of the stage from its files.  Of the values, only
    their hash takes part, unless a value has to come from the target.
    """
    keys, new = list(entity.keys), "_new_digest"
    times = [c for c in stamps(entity) if c in keyed.columns] if restamp else []
    target = _target(lake, entity, keyed, stats, DIGEST, *unmentioned, *[F.col(c).alias(f"_old{c}") for c in times])
    if set(unmentioned) <= set(stamps(entity)):
        hits = target.join(keyed.select(*keys, digest(entity).alias(new), *times), keys)
    else:
        hits = target.join(keyed, keys).withColumn(new, digest(entity))
    same = F.col(new).eqNullSafe(F.col(DIGEST))
    for c in times:
        same &= F.col(c).eqNullSafe(F.col(f"_old{c}"))
    hits = hits.select(*keys, OLD_PART, *unmentioned, same.alias(SAME))
    return write_step(hits, version.step("hits"), gate_metrics([]) + [F.count_if(SAME).alias("same")])


def _without(stage: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a stage without a hit.  Null keys are kept out of the join, lest they gather in one task."""
    left = stage.where(~null_key(keys)).join(hits.select(*keys), keys, "left_anti")
    return left.unionByName(stage.where(null_key(keys)))


def prepare(lake: Lake, version: Version, entity: Entity, stage: DataFrame, stats: dict,
            defaults: dict[str, Column], restamp: bool = True) -> tuple[list[str], dict[str, int]]:
    """Write the touched partitions as they shall be; returns their names, and the table's new properties.

    Touched buckets that are larger than their share of the grown table are written as several.  Nothing is touched
    and written where the source changes nothing.
    """
    spark, keys = lake.spark, list(entity.keys)
    table = spark.table(lake.raw(entity))
    unmentioned = [c for c in entity.columns if c not in stage.columns]
    hits, found = _find_hits(lake, version, entity, stage.where(~null_key(keys)), stats, unmentioned, restamp)
    if found["same"]:
        # a key that several target rows have is unchanged if all of them are
        same = hits.groupBy(*keys).agg(F.bool_and(SAME).alias(SAME)).where(SAME)
        stage, left = write_step(_without(stage, same, keys), version.step("fresh"))
        if not left["rows"]:
            return [], {}
        hits = hits.join(stage.select(*keys), keys, "left_semi")
    properties = lake.grown(entity, stats["rows"] - found["rows"])
    hits, keyed = hits.drop(SAME), stage.where(~null_key(keys))
    part = lake.part_of(entity, properties.get(BUCKETS))

    # Updates and inserts in one pass: what a source row has not and its hit has, the hit gives.
    found = hits.drop(OLD_PART).withColumn(MATCHED, F.lit(True))
    changed = keyed.join(found, keys, "left").unionByName(stage.where(null_key(keys)), allowMissingColumns=True)

    def value(name: str, dtype: str) -> Column:
        if name in stage.columns:
            return F.col(name)
        default = defaults.get(name, F.lit(None)).cast(dtype)
        return F.when(F.col(MATCHED), F.col(name)).otherwise(default).alias(name)

    changed = changed.select(*[value(c, t) for c, t in entity.columns.items()]).withColumns({DIGEST: digest(entity), PART: part})

    if entity.date_key:
        # The partitions of the changed rows follow from the source alone, unless
        # it does not mention the date that decides them.
        dated = changed if entity.date_key in unmentioned else stage.withColumn(PART, part)
        touched = _values(hits.select(OLD_PART).union(dated.select(PART)))
    else:
        touched = lake.holders(stage, entity)
    before = table.where(F.col(PART).isin(touched))
    # Rows with a null key match nothing; taken apart, they cannot gather in
    # one task of a shuffled join.
    kept = before.where(~null_key(keys)).join(keyed.select(*keys), keys, "left_anti")
    kept = kept.select(*table.columns).unionByName(before.where(null_key(keys)))
    kept = kept if entity.date_key else kept.withColumn(PART, part)
    write_step(laid_out(kept.unionByName(changed), entity), version.data, partitioned=True, keys=entity.keys)
    return touched, properties


def recover(lake: Lake, entity: Entity) -> bool:
    """Finish a load that was interrupted while the table was switched."""
    with writing(lake.raw_place(entity)) as version:
        return version.recovered


def insert_if_absent(lake: Lake, df: DataFrame, entity: Entity, loaded_at: Column,
                     order: list[str]) -> int:
    """Add the rows whose key the table does not have; the first copy of a
    key wins.  A null key equals no other, so such rows are all added.
    Returns the number of rows offered, each key counted once."""
    keys = list(entity.keys)
    with writing(lake.raw_place(entity)) as version:
        rows = conform(df, entity.columns)
        first = keep_first(rows.where(~null_key(keys)), keys, order)
        stage, seen = write_step(first.unionByName(rows.where(null_key(keys))), version.step("stage"),
                                 gate_metrics([]) + _range_metrics(keys))
        if not seen["rows"]:
            return 0
        table, defaults = lake.spark.table(lake.raw(entity)), {"_loaded_at": loaded_at}
        if table.isEmpty():
            _load_first(lake, version, stage, entity, defaults, seen["rows"], {})
            return seen["rows"]
        keyed = stage.where(~null_key(keys))
        hits = _target(lake, entity, keyed, seen).join(keyed.select(*keys), keys, "left_semi")
        hits, _ = write_step(hits, version.step("hits"))
        new = complete(_without(stage, hits, keys), entity.columns, defaults).withColumn(DIGEST, digest(entity))
        new, added = write_step(new, version.step("new"))
        properties = lake.grown(entity, added["rows"])
        part = lake.part_of(entity, properties.get(BUCKETS))
        new = new.withColumn(PART, part)
        touched = _values(new.select(PART)) if entity.date_key else lake.holders(new, entity)
        if added["rows"]:
            before = table.where(F.col(PART).isin(touched))
            before = before if entity.date_key else before.withColumn(PART, part)
            write_step(laid_out(before.unionByName(new), entity), version.data, partitioned=True, keys=entity.keys)
            commit(version, touched, properties)
        return seen["rows"]
