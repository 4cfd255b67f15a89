import json
import pathlib
import random
import re
import time
from dataclasses import replace as with_changes
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from medallion.contracts import Entity
from medallion.functions.times import instant
from medallion.operators import commit as commits
from medallion.operators import merge
from medallion.operators.commit import Files, TableBusyError, TableLostError, release, writing
from medallion.operators.lake import clustered, export_csv, interleaved, range_rank, rebuild, replace, z_value
from medallion.operators.merge import DuplicateKeyError, insert_if_absent, recover, upsert
from tests.conftest import rows

T1, T2 = datetime(2024, 6, 1), datetime(2024, 6, 2)

ITEMS = Entity(
    name="items", table="items_raw",
    columns={"k": "bigint", "d": "timestamp", "v": "string", "w": "int", "_loaded_at": "timestamp"},
    keys=("k",), required=("k",), gate=("k",), arrival=("d",), marks=("d",),
    watermark_name="incremental_items", cluster=("d", "k"), date_key="d",
)
PAIRS = with_changes(ITEMS, name="pairs", table="pairs_raw", keys=("k", "v"), date_key=None)


@pytest.fixture
def lake(make_lake):
    return make_lake(entities={"items": ITEMS, "pairs": PAIRS})


def frame(spark, data, columns="k bigint, d string, v string, w int"):
    df = spark.createDataFrame(data, columns)
    return df.withColumn("d", F.col("d").cast("timestamp")) if "d" in df.columns else df


def content(lake, entity=ITEMS, *columns):
    columns = columns or ("k", "month", "v", "w", "load")
    df = lake.table("raw", entity.table).withColumns({
        "month": F.date_format("d", "yyyy-MM"), "load": F.dayofmonth("_loaded_at")})
    return rows(df.select(*columns))


def parts(lake, entity=ITEMS):
    return sorted(r[0] for r in lake.spark.sql(f"SHOW PARTITIONS {lake.raw(entity)}").collect())


def test_update_insert_keep(spark, lake):
    assert upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2),
                                      (3, "2024-03-05", "c", 3)]), ITEMS, instant(T1)) == 3
    assert upsert(lake, frame(spark, [(2, "2024-02-06", "B", 20), (4, "2024-02-07", "d", 4)]),
                  ITEMS, instant(T2)) == 2
    assert content(lake) == [
        (1, "2024-01", "a", 1, 1), (2, "2024-02", "B", 20, 1), (3, "2024-03", "c", 3, 1),
        (4, "2024-02", "d", 4, 2)]


def test_untouched_partitions_are_not_rewritten(spark, lake):
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)]), ITEMS,
           instant(T1))
    files = lambda: {r[0] for r in spark.table(lake.raw(ITEMS)).where(
        "_part = '2024-01'").select("_metadata.file_path").collect()}
    before = files()
    upsert(lake, frame(spark, [(2, "2024-02-06", "B", 20)]), ITEMS, instant(T2))
    assert files() == before


def test_a_row_that_moves_leaves_no_copy_behind(spark, lake):
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)]), ITEMS,
           instant(T1))
    upsert(lake, frame(spark, [(1, "2024-03-05", "a", 1)]), ITEMS, instant(T2))
    assert content(lake) == [(1, "2024-03", "a", 1, 1), (2, "2024-02", "b", 2, 1)]
    assert parts(lake) == ["_part=2024-02", "_part=2024-03"]
    upsert(lake, frame(spark, [(2, None, "b", 2)]), ITEMS, instant(T2))
    assert content(lake) == [(1, "2024-03", "a", 1, 1), (2, None, "b", 2, 1)]
    assert parts(lake) == ["_part=2024-03", "_part=none"]


def test_columns_the_source_lacks(spark, lake):
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1)]), ITEMS, instant(T1))
    upsert(lake, frame(spark, [(1, "A"), (2, "B")], "k bigint, v string"), ITEMS, instant(T2))
    assert content(lake) == [(1, "2024-01", "A", 1, 1), (2, None, "B", None, 2)]


def test_null_keys_always_insert(spark, lake):
    first = frame(spark, [(None, "2024-01-05", "a", 1), (1, "2024-01-06", "b", 2)])
    upsert(lake, first, ITEMS, instant(T1))
    upsert(lake, first.unionByName(first.where("k IS NULL")), ITEMS, instant(T2))
    assert content(lake, ITEMS, "k", "v") == [(1, "b"), (None, "a"), (None, "a"), (None, "a")]


def test_composite_key_with_nulls_and_text(spark, lake):
    upsert(lake, frame(spark, [(1, None, "a", 1), (1, None, "b", 2), (1, None, None, 3)]), PAIRS,
           instant(T1))
    upsert(lake, frame(spark, [(1, None, "b", 20), (1, None, None, 30)]), PAIRS, instant(T2))
    assert content(lake, PAIRS, "k", "v", "w") == [
        (1, "a", 1), (1, "b", 20), (1, None, 3), (1, None, 30)]


def test_duplicate_source_keys_are_refused(spark, lake):
    good = frame(spark, [(1, "2024-01-05", "a", 1)])
    upsert(lake, good, ITEMS, instant(T1))
    with pytest.raises(DuplicateKeyError):
        upsert(lake, good.unionByName(good), ITEMS, instant(T2))
    assert content(lake) == [(1, "2024-01", "a", 1, 1)]


def test_empty_source_and_unknown_columns(spark, lake):
    good = frame(spark, [(1, "2024-01-05", "a", 1)])
    upsert(lake, good, ITEMS, instant(T1))
    assert upsert(lake, good.limit(0), ITEMS, instant(T2)) == 0
    with pytest.raises(ValueError, match="oops"):
        upsert(lake, good.withColumn("oops", F.lit(1)), ITEMS, instant(T2))
    assert content(lake) == [(1, "2024-01", "a", 1, 1)]


def test_a_failed_check_leaves_the_target_alone(spark, lake):
    def refuse(_seen):
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1)]), ITEMS, instant(T1), refuse)
    with pytest.raises(ValueError, match="refused"):
        replace(lake, frame(spark, [(1, "2024-01-05", "a", 1)]), ITEMS, instant(T1), refuse)
    assert content(lake) == []


def test_upsert_twice_is_upsert_once(spark, lake):
    first = frame(spark, [(i, f"2024-0{1 + i % 3}-05", "a", i) for i in range(30)])
    second = frame(spark, [(i, f"2024-0{1 + i % 5}-07", "b", i) for i in range(20, 50)])
    upsert(lake, first, ITEMS, instant(T1))
    upsert(lake, second, ITEMS, instant(T2))
    once = content(lake)
    upsert(lake, second, ITEMS, instant(T2))
    assert content(lake) == once


@pytest.fixture(params=["-1", "10MB"])
def broadcast_limit(spark, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.unset(key)


def test_random_upserts_match_a_dictionary(spark, lake, broadcast_limit):
    """Both ways to join, with a partition that holds a third of all rows."""
    rng = random.Random(broadcast_limit)
    state = {}
    for _ in range(3):
        batch = {}
        for k in rng.sample(range(300), 120):
            month = 1 if rng.random() < 0.34 else rng.randrange(2, 7)
            batch[k] = (k, f"2024-{month:02d}-03", rng.choice("abc"), rng.randrange(9))
        state |= batch
        upsert(lake, frame(spark, list(batch.values())), ITEMS, instant(T1))
        expected = [(k, d[:7], v, w) for k, d, v, w in state.values()]
        assert content(lake, ITEMS, "k", "month", "v", "w") == sorted(
            expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_interrupted_publish_is_finished(spark, lake, monkeypatch):
    first = frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2),
                          (3, "2024-03-05", "c", 3)])
    second = frame(spark, [(1, "2024-02-06", "A", 10), (4, "2024-04-05", "d", 4)])
    upsert(lake, first, ITEMS, instant(T1))

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "apply_record", crash)
        with pytest.raises(RuntimeError):
            upsert(lake, second, ITEMS, instant(T2))
        assert content(lake, ITEMS, "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
        with pytest.raises(RuntimeError):
            recover(lake, ITEMS)
    assert recover(lake, ITEMS)
    expected = [(1, "2024-02", "A", 10, 1), (2, "2024-02", "b", 2, 1), (3, "2024-03", "c", 3, 1),
                (4, "2024-04", "d", 4, 2)]
    assert content(lake) == expected
    assert parts(lake) == ["_part=2024-02", "_part=2024-03", "_part=2024-04"]
    assert not recover(lake, ITEMS)


def interrupted(monkeypatch, work):
    """Run a load whose driver is lost after the commit is recorded and before the table is switched."""
    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "apply_record", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            work()


def test_a_full_replace_outlives_an_interrupted_upsert(spark, lake, monkeypatch):
    first = frame(spark, [(k, "2024-01-05", "old", 1) for k in range(4)])
    upsert(lake, first, ITEMS, instant(T1))
    interrupted(monkeypatch, lambda: upsert(lake, first.withColumn("v", F.lit("hourly")), ITEMS, instant(T1)))
    replace(lake, first.withColumn("v", F.lit("full")), ITEMS, instant(T2))
    upsert(lake, frame(spark, [(9, "2024-01-05", "new", 1)]), ITEMS, instant(T2))
    assert content(lake, ITEMS, "k", "v") == [(0, "full"), (1, "full"), (2, "full"), (3, "full"), (9, "new")]


def test_inserted_rows_outlive_an_interrupted_upsert(spark, lake, monkeypatch):
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1)]), ITEMS, instant(T1))
    interrupted(monkeypatch, lambda: upsert(lake, frame(spark, [(1, "2024-01-05", "A", 1)]), ITEMS, instant(T1)))
    insert_if_absent(lake, frame(spark, [(2, "2024-01-05", "b", 1)]), ITEMS, instant(T2), ["d"])
    upsert(lake, frame(spark, [(3, "2024-01-05", "c", 1)]), ITEMS, instant(T2))
    assert content(lake, ITEMS, "k", "v") == [(1, "A"), (2, "b"), (3, "c")]


def test_a_write_that_fails_leaves_the_old_rows(spark, lake):
    good = frame(spark, [(k, "2024-01-05", "a", k) for k in range(10)])
    replace(lake, good, ITEMS, instant(T1))
    name = lake.name("analytics", "dim_customers")
    columns = spark.table(name).columns
    customers = spark.range(5).select(F.col("id").alias("user_id"), *[F.lit("x").alias(c) for c in columns[1:]])
    rebuild(lake, customers, "analytics", "dim_customers")
    lost = F.when(F.rand() < 2, F.raise_error(F.lit("task lost"))).cast("string")
    for load in (replace, upsert):
        with pytest.raises(Exception, match="task lost"):
            load(lake, good.withColumn("v", lost), ITEMS, instant(T2))
    with pytest.raises(Exception, match="task lost"):
        rebuild(lake, customers.withColumn("email", lost), "analytics", "dim_customers")
    assert len(content(lake)) == 10
    assert spark.table(name).count() == 5


def test_a_second_writer_is_refused(spark, lake):
    good = frame(spark, [(1, "2024-01-05", "a", 1)])
    with writing(lake.raw_place(ITEMS)):
        with pytest.raises(TableBusyError, match="items_raw"):
            upsert(lake, good, ITEMS, instant(T1))
    assert upsert(lake, good, ITEMS, instant(T1)) == 1
    # an owner of another application, alive and given free by hand
    place = lake.raw_place(ITEMS)
    foreign_owner(place, '{"app": "other"}')
    with pytest.raises(TableBusyError, match="other"):
        replace(lake, good, ITEMS, instant(T1))
    release(place)
    assert replace(lake, good, ITEMS, instant(T1)) == 1


def foreign_owner(place, text):
    """Another application claims the table."""
    path = place.numbered("owners", commits._newest(place)[0] + 1)
    assert place.files.create(path, text)
    return path


@pytest.mark.parametrize("text", ["", "{", '{"app": "other"}'])
def test_an_owner_lives_until_the_store_says_that_it_is_too_old(spark, lake, monkeypatch, text):
    """Also one whose file has no content yet; the clocks of the writers do not matter."""
    place, good = lake.raw_place(ITEMS), frame(spark, [(1, "2024-01-05", "a", 1)])
    path = foreign_owner(place, text)
    monkeypatch.setattr(time, "time", lambda: 9e12)
    with pytest.raises(TableBusyError):
        upsert(lake, good, ITEMS, instant(T1))
    monkeypatch.setattr(commits, "LEASE_SECONDS", 0.8)
    time.sleep(1)
    place.files.write(f"{path}.life", "")  # a sign of life
    with pytest.raises(TableBusyError):
        upsert(lake, good, ITEMS, instant(T1))
    time.sleep(1)
    assert upsert(lake, good, ITEMS, instant(T1)) == 1


def test_a_writer_shows_that_it_lives(spark, lake, monkeypatch):
    monkeypatch.setattr(commits, "LEASE_SECONDS", 0.4)
    place = lake.raw_place(ITEMS)
    with writing(place) as version:
        time.sleep(1)
        first = place.files.modified(f"{version.owner.path}.life")
        time.sleep(1.5)
        assert place.files.modified(f"{version.owner.path}.life") > first
    assert commits._newest(place)[1]


def test_no_row_is_lost_when_a_clock_runs_behind(spark, lake, monkeypatch):
    """The order of versions is that of their owners, whatever time a driver believes it is."""
    rows_of = lambda k: frame(spark, [(k, "2024-01-05", "x", k), (100 + k, f"2024-0{k + 1}-05", "y", k)])
    for k, clock in enumerate((2e9, 1e9, 1.5e9, 0.0, 3e9)):
        monkeypatch.setattr(time, "time", lambda clock=clock: clock)
        upsert(lake, rows_of(k), ITEMS, instant(T1))
    assert [r[0] for r in content(lake, ITEMS, "k")] == sorted([*range(5), *range(100, 105)], key=str)
    place = lake.raw_place(ITEMS)
    assert [int(n) for n in place.files.names(place.history)] == sorted(int(n) for n in place.files.names(place.history))


def overtaken(place):
    """The lease has ended, and another run has claimed the table."""
    return foreign_owner(place, '{"app": "other", "token": "theirs"}')


@pytest.mark.parametrize("when", ["before the commit", "while it is recorded"])
def test_an_owner_that_was_overtaken_is_refused(spark, lake, monkeypatch, when):
    first = frame(spark, [(1, "2024-01-05", "a", 1)])
    upsert(lake, first, ITEMS, instant(T1))
    place = lake.raw_place(ITEMS)
    if when == "before the commit":
        prepare = merge.prepare
        monkeypatch.setattr(merge, "prepare", lambda *a: (prepare(*a), overtaken(place))[0])
    else:
        put = commits.Files.put
        monkeypatch.setattr(commits.Files, "put", lambda self, *a: (put(self, *a), overtaken(place))[0])
    with pytest.raises(TableLostError, match="items_raw"):
        upsert(lake, first.withColumn("v", F.lit("late")), ITEMS, instant(T1))
    monkeypatch.undo()
    assert content(lake, ITEMS, "k", "v") == [(1, "a")]
    with pytest.raises(TableBusyError):  # the other one is still there
        upsert(lake, first, ITEMS, instant(T1))
    release(place)
    upsert(lake, frame(spark, [(2, "2024-01-05", "b", 1)]), ITEMS, instant(T1))
    assert content(lake, ITEMS, "k", "v") == [(1, "a"), (2, "b")]


def test_a_record_older_than_the_table_is_not_applied(spark, lake):
    place = lake.raw_place(ITEMS)
    for v in "ab":
        upsert(lake, frame(spark, [(1, "2024-01-05", v, 1)]), ITEMS, instant(T1))
    old = min(place.files.names(place.history))
    late = json.loads(place.files.read(f"{place.history}/{old}"))
    place.files.create(place.numbered("commits", late["number"]), json.dumps(late))
    assert not recover(lake, ITEMS)
    assert content(lake, ITEMS, "k", "v") == [(1, "b")] and place.files.names(f"{place.work}/commits") == []


def test_the_sweep_spares_what_the_catalog_points_to(spark, lake):
    """Even folders that no record knows."""
    place = lake.raw_place(ITEMS)
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)]), ITEMS, instant(T1))
    old = place.files.names(place.versions)[0]
    moved = f"{place.versions}/by-hand"
    place.files.rename(f"{place.versions}/{old}/_part=2024-01", f"{moved}/_part=2024-01")
    spark.sql(f"ALTER TABLE {place.name} PARTITION (_part = '2024-01') SET LOCATION '{moved}/_part=2024-01'")
    place.files.create(f"{place.versions}/000000099999-lost/x", "")
    upsert(lake, frame(spark, [(3, "2024-02-05", "c", 2)]), ITEMS, instant(T1))
    with writing(place):
        pass
    assert len(place.files.names(place.versions)) == 2 and place.files.names(moved) == ["_part=2024-01"]
    assert content(lake, ITEMS, "k", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_the_history_says_what_has_changed(spark, lake, monkeypatch):
    place = lake.raw_place(ITEMS)
    assert commits.changed_since(place, 0) == set() and commits.last_version(place) == 0
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)]), ITEMS, instant(T1))
    first = commits.last_version(place)
    upsert(lake, frame(spark, [(1, "2024-03-05", "A", 1)]), ITEMS, instant(T1))
    assert commits.changed_since(place, first) == {"2024-01", "2024-03"}
    second = commits.last_version(place)
    assert commits.changed_since(place, second) == set() and commits.changed_since(place, 0) is None
    monkeypatch.setattr(commits, "HISTORY", 1)
    upsert(lake, frame(spark, [(2, "2024-02-05", "B", 1)]), ITEMS, instant(T1))
    assert commits.changed_since(place, first) is None  # too long ago
    last = commits.last_version(place)
    replace(lake, frame(spark, [(7, "2024-03-05", "y", 1)]), ITEMS, instant(T1))
    assert commits.changed_since(place, last) is None


def test_old_versions_are_deleted_by_the_next_write(spark, lake):
    place = lake.raw_place(ITEMS)
    for v in "abc":
        upsert(lake, frame(spark, [(1, "2024-01-05", v, 1)]), ITEMS, instant(T1))
    upsert(lake, frame(spark, [(2, "2024-02-05", "x", 1)]), ITEMS, instant(T1))
    replace(lake, frame(spark, [(7, "2024-03-05", "y", 1)]), ITEMS, instant(T1))
    with writing(place):
        pass
    assert len(place.files.names(place.versions)) == 1
    assert content(lake, ITEMS, "k", "v") == [(7, "y")]


def test_buckets_follow_the_rows(spark, make_lake):
    lake = make_lake(entities={"pairs": PAIRS}, bucket_rows=10)
    many = frame(spark, [(k, None, "v", k) for k in range(300)])
    upsert(lake, many, PAIRS, instant(T1))
    assert lake.bucket_count(PAIRS) == 32
    place = lake.raw_place(PAIRS)
    upsert(lake, frame(spark, [(1, None, "v", -1), (2, None, "v", -2)]), PAIRS, instant(T2))
    newest = place.files.names(place.versions)[-1]
    assert 1 <= len([n for n in place.files.names(f"{place.versions}/{newest}") if n.startswith("_part=")]) <= 2
    assert lake.table("raw", PAIRS.table).count() == 300
    replace(lake, many.where("k < 15"), PAIRS, instant(T2))
    assert lake.bucket_count(PAIRS) == 2
    assert upsert(lake, many.where("k < 20"), PAIRS, instant(T2)) == 20
    assert lake.table("raw", PAIRS.table).count() == 20


def bucket_names(lake):
    return [p.split("=")[1] for p in parts(lake, PAIRS)]


def test_buckets_grow_with_the_table(spark, make_lake):
    """By upserts alone; a bucket is split when it is touched, and two keys still rewrite two buckets."""
    lake, size = make_lake(entities={"pairs": PAIRS}, bucket_rows=20), 20
    place, total = lake.raw_place(PAIRS), 0
    while total < 64 * size:
        more = max(size, total)
        upsert(lake, frame(spark, [(k, None, "v", k) for k in range(total, total + more)]), PAIRS, instant(T1))
        total += more
        assert lake.number(PAIRS, "medallion.rows", 0) == total
    assert lake.bucket_count(PAIRS) == 64 and len(bucket_names(lake)) >= 60
    upsert(lake, frame(spark, [(1, None, "v", -1), (2, None, "v", -2)]), PAIRS, instant(T2))
    newest = place.files.names(place.versions)[-1]
    assert 1 <= len([n for n in place.files.names(f"{place.versions}/{newest}") if n.startswith("_part=")]) <= 2
    found = lake.table("raw", PAIRS.table)
    assert found.count() == total == found.distinct().count()
    assert rows(found.where("k < 4").select("k", "w")) == [(0, 0), (1, -1), (2, -2), (3, 3)]


def test_buckets_of_several_generations(spark, make_lake):
    lake = make_lake(entities={"pairs": PAIRS}, bucket_rows=8)
    upsert(lake, frame(spark, [(k, None, "v", k) for k in range(60)]), PAIRS, instant(T1))
    old = set(bucket_names(lake))
    assert {n.split(".")[0] for n in old} == {"8"}
    # one bucket grows: the others keep their place, and it is split
    key = F.pmod(F.xxhash64("k", "v"), F.lit(8))
    hot = spark.range(1000, 3000).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(1).alias("w")).where(key == 3).limit(100)
    upsert(lake, hot, PAIRS, instant(T1))
    names = bucket_names(lake)
    assert lake.bucket_count(PAIRS) == 32 and old - {"8.3"} == {n for n in names if n.startswith("8.")}
    assert all(int(n.split(".")[1]) % 8 == 3 for n in names if n.startswith("32."))
    insert_if_absent(lake, frame(spark, [(k, None, "v", -k) for k in range(50, 300)] + [(None, None, "v", 0)]), PAIRS, instant(T2), ["w"])
    expected = {k: k for k in range(60)} | {r["k"]: 1 for r in hot.collect()} | {k: -k for k in range(60, 300)}
    found = [(r["k"], r["w"]) for r in lake.table("raw", PAIRS.table).collect()]
    assert len(found) == len(expected) + 1 and dict(found) == expected | {None: 0}
    held = spark.table(lake.raw(PAIRS)).select("_part", *[F.concat(F.lit(f"{n}."), F.pmod(F.xxhash64("k", "v"), F.lit(n))) for n in (8, 32, 64)])
    assert all(r[0] in r[1:] for r in held.collect())
    assert lake.number(PAIRS, "medallion.rows", 0) == len(found)


def test_random_growth_matches_a_dictionary(spark, make_lake):
    lake, draw, expected = make_lake(entities={"pairs": PAIRS}, bucket_rows=5), random.Random(3), {}
    for turn in range(6):
        batch = {draw.randrange(120): draw.randrange(1000) for _ in range(4 ** min(turn, 3) + 1)}
        upsert(lake, frame(spark, [(k, None, "v", w) for k, w in batch.items()]), PAIRS, instant(T1))
        expected |= batch
        assert rows(lake.table("raw", PAIRS.table).select("k", "w")) == sorted(expected.items(), key=lambda r: tuple((v is None, str(v)) for v in r))
        assert lake.bucket_count(PAIRS) >= len(expected) / 5 / 2


def test_a_batch_of_a_stream_counts_once(spark, lake):
    place, one = lake.raw_place(ITEMS), frame(spark, [(1, "2024-01-05", "a", 1)])
    assert upsert(lake, one, ITEMS, instant(T1), batch=("s", 0)) == 1
    version = commits.last_version(place)
    assert upsert(lake, one.withColumn("v", F.lit("again")), ITEMS, instant(T1), batch=("s", 0)) == 0
    assert commits.last_version(place) == version and content(lake, ITEMS, "k", "v") == [(1, "a")]
    # other batches and other streams are taken
    assert upsert(lake, one.withColumn("v", F.lit("b")), ITEMS, instant(T1), batch=("s", 1)) == 1
    assert upsert(lake, one.withColumn("v", F.lit("c")), ITEMS, instant(T1), batch=("t", 0)) == 1
    assert content(lake, ITEMS, "k", "v") == [(1, "c")]


def versions(lake, entity=ITEMS):
    return Files(lake.spark).names(lake.raw_place(entity).history)


@pytest.mark.parametrize("entity", [ITEMS, PAIRS])
def test_rows_that_do_not_change_are_not_written(spark, lake, entity):
    data = [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", None), (3, None, "c", 3)]
    upsert(lake, frame(spark, data), entity, instant(T1))
    before, held = versions(lake, entity), content(lake, entity)
    assert upsert(lake, frame(spark, data), entity, instant(T2)) == 3
    assert upsert(lake, frame(spark, [r[:3] for r in data], "k bigint, d string, v string"), entity, instant(T2)) == 3
    assert versions(lake, entity) == before and content(lake, entity) == held
    # one of the three changes, to null; one is new, one is as it was
    assert upsert(lake, frame(spark, [(1, "2024-01-05", "a", None), data[1], (4, "2024-03-05", "d", 4)]), entity, instant(T2)) == 3
    assert len(versions(lake, entity)) == len(before) + 1
    assert content(lake, entity) == [(1, "2024-01", "a", None, 1), (2, "2024-02", "b", None, 1), (3, None, "c", 3, 1),
                                     (4, "2024-03", "d", 4, 2)]


def test_partitions_of_unchanged_rows_stay_where_they_are(spark, lake):
    data = [(i, f"2024-{i:02d}-05", "a", i) for i in range(1, 10)]
    upsert(lake, frame(spark, data), ITEMS, instant(T1))
    files = lambda: dict(spark.table(lake.raw(ITEMS)).select("_part", "_metadata.file_path").collect())
    before = files()
    upsert(lake, frame(spark, [*data[:4], (5, "2024-06-05", "a", 5), *data[5:]]), ITEMS, instant(T2))
    after = files()
    assert {p for p in before if after.get(p) != before[p]} == {"2024-05", "2024-06"}


def test_a_value_that_moves_to_the_next_column_is_a_change(spark, make_lake):
    wide = with_changes(ITEMS, columns=ITEMS.columns | {"x": "string", "y": "array<string>"})
    lake = make_lake(entities={"items": wide})
    shape = "k bigint, d string, v string, w int, x string, y array<string>"
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1, None, ["p", None])], shape), wide, instant(T1))
    for row in ((1, "2024-01-05", None, 1, "a", ["p", None]), (1, "2024-01-05", None, 1, "a", ["p"]),
                (1, "2024-01-05", None, 1, "a", None)):
        before = versions(lake, wide)
        upsert(lake, frame(spark, [row], shape), wide, instant(T2))
        assert len(versions(lake, wide)) == len(before) + 1
        assert rows(lake.table("raw", wide.table).select("k", "v", "x", "y")) == [(1, None, "a", row[5])]


def test_stamps_alone_are_changes_if_wanted(spark, make_lake):
    stamped = with_changes(ITEMS, columns=ITEMS.columns | {"_extracted_at": "timestamp"})
    lake = make_lake(entities={"items": stamped})

    def pull(ts, restamp):
        before = len(versions(lake, stamped))
        upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1)]).withColumn("_extracted_at", instant(ts)), stamped, instant(ts),
               restamp=restamp)
        return len(versions(lake, stamped)) - before, rows(lake.table("raw", stamped.table).select(F.dayofmonth("_extracted_at")))

    assert [pull(T1, True), pull(T1, True), pull(T2, False), pull(T2, True), pull(T2, True)] == [
        (1, [(1,)]), (0, [(1,)]), (0, [(1,)]), (1, [(2,)]), (0, [(2,)])]


def test_a_batch_without_changes_is_still_counted(spark, lake):
    data = [(1, "2024-01-05", "a", 1)]
    upsert(lake, frame(spark, data), ITEMS, instant(T1), batch=("s", 0))
    files = rows(spark.table(lake.raw(ITEMS)).select("_metadata.file_path"))
    assert upsert(lake, frame(spark, data), ITEMS, instant(T1), batch=("s", 1)) == 1
    assert upsert(lake, frame(spark, [(1, "2024-01-05", "b", 1)]), ITEMS, instant(T1), batch=("s", 1)) == 0
    assert rows(spark.table(lake.raw(ITEMS)).select("_metadata.file_path")) == files


def test_rows_from_before_the_digest_count_as_changed(spark, lake):
    data = [(1, "2024-01-05", "a", 1), (2, "2024-01-06", "b", 2)]
    upsert(lake, frame(spark, data), ITEMS, instant(T1))
    path = spark.table(lake.raw(ITEMS)).select("_metadata.file_path").first()[0]
    folder = path.rpartition("/")[0]
    kept = spark.createDataFrame(spark.read.parquet(folder).drop("_digest").collect(), spark.read.parquet(folder).drop("_digest").schema)
    kept.write.mode("overwrite").parquet(folder)
    spark.catalog.refreshTable(lake.raw(ITEMS))
    before = versions(lake)
    upsert(lake, frame(spark, data), ITEMS, instant(T2))
    upsert(lake, frame(spark, data), ITEMS, instant(T2))
    assert len(versions(lake)) == len(before) + 1
    assert content(lake) == [(1, "2024-01", "a", 1, 1), (2, "2024-01", "b", 2, 1)]


def test_overwrite_mode_is_restored(spark, lake):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1)]), ITEMS, instant(T1))
    upsert(lake, frame(spark, [(1, "2024-01-05", "b", 1)]), ITEMS, instant(T1))
    assert spark.conf.get(key) == before


def test_loads_work_in_a_session_with_dynamic_overwrite(spark, lake):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)]), ITEMS,
               instant(T1))
        upsert(lake, frame(spark, [(1, "2024-01-05", "A", 1)]), ITEMS, instant(T1))
        upsert(lake, frame(spark, [(2, "2024-02-05", "B", 2)]), ITEMS, instant(T1))
        assert content(lake, ITEMS, "k", "v") == [(1, "A"), (2, "B")]
        replace(lake, frame(spark, [(2, "2024-02-05", "c", 2)]), ITEMS, instant(T1))
        assert content(lake, ITEMS, "k", "v") == [(2, "c")]
    finally:
        spark.conf.set(key, before)


def test_replace(spark, lake):
    first = frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)])
    assert replace(lake, first, ITEMS, instant(T1)) == 2
    assert replace(lake, first.where("k = 2"), ITEMS, instant(T2)) == 1
    assert content(lake) == [(2, "2024-02", "b", 2, 2)]
    assert replace(lake, first.limit(0), ITEMS, instant(T2)) == 0
    assert content(lake) == [(2, "2024-02", "b", 2, 2)]


def test_insert_if_absent(spark, lake):
    insert_if_absent(lake, frame(spark, [(1, "2024-01-05", "a", 1)]), ITEMS, instant(T1), ["d"])
    offered = frame(spark, [(1, "2024-01-06", "z", 9), (2, "2024-02-08", "late", 2),
                            (2, "2024-02-07", "early", 1), (None, "2024-02-07", "n", 1),
                            (None, "2024-02-07", "n", 1)])
    insert_if_absent(lake, offered, ITEMS, instant(T2), ["d"])
    assert content(lake, ITEMS, "k", "v") == [(1, "a"), (2, "early"), (None, "n"), (None, "n")]


def test_a_hot_partition_is_split_over_files(spark, make_lake):
    """Nine tenths of the rows share a month: they end in several files."""
    small = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(small, "64KB")
    try:
        lake = make_lake(entities={"items": ITEMS})
        df = spark.range(0, 60_000, 1, 8).selectExpr(
            "id AS k", "CASE WHEN id % 10 > 0 THEN timestamp'2024-01-05 00:00:00' "
            "ELSE timestamp'2024-02-05 00:00:00' END AS d", "sha2(cast(id AS string), 256) AS v",
            "1 AS w")
        upsert(lake, df, ITEMS, instant(T1))
    finally:
        spark.conf.unset(small)
    files = spark.table(lake.raw(ITEMS)).where("_part = '2024-01'").select(
        "_metadata.file_path").distinct().count()
    assert files > 2
    assert lake.table("raw", ITEMS.table).count() == 60_000


def ancestors(plan, leaf):
    """Operators above each scan whose line contains ``leaf``."""
    lines, found = plan.splitlines(), []
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i, line in enumerate(lines):
        if leaf in line:
            level = depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < level:
                    found.append(lines[j])
                    level = depth[j]
    return found


def test_an_upsert_shuffles_and_writes_wide_rows_once(spark, lake, monkeypatch):
    plans = []
    write_step = merge.write_step

    def spy(df, path, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write_step(df, path, *args, **options)

    upsert(lake, frame(spark, [(1, "2024-01-05", "a", 1), (2, "2024-02-05", "b", 2)]), ITEMS,
           instant(T1))
    monkeypatch.setattr(merge, "write_step", spy)
    upsert(lake, frame(spark, [(2, "2024-02-06", "B", 20)]), ITEMS, instant(T2))
    _stage, hits, version = plans
    assert "BroadcastHashJoin" in hits and "SortMergeJoin" not in hits
    assert "GreaterThanOrEqual(k,2), LessThanOrEqual(k,2)" in hits
    assert re.search(r"items_raw\[k#\d+L,_loaded_at#\d+,_digest#\d+L,_part#\d+\]", hits)
    above = {line for line in ancestors(version, "items_raw[") if "Exchange" in line}
    assert len(above) == 1 and "REBALANCE" in above.pop()


def test_clustered_files_have_disjoint_ranges(spark, folder):
    df = spark.range(0, 20_000, 1, 8).select((F.col("id") * 7919 % 20_000).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        clustered(df, ["k"]).write.parquet(folder)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spans = rows(spark.read.parquet(folder).groupBy("_metadata.file_path").agg(
        F.min("k"), F.max("k")).select("min(k)", "max(k)"))
    spans.sort()
    assert len(spans) == 4
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def groups_with(folder, column, value):
    """Row groups whose range holds a value, and all."""
    hit = total = 0
    for file in pathlib.Path(folder.removeprefix("file:")).glob("*.parquet"):
        found = pq.ParquetFile(file)
        at = found.schema_arrow.get_field_index(column)
        for i in range(found.metadata.num_row_groups):
            seen = found.metadata.row_group(i).column(at).statistics
            hit, total = hit + (seen.min <= value <= seen.max), total + 1
    return hit, total


def test_a_filter_on_the_second_column_skips_row_groups(spark, folder):
    """Ids and categories that have nothing to do with each other; a range of ids reads few row groups, and so does a category."""
    df = spark.range(0, 64_000, 1, 8).select("id", F.concat(F.lit("category "), F.pmod(F.xxhash64("id"), F.lit(50)).cast("string")).alias("c"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        interleaved(df, ["id", "c"]).write.parquet(f"{folder}/z")
        clustered(df, ["id", "c"]).write.parquet(f"{folder}/plain")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows(spark.read.parquet(f"{folder}/z").agg(F.count("*"), F.sum("id"))) == rows(df.agg(F.count("*"), F.sum("id")))
    hit, total = groups_with(f"{folder}/plain", "c", "category 17")
    assert hit == total
    for column, value in (("id", 31_000), ("c", "category 17")):
        hit, total = groups_with(f"{folder}/z", column, value)
        assert total > 40 and hit <= total / 3


def test_ranks_and_interleaving(spark):
    bounds = [3, 5, 9]
    df = spark.createDataFrame([(v,) for v in (None, -1, 3, 4, 5, 8, 9, 100)], "v int")
    assert [r[0] for r in df.select(range_rank("v", bounds)).collect()] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert [r[0] for r in df.select(range_rank("v", [])).collect()] == [0] * 8
    grid = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    got = {(r["x"], r["y"]): r["z"] for r in grid.select("x", "y", z_value(grid, ["x", "y"], 3).alias("z")).collect()}
    assert got == {(x, y): sum((x >> b & 1) << 2 * b + 1 | (y >> b & 1) << 2 * b for b in range(3)) for x in range(8) for y in range(8)}
    assert interleaved(grid.limit(0), ["x", "y"]).count() == 0
    assert interleaved(grid.select(F.lit(None).cast("string").alias("x"), F.lit(1).alias("y")), ["x", "y"]).count() == 64


def test_rebuild_and_csv(spark, lake, folder):
    name = lake.name("analytics", "dim_customers")
    columns = spark.table(name).columns
    df = spark.range(5).select(F.col("id").alias("user_id"),
                               *[F.lit("x").alias(c) for c in columns if c != "user_id"])
    rebuild(lake, df, "analytics", "dim_customers", cluster_by=["user_id"])
    rebuild(lake, df.where("user_id > 2"), "analytics", "dim_customers", cluster_by=["user_id"])
    assert rows(spark.table(name).select("user_id")) == [(3,), (4,)]
    path = export_csv(df, folder, "users", T1)
    assert path.endswith("users_20240601_000000")
    assert spark.read.option("header", True).csv(path).columns == df.columns
    nested = spark.sql("""SELECT 1 AS id, array('a "b"', 'c') AS v""")
    path = export_csv(nested, folder, "nested", T1)
    back = spark.read.option("header", True).option("escape", '"').csv(path).first()
    assert back["v"] == '["a \\"b\\"","c"]'


def scanned(df):
    """Rows that the scans of a frame read from files, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


@pytest.fixture
def small_groups(spark):
    settings = {"parquet.block.size": "8192", "parquet.page.size.row.check.min": "100", "parquet.page.size.row.check.max": "100"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("present", [3, 0])
def test_a_look_up_of_random_keys_skips_row_groups_without_them(spark, lake, small_groups, present):
    """Keys in no order, so that every row group spans nearly the whole range."""
    n = 40_000
    day = F.to_timestamp(F.lit("2024-01-05"))
    # even keys are there, odd ones are not
    data = spark.range(n, numPartitions=1).select((F.abs(F.hash("id")).cast("bigint") * 2).alias("k"), F.timestamp_add("second", F.col("id"), day).alias("d"),
                                                  F.lit("v").alias("v"), F.lit(1).alias("w")).dropDuplicates(["k"])
    replace(lake, data, ITEMS, instant(T1))
    keys = [r["k"] for r in lake.table("raw", ITEMS.table).orderBy(F.hash("k")).limit(100).collect()]
    wanted = keys[:present] + [k + 1 for k in keys[present:]]
    files = [f for f in lake.spark.table(lake.raw(ITEMS)).inputFiles()]
    groups = sum(pq.ParquetFile(f.removeprefix("file:").replace("///", "/").replace("//", "/")).num_row_groups for f in files)
    assert groups >= 20
    stage = frame(spark, [(k, "2024-01-05", "new", 2) for k in wanted])
    stats = {"rows": len(wanted), "low_k": min(wanted), "high_k": max(wanted)}
    found = merge._target(lake, ITEMS, stage, stats)
    total = lake.table("raw", ITEMS.table).count()
    assert {r["k"] for r in found.collect()} == set(keys[:present])
    assert scanned(found) <= total * (present + 3) / groups * 1.5
    # a large source is compared by its range alone
    assert scanned(merge._target(lake, ITEMS, stage, stats | {"rows": merge.LOOKUP_KEYS + 1})) > total * 0.9
    assert upsert(lake, stage, ITEMS, instant(T2)) == 100
    assert lake.table("raw", ITEMS.table).count() == total + 100 - present
    assert lake.table("raw", ITEMS.table).where("v = 'new'").count() == 100


def test_a_look_up_reads_only_buckets_that_can_hold_the_keys(spark, make_lake):
    lake = make_lake(entities={"pairs": PAIRS}, bucket_rows=50)
    replace(lake, frame(spark, [(i, "2024-01-05", "a", 1) for i in range(800)]), PAIRS, instant(T1))
    assert len(parts(lake, PAIRS)) == 16
    stage = frame(spark, [(5, "2024-01-05", "a", 2), (None, "2024-01-05", "a", 2)])
    stats = {"rows": merge.LOOKUP_KEYS + 1, "low_k": 0, "high_k": 799, "low_v": "a", "high_v": "a"}
    found = merge._target(lake, PAIRS, stage.where("k is not null"), stats)
    assert scanned(found) < 200 and (5, "a") in {(r["k"], r["v"]) for r in found.collect()}
    assert merge._target(lake, PAIRS, stage.where("k is null"), stats | {"rows": 1}).count() == 0
