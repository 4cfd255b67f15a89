import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from medallion.contracts import ORDER_SOURCE_COLUMNS
from medallion.plans.entities import transform_products, transform_users
from medallion.sources import pages, relational
from medallion.sources.paged import pages_of, record_count
from medallion.sources.generator import generate_orders
from tests.conftest import rows

RUN = datetime(2024, 6, 1)


def opened(spark, bodies):
    return pages.unwrap(spark.createDataFrame(list(enumerate(bodies, 1)), "page bigint, body string"))


def test_envelope(spark):
    bodies = [
        '[{"id": 1}, {"id": 2}]', '{"products": [{"id": 3}], "total": 1}',
        '{"products": {"id": 4}}', '{"data": [], "users": [{"id": 5}]}', "7", '{"data": [',
        None, '{"posts": [1, 2], "items": [{"id": 6}]}', '{"unknown": [{"id": 7}]}',
        '{"data": {"a": 1}, "carts": [{"id": 8}]}',
    ]
    counts = {r["page"]: r["n"] for r in opened(spark, bodies).collect()}
    assert [counts[i] for i in range(1, 11)] == [2, 1, 0, 0, 0, 0, 0, 1, 0, 1]
    ids = pages.typed(pages.explode_records(opened(spark, bodies)), "struct<id:bigint>")
    assert rows(ids.select("_page", "_pos", "id")) == [
        (1, 0, 1), (1, 1, 2), (10, 0, 8), (2, 0, 3), (8, 0, 6)]


def sized(spark, sizes):
    return opened(spark, [json.dumps([{"id": i} for i in range(n)]) for n in sizes])


def wanted(spark, sizes, page_size=100, **options):
    kept = pages.keep_wanted_pages(sized(spark, sizes), page_size, **options)
    return sorted(r["page"] for r in kept.where("n > 0").collect())


def test_reading_stops_after_the_first_short_page(spark):
    assert wanted(spark, [100, 100, 40, 100, 0]) == [1, 2, 3]
    assert wanted(spark, [100, 0, 100]) == [1]
    assert wanted(spark, [100, 100]) == [1, 2]
    assert wanted(spark, [0, 100]) == []
    assert wanted(spark, [100, 100, 100], max_pages=2) == [1, 2]
    assert wanted(spark, [100, 100, 100], max_pages=0) == [1, 2, 3]


def test_page_files_and_fields_of_a_wrong_type(spark, tmp_path):
    for page, ids in ((1, [1, 2]), (2, [3]), (10, [4])):
        users = [{"id": i, "email": f"{i}@x.org", "address": {"city": "c"}} for i in ids]
        users[0]["phone"] = {"home": 1}
        (tmp_path / f"users_page_{page}.json").write_text(json.dumps({"users": users}, indent=1))
    found = pages.extract(pages.read_page_files(spark, str(tmp_path)),
                          "struct<id:bigint,email:string,address:struct<city:string>>",
                          RUN, "/users", page_size=2)
    assert rows(found.select("id", "email", "address.city", "_page", "_pos", "_source")) == [
        (1, "1@x.org", "c", 1, 0, "/users"), (2, "2@x.org", "c", 1, 1, "/users"),
        (3, "3@x.org", "c", 2, 0, "/users")]
    wrong = pages.typed(pages.explode_records(opened(spark, ['[{"id": "x", "a": 1}]'])),
                        "struct<id:bigint,a:int>")
    assert rows(wrong.select("id", "a")) == [(None, 1)]


def test_stamp_of_no_rows(spark):
    empty = pages.stamp(spark.range(0), RUN, "/x")
    assert empty.columns == ["id", "_extracted_at", "_source"]
    assert empty.count() == 0


def test_since_is_cut_to_seconds_and_strict(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00.5"), (3, "2023-12-31"), (4, None)],
        "id int, updated_at string")
    since = datetime(2024, 1, 1, 0, 0, 0, 900_000)
    assert rows(pages.changed_since(df, since, "updated_at").select("id")) == [(2,), (4,)]
    assert pages.changed_since(df, None, "updated_at").count() == 4
    assert pages.changed_since(df, since, "absent").count() == 4


def order_rows(spark, folder):
    df = spark.sql("""SELECT id, id % 3 AS user_id, '[]' AS products, CAST(id AS decimal(10,2)) AS total,
        CAST(id AS decimal(10,2)) AS discounted_total, 1 AS total_products, 1 AS total_quantity,
        timestamp'2024-01-01 00:00:00' AS created_at,
        CASE WHEN id = 5 THEN NULL ELSE timestamp'2024-01-01 00:00:00' + make_dt_interval(CAST(id AS int)) END
            AS updated_at, 'x' AS extra FROM range(10)""")
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_after_a_mark(spark, folder):
    source = order_rows(spark, folder)
    assert relational.extract_orders(source).columns == ORDER_SOURCE_COLUMNS
    assert relational.extract_orders(source).count() == 10
    changed = relational.extract_orders(source, watermark=datetime(2024, 1, 7))
    assert rows(changed.select("id")) == [(7,), (8,), (9,)]  # day 6 equals the mark, 5 is unknown
    plan = plan_of(changed)
    assert "GreaterThan(updated_at,2024-01-07" in plan
    assert "extra" not in plan


def test_limit_takes_the_oldest_changes(spark, folder):
    source = order_rows(spark, folder)
    assert rows(relational.extract_orders(source, limit=3).select("id")) == [(0,), (1,), (2,)]
    assert relational.extract_orders(source, limit=0).count() == 10
    assert "TakeOrderedAndProject" in plan_of(relational.extract_orders(source, limit=3))
    last = relational.by_update_time(source).select("id").collect()[-1]
    assert last["id"] == 5


def test_text_times_become_instants(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", "bad")],
                               "created_at string, updated_at string")
    typed = relational.typed_times(df)
    assert [f.dataType.typeName() for f in typed.schema.fields] == ["timestamp", "timestamp"]
    assert typed.select(F.unix_micros("created_at"), "updated_at").first()[:] == (
        1704067200_000000, None)


def test_jdbc_options():
    plain = relational.jdbc_options("jdbc:x", id_bounds=(1, 900), num_partitions=9)
    assert plain["partitionColumn"] == "id" and plain["numPartitions"] == "9"
    assert "WHERE" not in plain["dbtable"]
    with pytest.raises(ValueError, match="id_bounds"):
        relational.jdbc_options("jdbc:x")
    assert relational.id_range_options("jdbc:x", "o")["query"] == "SELECT MIN(id) AS low, MAX(id) AS high FROM o"
    marked = relational.jdbc_options("jdbc:x", watermark=datetime(2024, 1, 1), id_bounds=(1, 9))
    assert "updated_at > TIMESTAMP WITH TIME ZONE '2024-01-01 00:00:00.000000+00:00'" in marked["dbtable"]
    limited = relational.jdbc_options("jdbc:x", limit=5, id_bounds=(1, 9))
    assert limited["query"].endswith("ORDER BY updated_at ASC LIMIT 5")
    assert "partitionColumn" not in limited


def test_profile(spark, folder):
    found = relational.profile(order_rows(spark, folder)).first()
    assert found["total_orders"] == 10 and found["last_update"] > found["first_update"]


def test_generated_orders_keep_their_ranges(spark):
    ids = spark.range(2000)
    orders = generate_orders(ids, RUN)
    seen = orders.agg(
        F.min("user_id"), F.max("user_id"), F.min("total_products"), F.max("total_products"),
        F.min("created_at"), F.max("created_at")).first()
    assert seen[:4] == (1, 100, 1, 5)
    lines = orders.select("id", "total", F.explode("products").alias("p")).select("id", "total", "p.*")
    wrong = lines.where(~(F.col("price").between(10, 500) & F.col("quantity").between(1, 3)
                          & F.col("discountPercentage").between(0, 30)))
    assert wrong.count() == 0
    late = orders.where((F.col("updated_at") < F.col("created_at"))
                        | (F.col("updated_at") > F.col("created_at") + F.expr("INTERVAL 24 HOURS")))
    assert late.count() == 0
    sums = orders.select("total", F.aggregate(
        "products", F.lit(0.0), lambda a, p: a + p["total"]).alias("s"))
    assert sums.where(F.abs(F.col("total") - F.col("s")) > 0.005).count() == 0


def test_generated_orders_do_not_depend_on_partitions(spark):
    one = generate_orders(spark.range(0, 300, 1, 1), RUN)
    many = generate_orders(spark.range(0, 300, 1, 7).repartition(5), RUN)
    assert rows(one) == rows(many)


def test_union_of_pulls_with_other_keys(spark):
    a, b = spark.sql("SELECT 1 AS id, 'a' AS x"), spark.sql("SELECT 2 AS id, 'b' AS y")
    assert rows(pages.union_pulls(a, b)) == [(1, "a", None), (2, None, "b")]


def test_wholetext_names_without_digits(spark, tmp_path):
    os.makedirs(tmp_path / "p")
    (tmp_path / "p" / "7.json").write_text("[]")
    assert pages.read_page_files(spark, str(tmp_path / "p")).first()["page"] == 7


def test_a_body_is_parsed_once_per_pass(spark, folder):
    bodies = spark.sql("SELECT 1L AS page, '{\"users\": [{\"id\": 1}]}' AS body")
    bodies.write.parquet(folder)
    opened = pages.unwrap(pages.read_page_table(spark, folder))
    rows_ = pages.typed(pages.explode_records(pages.keep_wanted_pages(opened)), "struct<id:bigint>")
    assert rows(rows_.select("id")) == [(1,)]
    scan = plan_of(rows_).split("Subquery")[0] + plan_of(pages.explode_records(opened))
    assert scan.count("parseJson") == 2  # one in each of the two plans


def body(records):
    return json.dumps({"data": records})


def test_nested_names_reach_the_users(spark):
    one = spark.createDataFrame([(1, body([
        {"id": 1, "email": "a@x.org", "name": {"firstname": "Ann", "lastname": "Lee"}},
        {"id": 2, "email": "b@x.org", "firstName": "Bo", "lastName": "Ray"}]))], "page bigint, body string")
    found = transform_users(pages.read_users(one, RUN), RUN)
    assert rows(found.select("user_id", "first_name", "last_name", "full_name")) == [
        (1, "Ann", "Lee", "Ann Lee"), (2, "Bo", "Ray", "Bo Ray")]


def test_all_product_fields_are_read(spark):
    one = spark.createDataFrame([(1, body([
        {"id": 1, "title": "a", "status": "retired", "list_price": 5, "created_at": "2024-01-01",
         "dimensions": {"width": 1.5, "unit": "cm"}},
        {"id": 2, "title": "b"}]))], "page bigint, body string")
    read = pages.read_products(one, RUN)
    assert rows(read.select("id", "status", "list_price", "created_at")) == [
        (1, "retired", "5", "2024-01-01"), (2, "ACTIVE", None, None)]
    from medallion.plans.entities import clean_products
    assert rows(clean_products(read).select("id", "status", "is_active")) == [
        (1, "RETIRED", False), (2, "ACTIVE", True)]
    sizes = transform_products(read, RUN).where("id = 1").first()["dimensions"]
    assert json.loads(sizes) == {"width": 1.5, "unit": "cm"}


def test_dated_file_names_and_pages_claimed_twice(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"users_2024-06-01_page_{n:04d}.json").write_text("[]")
    found = pages.read_page_files(spark, str(tmp_path))
    assert rows(found.select("page")) == [(1,), (2,)]
    (tmp_path / "users_2024-06-02_page_0002.json").write_text("[]")
    with pytest.raises(pages.DuplicatePageError, match="page number 0002"):
        pages.read_page_files(spark, str(tmp_path))


def test_a_short_page_in_the_middle(spark, folder):
    landed = spark.createDataFrame(
        [(p, body([{"id": 10 * p + i} for i in range(n)])) for p, n in ((1, 3), (2, 1), (3, 3))], "page bigint, body string")
    kind = "struct<id:bigint>"
    for form in (landed, pages.land_counted(landed, folder)):
        stopped = pages.extract(form, kind, RUN, "/x", page_size=3)
        assert rows(stopped.select("id")) == [(10,), (11,), (12,), (20,)]
        every = pages.extract(form, kind, RUN, "/x", page_size=3, stop_at_short_page=False)
        assert every.count() == 7
        assert rows(pages.left_out(form, page_size=3)) == [(1, 3)]
    plan = plan_of(pages.extract(form, kind, RUN, "/x", page_size=3))
    assert plan.split("Subquery")[0].count("parseJson") == 1
    assert "parseJson" not in plan_of(form.agg(F.min(F.when(F.col("n") < 3, F.col("page")))))


def logged(folder, sizes, page_size):
    """A fetch over pages of given sizes that notes what it was asked for."""
    def fetch(offset, size, since):
        with open(os.path.join(folder, f"{offset}"), "a") as f:
            f.write(f"{size} {since.isoformat() if since else None}\n")
        page = offset // page_size
        if page >= len(sizes):
            return None
        return json.dumps({"users": [{"id": offset + i, "updated_at": f"2024-01-{page + 1:02d}"} for i in range(sizes[page])]})

    return fetch


def test_paged_source_reads_runs_of_pages(spark, tmp_path):
    found = pages_of(spark, logged(str(tmp_path), [10] * 25 + [4, 10], 10), pages=40, run=4, page_size=10)
    assert found.rdd.getNumPartitions() == 10
    kept = found.select("page", "n").collect()
    # the run of page 26 stops there; those behind the last page ask once
    assert sorted(tuple(r) for r in kept) == [(i, 10) for i in range(1, 26)] + [(26, 4)]
    asked = sorted(int(name) // 10 + 1 for name in os.listdir(tmp_path))
    assert asked == [*range(1, 27), 29, 33, 37]
    landed = pages.land_counted(found.select("page", "body"), str(tmp_path / "landed"))
    ids = pages.extract(landed, "struct<id:bigint,updated_at:string>", RUN, "/users", page_size=10)
    assert [r[0] for r in rows(ids.select("id").orderBy("id"))] != [] and ids.count() == 254
    assert {r["id"] for r in ids.collect()} == set(range(254))


def test_paged_source_asks_with_the_bound(spark, tmp_path):
    since = datetime(2024, 1, 1, 12)
    found = pages_of(spark, logged(str(tmp_path), [3, 1], 3), pages=2, since=since, run=1, page_size=3)
    for _ in range(2):
        got = found.where(F.col("n") < 3).collect()
        assert [(r["page"], r["n"], r["since"]) for r in got] == [(2, 1, since)]
    seen = {line for name in os.listdir(tmp_path) for line in (tmp_path / name).read_text().splitlines()}
    assert len(seen) == 1 and seen.pop().startswith("3 2024-01-01T12:00:00")
    assert found.where(F.col("since") == F.lit(datetime(2024, 1, 2))).count() == 0
    everything = pages_of(spark, logged(str(tmp_path), [3, 1], 3), pages=2, run=1, page_size=3)
    assert rows(everything.select("page", "since")) == [(1, None), (2, None)]


def test_paged_source_without_pages_and_with_failures(spark):
    assert pages_of(spark, lambda offset, size, since: None, pages=0).count() == 0
    assert pages_of(spark, lambda offset, size, since: None, pages=3, run=1).count() == 0
    assert rows(pages_of(spark, lambda offset, size, since: "no json", pages=2, run=2).select("page", "n")) == [(1, 0)]

    def broken(offset, size, since):
        raise OSError("source is down")

    with pytest.raises(Exception, match="source is down"):
        pages_of(spark, broken, pages=1).collect()
    with pytest.raises(ValueError):
        pages_of(spark, broken, pages=1, run=0)


def test_counts_of_records_follow_the_envelope(spark):
    bodies = ['[{"id": 1}, {"id": 2}]', '{"products": [{"id": 3}], "total": 1}', '{"products": {"id": 4}}',
              '{"data": [], "users": [{"id": 5}]}', "7", '{"data": [', None, '{"posts": [1, 2], "items": [3]}', "null", '"text"']
    assert [record_count(b) for b in bodies] == [r["n"] for r in opened(spark, bodies).orderBy("page").collect()]


def test_id_cuts_balance_a_sparse_id_space(spark):
    # nine tenths of the ids lie in a thousandth of the range, and one id is repeated; some are null
    ids = spark.range(0, 10_000).select(F.when(F.col("id") % 10 > 0, F.col("id")).otherwise(F.col("id") * 1_000_003).alias("id"))
    ids = ids.union(spark.range(50).select(F.lit(None).cast("bigint").alias("id")))
    cuts = relational.id_cuts(ids, 8)
    conditions = relational.id_predicates(cuts)
    assert len(conditions) == 8 and cuts == sorted(cuts)
    counts = [ids.where(c).count() for c in conditions]
    assert sum(counts) == 10_050 and max(counts) < 1.1 * 10_050 / 8
    even = ids.where(F.col("id") < 9_999 * 1_000_003 // 8).count()
    assert even > 0.9 * 10_000  # what the first of eight even ranges would read


def test_id_cuts_of_few_or_equal_ids(spark):
    same = spark.range(100).select(F.lit(7).cast("bigint").alias("id"))
    for ids, n in ((same, 100), (same.limit(0), 0), (spark.range(3), 3)):
        for parts in (1, 2, 5):
            conditions = relational.id_predicates(relational.id_cuts(ids, parts))
            assert 1 <= len(conditions) <= parts
            assert sum(ids.where(c).count() for c in conditions) == n


@pytest.mark.parametrize("seed", range(3))
def test_id_predicates_part_all_rows(spark, seed):
    import random
    draw = random.Random(seed)
    ids = [draw.choice([None, draw.randint(-50, 50), draw.randint(-10**12, 10**12)]) for _ in range(200)]
    cuts = sorted({draw.randint(-60, 60) for _ in range(draw.randint(1, 6))})
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    hits = df.select(*[F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"c{i}") for i, c in enumerate(relational.id_predicates(cuts))])
    assert {sum(r) for r in hits.collect()} == {1}
