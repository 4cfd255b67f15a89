import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import nested, numbers, text, times
from medallion.functions.keys import surrogate_key
from medallion.functions.text import WHITE_SPACE


def apply(spark, function, values, dtype="string"):
    """Result of a column function on each value, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", function(F.col("v"), df.schema["v"].dataType).alias("o"))
    return [r["o"] for r in sorted(out.collect(), key=lambda r: r["i"])]


def plain(function):
    return lambda column, _dtype: function(column)


def test_strip_cuts_every_white_space(spark):
    assert set(WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    cases = [" a b ", "\t\na\r\n", "  x　", "", None, "\x1cy\x85"]
    expected = [c.strip() if c is not None else None for c in cases]
    assert apply(spark, plain(text.strip), cases) == expected


def test_upper_and_email(spark):
    assert apply(spark, plain(text.strip_upper), [" ab ", None]) == ["AB", None]
    assert apply(spark, plain(text.normal_email), [" A@B.Com\n", None]) == ["a@b.com", None]


def test_full_name(spark):
    df = spark.createDataFrame(
        [("Ann", "Lee"), (None, "Lee"), ("Ann", None), (None, None)], "a string, b string")
    names = [r[0] for r in df.select(text.full_name(F.col("a"), F.col("b"))).collect()]
    assert names == ["Ann Lee", "Lee", "Ann", ""]


def test_mask_all_keeps_line_breaks(spark):
    assert apply(spark, plain(text.mask_all), ["ab\nc\r", "", None, "\U0001f600x"]) == [
        "**\n**", "", None, "**"]


def test_mask_phone_works_per_run_of_digits(spark):
    cases = ["9654313024", "+81 965-431-3024", "123", "12345-67890", None]
    assert apply(spark, plain(text.mask_phone), cases) == [
        "******3024", "+81 965-431-3024", "123", "*2345-*7890", None]


def test_cut_error(spark):
    assert [len(v) for v in apply(spark, plain(text.cut_error), ["x" * 5001, "y"])] == [5000, 1]


NUMBERS = ["-5", "abc", "5d", "5F", "1e3", " 7 ", "+5", ".5", "5.", "1_000", "0x10", "0x1p3",
           "nan", "1e400", "", "-", None]
VALUES = [-5.0, None, None, None, 1000.0, 7.0, 5.0, 0.5, 5.0, None, None, None, None, None, None,
          None, None]


def test_to_number(spark):
    assert apply(spark, numbers.to_number, NUMBERS) == VALUES
    assert apply(spark, numbers.to_number, [1.5, float("nan"), None], "double") == [1.5, None, None]
    assert apply(spark, numbers.to_number, [3, None], "int") == [3.0, None]


def test_clean_money_and_clip_price(spark):
    assert apply(spark, numbers.clean_money, ["-5", "x", None, "2.5"]) == [0.0, 0.0, 0.0, 2.5]
    assert apply(spark, numbers.clip_price, ["-5", "x", None, "2.5"]) == [0.0, None, None, 2.5]


def test_margin_rounds_half_to_even(spark):
    df = spark.createDataFrame([(100.0, 60.0), (0.0, 1.0), (None, 1.0), (800.0, 799.0)],
                               "p double, c double")
    out = [r[0] for r in df.select(numbers.margin_pct(F.col("p"), F.col("c"))).collect()]
    assert out == [40.0, None, None, 0.12]


def test_first_integer(spark):
    cases = ["1 year warranty", "none", None, "up to 24 or 36", "99999999999999"]
    assert apply(spark, plain(numbers.first_integer), cases) == [1, None, None, 24, None]


def test_review_count_of_text(spark):
    cases = ["[1,2]", ' [1, {"a": [2]}] ', '{"a":1}', "7", "3.9", "-2.5", "x", "[1,", "[]", None]
    assert apply(spark, nested.review_count, cases) == [2, 2, 1, 7, 3, -2, 0, 0, 0, 0]


def test_review_count_of_native_values(spark):
    assert apply(spark, nested.review_count, [[1, 2], [], None], "array<int>") == [2, 0, 0]
    assert apply(spark, nested.review_count, [(1,), None], "struct<a:int>") == [1, 0]
    assert apply(spark, nested.review_count, [3.9, None], "double") == [3, 0]


def test_json_text(spark):
    assert apply(spark, nested.json_text, ["[1]", None]) == ["[1]", None]
    assert apply(spark, nested.json_text, [[(1, None)], None], "array<struct<a:int,b:int>>") == [
        '[{"a":1,"b":null}]', None]
    assert apply(spark, nested.json_text, [5], "int") == ["5"]


def test_surrogate_key(spark):
    expected = hashlib.sha256(b"order|42").hexdigest()[:16]
    key = lambda c, t: surrogate_key("order", c, t)
    assert apply(spark, key, [42], "bigint") == [expected]
    assert apply(spark, key, [42.0], "double") == [expected]
    assert apply(spark, key, ["42"]) == [expected]


def test_to_utc(spark):
    cases = ["2024-01-01T02:00:00+02:00", "2024-01-01 00:00:00", "2024-01-01", "soon", None]
    micros = lambda c, t: F.unix_micros(times.to_utc(c, t))
    first = 1704067200_000000
    assert apply(spark, micros, cases) == [first, first, first, None, None]
    assert apply(spark, micros, [1704067200_000000_000], "bigint") == [first]


def test_date_parts_start_the_week_on_monday(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 10:00:00' AS t")
    parts = times.date_parts(F.col("t"), "order")
    assert df.select(*[c.alias(n) for n, c in parts.items()]).first().asDict() == {
        "order_year": 2024, "order_month": 1, "order_day_of_week": 0}


def test_instants_do_not_depend_on_the_local_zone(spark):
    naive = datetime(2024, 1, 1, 0, 0, 0, 250)
    aware = naive.replace(tzinfo=timezone.utc)
    for moment in (naive, aware):
        micros = spark.range(1).select(F.unix_micros(times.instant(moment))).first()[0]
        assert times.from_micros(micros) == aware
    assert times.from_micros(None) is None


def test_elapsed_seconds(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS a, "
                   "timestamp'2024-01-01 00:01:01.239' AS b, CAST(null AS timestamp) AS n")
    out = df.select(times.elapsed_seconds(F.col("a"), F.col("b")),
                    times.elapsed_seconds(F.col("n"), F.col("b"))).first()
    assert list(out) == [61.24, None]


def test_has_path():
    schema = T.StructType.fromDDL("address struct<city:string,coordinates:struct<lat:double>>")
    assert nested.has_path(schema, "address.coordinates.lat")
    assert not nested.has_path(schema, "address.state")
    assert not nested.has_path(schema, "address.city.x")


@pytest.mark.parametrize("part,whole,expected", [(1, 3, 33.33), (0, 0, None), (1, 800, 0.12)])
def test_percent(spark, part, whole, expected):
    out = spark.range(1).select(numbers.percent(F.lit(part), F.lit(whole))).first()[0]
    assert out == expected
