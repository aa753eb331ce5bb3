from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from barlake import functions as fn


def values(spark, data, make, kind="string"):
    df = spark.createDataFrame([(v,) for v in data], f"v {kind}")
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


def test_codes(spark):
    data = ["sh600519", "sz000001", "600519", "sh60", None, "sh6005190"]
    assert values(spark, data, fn.code_to_plain) == ["600519", "000001", "600519", "sh60", None, "sh6005190"]
    assert values(spark, ["sh60", "x"], fn.strip_exchange) == ["60", "x"]
    data = ["000001", "300750", "600519", "688001", "900901", "00001", "abc"]
    assert values(spark, data, fn.code_to_prefixed) == ["sz000001", "sz300750", "sh600519", "sh688001", "900901", "00001", "abc"]
    assert values(spark, ["600519", "900901", "000001"], fn.code_to_prefixed_lookup) == ["sh600519", "sh900901", "sz000001"]


def test_universe_filters(spark):
    df = spark.createDataFrame(
        [("000001", "sz"), ("000001", "sh"), ("600000", "sz"), ("688001", "sh"), ("399001", "sz"), ("300001", None)],
        "code string, market string",
    )
    assert {tuple(r) for r in fn.filter_a_share(df).collect()} == {("000001", "sz"), ("688001", "sh")}
    assert {tuple(r) for r in fn.filter_index(df).collect()} == {("000001", "sh"), ("399001", "sz")}


def test_dates(spark):
    assert values(spark, [19991110, 0, -5, 20231301, None, 20230230], fn.int_to_date, "bigint") == [
        date(1999, 11, 10), None, None, None, None, None]
    assert values(spark, [199911101, 1999111], fn.int_to_date, "bigint") == [None, None]
    assert values(spark, ["19991110", "x", None], fn.int_to_date) == [date(1999, 11, 10), None, None]
    df = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29), (2024, None, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(fn.ymd_to_date(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [date(2024, 2, 29), None, None]
    assert values(spark, ["2024-01-05 15:00", "junk"], fn.datetime_to_date) == [date(2024, 1, 5), None]
    assert values(spark, ["2024-01-05 09:31", "bad"], fn.text_to_timestamp) == [datetime(2024, 1, 5, 9, 31), None]


def test_numbers(spark):
    assert values(spark, ["1.5", "x", "NaN", "", None, "2d", "1e3"], fn.numeric) == [1.5, None, None, None, None, None, 1000.0]
    assert values(spark, [None, 0.4, 1.9, -3.0, 100.0, float("inf")], fn.clean_volume, "double") == [0, 0, 1, 0, 100, 0]
    assert values(spark, ["3.456", "--", None], fn.pct_or_zero) == [3.46, 0.0, 0.0]
    assert values(spark, [-8.0, 6.0, -4.5, 2.0, 1.99, None], fn.heat_tier, "double") == [5, 4, 3, 2, 1, 1]


def test_quality_gate_treats_nan_and_null_as_bad(spark):
    rows = [("a", 1.0, 2.0, 1.0), ("b", 0.0, 2.0, 1.0), ("c", None, 2.0, 1.0), ("d", 1.0, 1.0, 2.0), ("e", float("nan"), 1.0, 1.0), ("f", 1.0, None, 1.0)]
    df = fn.coerce_numeric(spark.createDataFrame(rows, "k string, close double, high double, low double"), ["close", "high", "low"])
    seen = Observation()
    kept, rejects = fn.quality_gate(df, observation=seen)
    assert [r.k for r in kept.collect()] == ["a"]
    assert seen.get == {"read": 6, "rejected": 5}
    assert {r.k for r in rejects.collect()} == set("bcdef")


@pytest.mark.parametrize("clock, inside", [
    ("2024-01-05 09:24:59", False), ("2024-01-05 09:25:00", True), ("2024-01-05 11:35:00", True),
    ("2024-01-05 11:35:00.000001", False), ("2024-01-05 12:55:00", True), ("2024-01-05 15:05:01", False),
    ("2024-01-06 10:00:00", False),
])
def test_session(spark, clock, inside):
    got = values(spark, [clock], lambda c: fn.in_trading_session(c.cast("timestamp_ntz")))
    assert got == [inside]


def test_industry_label(spark):
    data = ["C27医药制造业", "J66货币金融", "医药制造业", "C27", "ABC业务", "1234", "A-1业务", "农林8x牧"]
    assert values(spark, data, fn.industry_label) == ["医药制造业", "货币金融", "医药制造业", "C27", "ABC业务", "4", "A-1业务", "x牧"]


def test_escape_and_link(spark):
    got = values(spark, ["a<b> & see https://x.y/?a=1&b=2 ok"], fn.doc_escape_link)
    link = "https://x.y/?a=1&amp;b=2"
    assert got == [f'a&lt;b&gt; &amp; see <a class="ext" href="{link}" target="_blank">{link}</a> ok']


@pytest.mark.parametrize("n", [0, 1, 200, 201, 500])
def test_code_in_list_is_the_same_at_any_length(spark, n):
    df = spark.createDataFrame([(i, f"{i:06d}") for i in range(1000)], "v int, code string")
    wanted = [f"{2 * i:06d}" for i in range(n)]
    out = fn.code_in_list(df, "code", wanted + wanted)
    assert out.columns == df.columns and {r.code for r in out.collect()} == set(wanted)
    assert out.count() == n
    listed = spark.createDataFrame([(c,) for c in wanted + wanted], "c string")
    assert fn.code_in_list(df, "code", listed).columns == df.columns and fn.code_in_list(df, "code", listed).count() == n


def test_date_prefix_filter_is_a_range(spark):
    df = spark.createDataFrame([("2024-01-05 09:31",), ("2024-01-05",), ("2024-01-06",), ("2024-01-04 23:59",)], "d string")
    assert fn.date_prefix_filter(df, "d", "2024-01-05").count() == 2
