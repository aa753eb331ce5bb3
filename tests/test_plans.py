"""What every plan must and must not contain."""

import re

import pytest
from pyspark.sql.functions import spark_partition_id

import __spark_entry__ as entry
from barlake.operators import aggregates, serve
from barlake.sources.sinks import write_by_year
from catalog import registry
from catalog.fixtures import Tables

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry.queries().items() if k in registry.QUERIES}
# these run jobs of their own while being built; their steps are covered by the others
ACTIVE = {n for n in QUERIES if n.startswith(("stream_", "build_", "sink_"))} | {"src_documents", "src_documents_landed", "src_documents_compacted", "src_industry_csv", "src_gbk_text", "landed_dedup", "landed_dedup_all", "run_log", "q_daily_qfq_stored"}
LAZY = sorted(set(QUERIES) - (ACTIVE - {"build_daily", "build_minute", "build_stock_map", "build_finance"}))

FORBIDDEN = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
    "MapInPandas", "PythonMapInArrow", "FlatMapGroupsInPandas", "CollectLimit",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    spark = df.sparkSession
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in text]
    # only the table of bucket sizes is ever ordered as a whole
    whole = [w for w in re.findall(r"Window \[.*", text) if w.count("], [") == 1]
    assert all("__bucket" in w for w in whole)


def test_filters_reach_the_scan(spark, tmp_path):
    t = Tables(spark, SF)
    path = str(tmp_path / "minute")
    write_by_year(t.fx_minute(), path, "datetime", order=["stock_code"])
    text = formatted(serve.minute(spark.read.parquet(path), "sh600002", "2024-01-10"))
    assert re.search(r"PartitionFilters: \[.*year.*2024", text)
    assert "EqualTo(stock_code,600002)" in text and "GreaterThanOrEqual(datetime" in text


def test_latest_document_aggregates_keys_only(spark):
    text = plan(QUERIES["q_latest_doc"](spark, SF))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted("text" in s for s in scans) == [False, True]


def test_keep_one_combines_before_the_shuffle(spark):
    for name in ("dedup_keep_last", "merge_by_priority", "upsert_update"):
        text = plan(QUERIES[name](spark, SF))
        assert "partial_m" in text and "row_number" not in text


def test_daily_build_has_two_shuffles_after_its_inputs(spark):
    t = Tables(spark, SF)
    inputs = plan(t.fx_daily_a()).count("Exchange") + plan(t.fx_daily_b()).count("Exchange")
    assert plan(t.fx_daily()).count("Exchange") - inputs == 2


def test_members_of_an_industry_are_ranked_in_ranges(spark):
    rows = [(("a", None)[i % 50 == 0], f"{i % 900:06d}", "n", float(i % 21 - 10)) for i in range(4000)]
    df = spark.createDataFrame(rows, "industry string, code string, name string, pct double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = aggregates.industry_members(df, "industry").withColumn("task", spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in ("a", None):
        own = sorted((r for r in got if r.industry == name), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, len(own) + 1))
        order = [(-abs(r.pct), r.code, r.name, r.pct) for r in own]
        assert order == sorted((-abs(p), c, n, p) for i, c, n, p in rows if i == name)
    assert len({r.task for r in got if r.industry == "a"}) > 1  # one task had them all
