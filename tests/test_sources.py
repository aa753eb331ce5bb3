import gzip
import json
import os

from pyspark.sql import functions as F

from barlake.schemas import QUOTE_FIELDS
from barlake.sources import files, parsers, sinks


def kline(spark, payloads, **kw):
    df = spark.createDataFrame([(c, json.dumps(p)) for c, p in payloads], "code string, payload string")
    return [r.asDict() for r in parsers.parse_kline_json(df, **kw).orderBy("date").collect()]


def test_kline_cells(spark):
    cells = [
        ["2024-01-01", "1", "2", "3", "0.5", "100"],
        ["2024-01-02", 1, 2, 3, 0.5, 100, "7.5"],
        ["2024-01-03", "1", "2", "3", "0.5", "100", {"fh": 1}],
        ["2024-01-04", "1", "2", "3", "0.5", "100", "9", {"fh": 2}],
        ["2024-01-05", "bad", "2", "3", "0.5", "100", "n/a"],
    ]
    got = kline(spark, [("sh600519", {"code": 0, "data": {"sh600519": {"qfqday": cells, "day": []}}})], fq="qfq")
    assert [r["amount"] for r in got] == [None, 7.5, None, 9.0, None]
    assert [r["extra"] and json.loads(r["extra"]) for r in got] == [None, None, {"fh": 1}, {"fh": 2}, None]
    assert got[1]["close"] == 2.0 and got[4]["open"] is None
    assert got[0]["stock_code"] == "sh600519"


def test_kline_series_fallback_and_errors(spark):
    row = ["2024-01-01", "1", "2", "3", "0.5", "100"]
    ok = {"code": 0, "data": {"a": {"qt": [], "hfqday": [row]}}}
    assert len(kline(spark, [("a", ok)], fq="qfq")) == 1
    assert kline(spark, [("a", ok)], ktype="week") == []
    assert kline(spark, [("b", ok)], fq="qfq") == []
    assert kline(spark, [("a", {"code": 1, "data": ok["data"]})]) == []


def test_quote_lines_have_88_fields(spark):
    assert len(QUOTE_FIELDS) == len(set(QUOTE_FIELDS)) == 88
    line = "~".join(str(i) for i in range(88))
    df = spark.createDataFrame([(line,), ("  ",), ("a~b",)], "value string")
    got = parsers.parse_quote_lines(df).collect()
    assert len(got) == 2
    assert got[0].code == "2" and got[0].tail == "87"
    assert got[1].name == "b" and got[1].tail is None


def test_intraday(spark):
    df = spark.createDataFrame([("0930 10.5 100 1050",), ("0931 10.5 100",), ("0932 x 100 5 extra",)], "item string")
    got = [tuple(r) for r in parsers.parse_intraday(df).collect()]
    assert got == [("0930", 10.5, 100.0, 1050.0), ("0932", None, 100.0, 5.0)]


def test_files(spark, tmp_path):
    (tmp_path / "gbk").mkdir()
    (tmp_path / "gbk" / "a.txt").write_bytes("平安银行~1\r\n\n贵州茅台~2\n".encode("gbk"))
    assert [r.value for r in files.read_gbk(spark, str(tmp_path / "gbk")).collect()] == ["平安银行~1", "贵州茅台~2"]
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "000001_20260622.txt").write_text("=== a ===\r\nx", newline="")
    (docs / "600000.txt").write_text("plain")
    got = {r.stock_code: (str(r.trade_date), r.text) for r in files.read_documents(spark, str(docs), "2024-05-06").collect()}
    assert got == {"000001": ("2026-06-22", "=== a ===\nx"), "600000": ("2024-05-06", "plain")}
    path = tmp_path / "industry.csv"
    path.write_text("code,name,industry\n000001,平安银行,货币金融\n000002,x,\n,y,z\n")
    assert [r.code for r in files.read_industry(spark, str(path)).collect()] == ["000001"]


def test_insert_new_dedups_against_table_and_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert sinks.insert_new(df, path, ["k"]) == 2
    assert sinks.insert_new(df, path, ["k"]) == 0
    assert spark.read.parquet(path).count() == 2


def test_lineage(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string")
    sinks.append_bronze(df, str(tmp_path / "t"), "primary", "bars", "b1")
    row = spark.read.parquet(str(tmp_path / "t")).first()
    assert (row.source_system, row.source_api, row.batch_id) == ("primary", "bars", "b1") and row.ingested_at


def test_versions_ignore_unfinished_ones(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a",)], "k string")
    assert sinks.read_version(spark, root, df.schema).count() == 0
    sinks.write_version(df, root, 1)
    path = sinks.write_version(df.unionByName(df), root, 2)
    assert sinks.read_version(spark, root, df.schema).count() == 2
    os.remove(f"{path}/_SUCCESS")
    assert sinks.read_version(spark, root, df.schema).count() == 1


def test_old_versions_are_dropped(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a",)], "k string")
    for version in range(4):
        sinks.write_version(df, root, version)
    assert len(sinks.drop_old_versions(spark, root)) == 2
    assert sorted(os.listdir(root)) == [f"v={v:020d}" for v in (2, 3)]
    assert sinks.drop_old_versions(spark, root) == []


def test_insert_new_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, 2023), ("b", 2, 2024), ("c", 3, None)], "k string, v int, y int")
    assert sinks.insert_new(df, path, ["k"], ["y"]) == 3
    assert sinks.insert_new(df.unionByName(spark.createDataFrame([("d", 4, 2024)], df.schema)), path, ["k"], ["y"]) == 1
    stored = sinks.read_table(spark, path, df.schema)
    part = sinks.touched_partitions(stored, df.filter("y = 2024"), ["y"])
    assert part.count() == 2
    assert "PartitionFilters: [(y" in part._jdf.queryExecution().executedPlan().toString()


def test_year_overwrite_touches_only_its_years(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "2023-05-01"), ("b", "2024-05-01")], "k string, d string").withColumn("d", F.col("d").cast("date"))
    sinks.write_by_year(df, path, "d")
    sinks.write_by_year(df.filter("k = 'b'").withColumn("k", F.lit("c")), path, "d", mode="overwrite")
    assert {(r.k, r.year) for r in spark.read.parquet(path).collect()} == {("a", 2023), ("c", 2024)}


def test_partitions_of_older_versions_stay_in_use(spark, tmp_path):
    """Appends and replacements over many versions, each read as a whole; what no version uses goes."""
    root = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, year int")
    sinks.write_parts(rows(("a", 1), ("b", 2)), root, "year")
    sinks.write_parts(rows(("c", 2)), root, "year", replaced=[])
    sinks.write_parts(rows(("d", 3)), root, "year", replaced=[])
    schema = spark.createDataFrame([], "k string").schema
    read = lambda: sorted((r.k, r.year) for r in sinks.read_version(spark, root, schema).collect())
    assert read() == [("a", 1), ("b", 2), ("c", 2), ("d", 3)]
    assert sinks.drop_unused_parts(spark, root) == []
    sinks.write_parts(rows(("e", 2)), root, "year", replaced=[2, 3])  # 3 has no rows any more
    sinks.write_parts(rows(("f", 4)), root, "year", replaced=[])
    assert read() == [("a", 1), ("e", 2), ("f", 4)]
    dropped = sinks.drop_unused_parts(spark, root)
    assert len([d for d in dropped if "year=" in d]) == 3 and read() == [("a", 1), ("e", 2), ("f", 4)]
    assert len([v for v in os.listdir(root) if v.startswith("v=")]) == 3  # the first one's year 1 is in use
    unfinished = sinks.write_parts(rows(("g", 1)), root, "year", replaced=[1])
    os.remove(f"{unfinished}/_SUCCESS")
    assert read() == [("a", 1), ("e", 2), ("f", 4)]


def test_written_documents_are_files_in_few_folders(spark, tmp_path):
    rows = [(f"{i:06d}_20260622", f"a\r\nb{i}") for i in range(300)] + [("000007_20260622", "again"), (None, "unnamed"), ("x", None)]
    docs = spark.createDataFrame(rows, "name string, text string").coalesce(2)
    files.write_documents(docs, str(tmp_path / "docs ü"))
    assert sum(len(d) for _, d, _ in os.walk(tmp_path / "docs ü")) <= 3  # not one per document
    got = {(r.stock_code, str(r.trade_date)): r.text for r in files.read_documents(spark, str(tmp_path / "docs ü"), "2024-01-31").collect()}
    assert len(got) == 302 and got["000008", "2026-06-22"] == "a\nb8\n" and got["x", "2024-01-31"] == "\n"
    assert got["", "2024-01-31"] == "unnamed\n"
    assert got["000007", "2026-06-22"] in ("a\nb7\n", "again\n", "a\nb7\nagain\n", "again\na\nb7\n")


def test_mounted_documents_are_listed_and_read_by_tasks(spark, tmp_path):
    # the rows are those of Spark's reader, and no list of files passes the driver
    root = tmp_path / "docs ü%"
    deep = root / "sub" / "name=7_20240103"
    deep.mkdir(parents=True)
    (root / "_hidden").mkdir()
    (root / "_hidden" / "x.txt").write_text("x")
    (deep / "part-0.txt").write_text("deep")
    for name in ("a b_20240101.txt", "行情_20240102.txt", "p%41[1]{}.txt", "q?x#y.txt", "_a=b.txt", "_x.txt", ".y.txt", "z._COPYING_"):
        (root / name).write_text(f"of {name}")
    (root / "empty.txt").write_text("")
    (root / "bad.txt").write_bytes(b"\xff\xfe\r\nx\r")
    (root / "packed_20240104.txt.gz").write_bytes(gzip.compress(b"packed"))
    for i in range(600):
        (root / f"{i:06d}_20240105.txt").write_text(f"text {i}")
    path = F.col("_metadata.file_path")
    known = spark.read.option("recursiveFileLookup", "true").text(str(root), wholetext=True)
    known = known.select(path.alias("file_path"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))
    docs = files.read_documents(spark, str(root), "2024-01-31")
    row = lambda df: sorted((r.file_path, bytes(r.b)) for r in df.withColumn("b", F.col("text").cast("binary")).collect())
    assert row(docs) == row(known) and docs.count() == 608
    assert docs.inputFiles() == []
    (root / "late.txt").write_text("landed after the plan was made")
    assert docs.filter("stock_code = 'late'").count() == 1
    assert files.read_documents(spark, f"{root}/00000*", "2024-01-31").count() == 10  # a pattern is for Spark's reader
