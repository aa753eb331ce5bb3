"""Builds over landed folders: full, incremental and repair agree."""

import os
import re

import pytest
from pyspark.sql import functions as F

from barlake.operators import serve
from barlake.operators.windows import factor_steps
from barlake.plans import build as build_module
from barlake.plans.build import TARGETS, Paths, _Job, _SCHEMAS, build, build_all, stored_steps
from barlake.plans import landed
from barlake.schemas import DOC, DOC_SECTION, FINANCE_MEASURES, STEP_LOG
from barlake.sources import files
from barlake.sources.sinks import read_version, table_parts, write_parts
from catalog import build_queries

CODES = ["000001", "300001", "600000", "688001", "900001"]


def land(spark, root, days, price=1.0):
    bars = [(c, f"2023-12-{d:02d} 15:00" if d > 20 else f"2024-01-{d:02d} 15:00", price * (10.0 + d + i), 9.0, 100.0, 1.0, 200.0, 5.0)
            for i, c in enumerate(CODES) for d in days]
    daily = spark.createDataFrame(bars, "stock_code string, datetime string, close double, open double, high double, low double, volume double, amount double")
    daily.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/daily_primary")
    minute = daily.withColumnRenamed("volume", "vol")
    minute.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/minute")


XDXR = [("600000", 2024, 1, 3, 1, 5.0, 0.0, 1.0, 0.0), ("600000", 2024, 1, 4, 2, 5.0, 0.0, 1.0, 0.0)]


def land_events(spark, root, rows):
    kind = "code string, year int, month int, day int, category int, fenhong double, peigujia double, songzhuangu double, peigu double"
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/xdxr")


@pytest.fixture()
def paths(spark, tmp_path):
    root = str(tmp_path / "bronze")
    stocks = [(c, f"n{c}", "sz" if c[0] in "03" else "sh") for c in CODES]
    spark.createDataFrame(stocks, "code string, name string, market string").coalesce(1).write.parquet(f"{root}/stocks")
    fin = spark.createDataFrame([(c, 20240101, 20230101) for c in CODES], "code string, updated_date bigint, ipo_date bigint")
    fin.withColumns({m: F.lit(1.0) for m in FINANCE_MEASURES}).withColumn("ingested_at", F.lit("2024-01-02").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{root}/finance")
    land_events(spark, root, XDXR)
    docs = tmp_path / "bronze" / "docs"
    docs.mkdir()
    for c in CODES:
        (docs / f"{c}_20240105.txt").write_text(f"=== a ===\nprofile ◇{c} N{c} x\ntext of {c}")
    land(spark, root, [28, 29, 2, 3, 4])
    return Paths(root, str(tmp_path / "silver"))


def stored(spark, paths, target):
    df = read_version(spark, paths.clean(target), _SCHEMAS[target]).select(*_SCHEMAS[target].fieldNames())
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_full_then_nothing_new(spark, paths):
    got = {r.target: r for r in build_all(spark, "full", paths).collect()}
    assert list(got) == TARGETS
    assert {t: (r.status, r.rows_written) for t, r in got.items()} == {
        "stock_map": ("ok", 4), "daily": ("ok", 25), "adj_factor": ("ok", 1),
        "minute": ("ok", 25), "finance": ("ok", 5), "doc": ("ok", 5)}
    before = {t: stored(spark, paths, t) for t in TARGETS}
    again = {r.target: r for r in build_all(spark, "incremental", paths, day="2024-01-04").collect()}
    assert {t: r.rows_written for t, r in again.items()} == {
        "stock_map": 0, "daily": 0, "adj_factor": 0, "minute": 0, "finance": 5, "doc": 0}
    assert {t: stored(spark, paths, t) for t in TARGETS} == before


def test_incremental_day_by_day_equals_full(spark, paths, tmp_path):
    bars = ["daily", "adj_factor", "minute"]
    days = {29: "2023-12-29", 2: "2024-01-02", 3: "2024-01-03"}
    for i, (d, day) in enumerate(days.items()):
        land(spark, paths.bronze, list(days)[: i + 1])
        land_events(spark, paths.bronze, XDXR if d == 3 else XDXR[1:])  # landed on its day
        for target in bars:
            build(spark, target, "incremental", paths, day=day)
    whole = Paths(paths.bronze, str(tmp_path / "whole"))
    for target in bars:
        build(spark, target, "full", whole)
        assert stored(spark, paths, target) == stored(spark, whole, target), target


def test_repair_replaces_only_its_codes(spark, paths):
    build_all(spark, "full", paths)
    before = {t: stored(spark, paths, t) for t in TARGETS}
    land(spark, paths.bronze, [2, 3, 4], price=2.0)
    results = {r.target: r for r in build_all(spark, "repair", paths, codes=["600000", "300001"]).collect()}
    assert {r.status for r in results.values()} == {"ok"}, results
    daily = read_version(spark, paths.clean("daily"), _SCHEMAS["daily"])
    mine = daily.filter(F.col("stock_code").isin("600000", "300001"))
    assert mine.count() == 6 and mine.filter("year(trade_date) = 2023").count() == 0
    assert mine.filter("stock_code = '600000' and trade_date = '2024-01-02'").first().close == 28.0
    rest = [r for r in stored(spark, paths, "daily") if "600000" not in r and "300001" not in r]
    assert rest == [r for r in before["daily"] if "600000" not in r and "300001" not in r]
    for target in ("stock_map", "finance", "doc"):
        assert stored(spark, paths, target) == before[target]


def test_repair_drops_a_year_left_empty(spark, paths):
    build(spark, "daily", "full", paths)
    land(spark, paths.bronze, [2, 3, 4])
    build(spark, "daily", "repair", paths, codes=CODES)
    assert read_version(spark, paths.clean("daily"), _SCHEMAS["daily"]).filter("year(trade_date) = 2023").count() == 0


def test_changed_document_is_stored_once(spark, paths, tmp_path):
    build(spark, "doc", "full", paths)
    (tmp_path / "bronze" / "docs" / "600000_20240105.txt").write_text("=== a ===\nnew text")
    for expected in (1, 0):
        assert build(spark, "doc", "incremental", paths, day="2024-01-06").first().rows_written == expected
    rows = read_version(spark, paths.clean("doc"), _SCHEMAS["doc"])
    assert rows.count() == 5 and "new text" in rows.filter("stock_code = '600000'").first().html


def test_failures_and_skips_are_reported(spark, paths):
    assert build(spark, "daily", "repair", paths).first().status == "skipped"
    assert build(spark, "daily", "other", paths).first().status == "skipped"
    bad = build(spark, "minute", "full", Paths(paths.bronze + "-none", paths.silver)).first()
    assert bad.status == "fail" and bad.errors


def test_late_day_corrects_the_bar_after_it(spark, paths, tmp_path):
    land(spark, paths.bronze, [28, 29, 2, 4])
    build(spark, "daily", "full", paths)
    land(spark, paths.bronze, [28, 29, 2, 3, 4])
    for rows in (5, 0):
        assert build(spark, "daily", "incremental", paths, day="2024-01-03").first().rows_written == rows
    land(spark, paths.bronze, [27, 28, 29, 2, 3, 4])  # and one whose next bar stands in its own year
    build(spark, "daily", "incremental", paths, day="2023-12-27")
    whole = Paths(paths.bronze, str(tmp_path / "whole"))
    build(spark, "daily", "full", whole)
    assert stored(spark, paths, "daily") == stored(spark, whole, "daily")
    assert not list((tmp_path / "silver" / "repair").iterdir())


def test_repair_takes_codes_as_a_table_and_checks_the_years_it_wrote(spark, paths, tmp_path):
    build(spark, "minute", "full", paths)
    part = read_version(spark, paths.clean("minute"), _SCHEMAS["minute"]).filter("year = 2023 and stock_code = '600000'").drop("year")
    job_path = next((tmp_path / "silver" / "minute").iterdir())
    part.write.mode("append").parquet(f"{job_path}/year=2023")  # repeated keys in the older year
    codes = spark.createDataFrame([("bars", "300001"), ("bars", None)], "table string, code string")
    got = build(spark, "minute", "repair", paths, codes=codes).first()
    assert got.status == "partial" and "error" in got.errors[0]
    got = build(spark, "minute", "repair", paths, codes=codes.filter("code is null")).first()
    assert got.status == "skipped"


def test_undated_events_do_not_grow(spark, paths):
    land_events(spark, paths.bronze, [*XDXR, ("600000", 2024, 2, 31, 1, 5.0, 0.0, 1.0, 0.0)])
    build(spark, "daily", "full", paths)
    assert build(spark, "adj_factor", "full", paths).first().rows_written == 1
    for _ in range(2):
        assert build(spark, "adj_factor", "incremental", paths, day="2024-01-04").first().rows_written == 0


def test_indexed_documents_are_read_by_batch(spark, tmp_path):
    docs = lambda rows: spark.createDataFrame(rows, "stock_code string, day string, text string").selectExpr("stock_code", "cast(day as date) as trade_date", "text")
    paths = Paths(str(tmp_path / "bronze"), str(tmp_path / "silver"))
    at = paths.raw("docs_landed")
    files.land_documents(docs([(c, "2024-01-05", f"=== a ===\ntext of {c}") for c in CODES]), at, "b1")
    assert build(spark, "doc", "full", paths).first().rows_written == 5
    assert build(spark, "doc", "incremental", paths, day="2024-01-06").first().rows_written == 0
    files.land_documents(docs([("600000", "2024-01-06", "=== a ===\nnew"), ("300001", "2024-01-06", "=== a ===\ntext of 300001")]), at, "b2")
    known = read_version(spark, paths.clean("doc"), _SCHEMAS["doc"])
    changed = files.landed_documents(spark, at, known)
    assert [r.stock_code for r in changed.collect()] == ["600000"]
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "batch" in plan and "b2" in plan and "b1" not in plan.split("PartitionFilters")[1][:80]
    assert build(spark, "doc", "incremental", paths, day="2024-01-06").first().rows_written == 1


def test_step_numbers_continue(spark, tmp_path):
    steps = lambda rows: spark.createDataFrame([("p", s, n, 0, 0, 0, "ok", [], []) for s, n in rows], "plan_id string, step_name string, rows long, failed long, n_errors long, n_failed_codes long, status string, failed_codes array<string>, errors array<string>")
    root = str(tmp_path / "step")
    landed.save_steps(spark, root, steps([("b", 1), ("a", 1)]))
    landed.save_steps(spark, root, steps([("b", 2), ("c", 3)]))
    got = {r.step_name: (r.seq, r.rows) for r in read_version(spark, root, STEP_LOG).collect()}
    assert got == {"a": (0, 1), "b": (1, 2), "c": (2, 3)}


def text_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stamped(spark, root, rows, at, mode="append"):
    """Minute bars that land at a time."""
    kind = "stock_code string, datetime string, close double, open double, high double, low double, vol double, amount double"
    full = [(c, t, p, p, p + 1, p - 1, 1.0, 1.0) for c, t, p in rows]
    df = spark.createDataFrame(full, kind).withColumn("ingested_at", F.lit(at).cast("timestamp_ntz"))
    df.coalesce(1).write.mode(mode).option("partitionOverwriteMode", "static").parquet(f"{root}/minute")


def test_minute_marks_prune_what_was_looked_at(spark, tmp_path):
    paths = Paths(str(tmp_path / "bronze"), str(tmp_path / "silver"))
    stamped(spark, paths.bronze, [("600000", "2024-01-02 09:31:00", 5.0), ("000001", "2020-01-02 09:31:00", 5.0)], "2024-01-02 16:00")
    build(spark, "minute", "full", paths)
    stamped(spark, paths.bronze, [("600000", "2024-01-03 09:31:00", 6.0), ("300001", "2019-05-05 10:00:00", 7.0)], "2024-01-03 16:00")
    assert build(spark, "minute", "incremental", paths, day="2024-01-03").first().rows_written == 2
    job = _Job(spark, "minute", paths)
    marks = {r.stock_code: (str(r.mark), str(r.arrived)) for r in job.marks().collect()}
    at = "2024-01-03 16:00:00"
    assert marks == {"600000": ("2024-01-03 09:31:00", at), "000001": ("2020-01-02 09:31:00", at), "300001": ("2019-05-05 10:00:00", at)}
    text = text_of(job.rows(day="2024-01-04"))
    assert "GreaterThanOrEqual(ingested_at,2024-01-02T16:00)" in text
    assert f"{paths.silver}/minute/v=" not in text and "marks" in text  # the stored table isn't read
    # a whole build later the marks are those of the table
    before = stored(spark, paths, "minute")
    build(spark, "minute", "full", paths)
    assert stored(spark, paths, "minute") == before
    assert {r.stock_code for r in _Job(spark, "minute", paths).marks().collect()} == set(marks)


def test_minute_rows_without_stamps_are_pruned_by_the_least_mark(spark, paths):
    build(spark, "minute", "full", paths)
    text = text_of(_Job(spark, "minute", paths).rows(day="2024-01-05"))
    assert "GreaterThanOrEqual(datetime,2024-01-04)" in text
    land(spark, paths.bronze, [28, 29, 2, 3, 4, 5])
    more = spark.read.parquet(paths.raw("minute")).limit(1).withColumns({"stock_code": F.lit("111111"), "datetime": F.lit("2001-02-03 10:00")})
    more.write.mode("append").parquet(paths.raw("minute"))
    assert build(spark, "minute", "incremental", paths, day="2024-01-05").first().rows_written == 6


@pytest.mark.parametrize("stop", ["before the bars", "half of the bars"])
def test_a_stopped_append_loses_nothing(spark, paths, tmp_path, monkeypatch, stop):
    land(spark, paths.bronze, [28, 29, 2])
    build(spark, "minute", "full", paths)
    before = stored(spark, paths, "minute")
    land(spark, paths.bronze, [28, 29, 2, 3, 4])
    real = build_module.write_parts

    def stopped(df, root, by, order=(), replaced=None, path=None):
        if stop == "half of the bars":  # the newer day is there, its marker isn't
            real(df.filter("datetime >= '2024-01-04'"), root, by, order, replaced, path)
            (tmp_path / path[path.index("silver"):] / "_SUCCESS").unlink()
        raise OSError("stopped")

    monkeypatch.setattr(build_module, "write_parts", stopped)
    assert build(spark, "minute", "incremental", paths, day="2024-01-04").first().status == "fail"
    assert stored(spark, paths, "minute") == before
    monkeypatch.undo()
    assert build(spark, "minute", "incremental", paths, day="2024-01-04").first().rows_written == 10
    whole = Paths(paths.bronze, str(tmp_path / "whole"))
    build(spark, "minute", "full", whole)
    assert stored(spark, paths, "minute") == stored(spark, whole, "minute")


def test_a_repair_leaves_older_versions_whole(spark, paths):
    """A reader that began before a repair, or while it runs, sees all years as they were."""
    build(spark, "daily", "full", paths)
    reader = read_version(spark, paths.clean("daily"), _SCHEMAS["daily"])
    before = sorted(map(str, reader.collect()))
    land(spark, paths.bronze, [28, 29, 2, 3, 4], price=2.0)
    build(spark, "daily", "repair", paths, codes=["600000"])
    assert sorted(map(str, reader.collect())) == before
    parts = table_parts(spark, paths.clean("daily"))
    assert [p for p, _ in parts] == ["year=2023", "year=2024"] and len({v for _, v in parts}) == 1


def test_unused_parts_are_dropped(spark, paths, tmp_path):
    build(spark, "daily", "full", paths)
    for k in range(4):
        land(spark, paths.bronze, [2, 3, 4], price=2.0 + k)  # 2023 goes with the first repair
        build(spark, "daily", "repair", paths, codes=CODES if k == 0 else ["600000"])
    root = tmp_path / "silver" / "daily"
    assert len([v for v in root.iterdir() if v.name.startswith("v=")]) == 2
    assert read_version(spark, paths.clean("daily"), _SCHEMAS["daily"]).count() == 15


def test_events_prune_the_years_of_bars(spark, paths):
    build(spark, "daily", "full", paths)
    build(spark, "adj_factor", "full", paths)
    text = text_of(_Job(spark, "adj_factor", paths).rows(day="2024-01-04"))
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", text)


def test_one_changed_section_rewrites_one_bucket(spark, paths, tmp_path):
    at = tmp_path / "bronze" / "docs"
    for c in CODES:
        (at / f"{c}_20240105.txt").write_text(f"=== a ===\nprofile of {c}\n=== b ===\nsecond of {c}\n=== c ===\nthird")
    build(spark, "doc", "full", paths)
    was = dict(table_parts(spark, paths.clean("doc")))
    (at / "600000_20240105.txt").write_text("=== a ===\nprofile of 600000\n=== b ===\nnew text\n=== c ===\nthird")
    # what is known isn't parsed: a stored section that says something else shows in the new page
    known = read_version(spark, paths.clean("doc_section"), DOC_SECTION)
    assert known.count() == 15
    job = _Job(spark, "doc", paths)
    odd = known.select(*DOC_SECTION.fieldNames()).withColumn("html", F.concat(F.lit("known "), "name"))
    job.sections = lambda: odd
    assert [r.html.count("known") for r in job.rows(day="2024-01-06").collect()] == [2]
    assert build(spark, "doc", "incremental", paths, day="2024-01-06").first().rows_written == 1
    now = dict(table_parts(spark, paths.clean("doc")))
    assert len([b for b in was if was[b] != now[b]]) == 1 and set(was) == set(now)
    whole = Paths(paths.bronze, str(tmp_path / "whole"))
    build(spark, "doc", "full", whole)
    assert stored(spark, paths, "doc") == stored(spark, whole, "doc")
    sections = lambda p: sorted(map(str, read_version(spark, p.clean("doc_section"), DOC_SECTION).select(*DOC_SECTION.fieldNames()).collect()))
    assert sections(paths) == sections(whole)


def test_steps_are_those_of_the_factors(spark, paths):
    build(spark, "daily", "full", paths)
    assert stored_steps(spark, paths) is None
    build(spark, "adj_factor", "full", paths)
    first = stored_steps(spark, paths)
    assert first.count() == 2
    land_events(spark, paths.bronze, [*XDXR, ("600000", 2024, 1, 4, 1, 5.0, 0.0, 1.0, 0.0), ("300001", 2024, 1, 3, 1, 5.0, 0.0, 1.0, 0.0)])
    build(spark, "adj_factor", "incremental", paths, day="2024-01-04")
    factors = read_version(spark, paths.clean("adj_factor"), _SCHEMAS["adj_factor"])
    kept = stored_steps(spark, paths)
    assert sorted(map(str, kept.collect())) == sorted(map(str, factor_steps(factors).select(kept.columns).collect())) and kept.count() == 5


def test_a_short_adjusted_range_reads_its_days_and_the_bar_before(spark, tmp_path):
    """All bars but those of the range and the one before it are wrong on purpose."""
    root, days = str(tmp_path / "daily"), [f"{y}-06-{d:02d}" for y in (2019, 2020, 2021, 2022, 2023, 2024) for d in range(1, 29)]
    rows = [("600000", d, 10.0 + i, 9.0 + i if i else None) for i, d in enumerate(days)] + [("000001", "2020-06-03", 7.0, None), ("000001", "2024-06-10", 8.0, 7.0)]
    bars = spark.createDataFrame(rows, "stock_code string, day string, close double, pre_close double").select("stock_code", F.col("day").cast("date").alias("trade_date"), "close", "close", "pre_close")
    bars = bars.toDF("stock_code", "trade_date", "open", "close", "pre_close").withColumns({"high": F.col("close"), "low": F.col("close")})
    events = spark.createDataFrame([("600000", "2023-06-20", 0.5), ("600000", "2024-06-09", 0.8), ("000001", "2021-01-01", 0.5)], "stock_code string, day string, single_factor double").select("stock_code", F.col("day").cast("date").alias("trade_date"), "single_factor")
    want = serve.daily_batch(bars, ["600000", "000001"], "2024-06-09", "2024-06-12", "qfq", events).collect()
    assert [(r.stock_code, str(r.trade_date), r.close, r.pre_close) for r in want][:2] == [("000001", "2024-06-10", 8.0, 3.5), ("600000", "2024-06-09", 158.0, 157 * 0.8)]
    write_parts(bars.withColumn("year", F.year("trade_date")), root, "year", ["stock_code", "trade_date"])
    stored_bars = read_version(spark, root, bars.schema)
    out = serve.daily_batch(stored_bars, ["600000"], "2024-06-09", "2024-06-12", "qfq", steps=factor_steps(events))
    assert [tuple(r) for r in out.select(*bars.columns).collect()] == [tuple(r) for r in want if r.stock_code == "600000"]
    text = text_of(out)
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text, re.S)
    assert filters and all("year" in f and "2024" in f for f in filters)
    assert [tuple(r) for r in serve.daily_batch(stored_bars, ["600000", "000001"], "2024-06-09", "2024-06-12", "qfq", events).select(*bars.columns).collect()] == [tuple(r) for r in want]


def test_texts_of_landed_documents_move_once_and_are_stored_small(spark, tmp_path):
    at = str(tmp_path / "docs")
    rows = [(f"{i:06d}", f"=== a ===\n{'word ' * 50}{i}") for i in range(20)]
    docs = spark.createDataFrame(rows + rows[:5], "stock_code string, text string")
    files.land_documents(docs.selectExpr("stock_code", "date'2024-01-05' as trade_date", "text"), at, "b1")
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "docs").rglob("part-*"))
    got = files.landed_documents(spark, at)
    assert sorted((r.stock_code, r.text) for r in got.collect()) == rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = files.landed_documents(spark, at)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [k for k in re.findall(r"hashpartitioning\(([^)]*)", plan) if "batch" in k]
    assert keys and not re.search(r"hashpartitioning\([^)]*text#", plan)  # texts moved again, to be made distinct


def test_reports_land_as_files_of_few_folders(spark, tmp_path):
    class Inputs:
        """Three reports, two of them equal; of the other inputs it doesn't matter what is in them."""

        def __getattr__(self, name):
            return spark if name == "spark" else lambda: spark.range(1)

        def fx_reports(self):
            rows = [("000001", "=== a ===\nx"), ("000001", "=== a ===\nx"), (None, "=== a ===\nother")]
            return spark.createDataFrame(rows, "code string, text string").coalesce(1)

    landed_at = build_queries.land(Inputs(), with_docs=True)
    found = [(folder, names) for folder, _, names in os.walk(landed_at.raw("docs")) if names]
    assert len(found) == 1 and len(found[0][1]) == 3
    assert all(n.startswith("report-") for n in found[0][1])  # written by the tasks themselves, not by Spark's writer
    build_module.build_full(spark, "doc", landed_at)
    pages = read_version(spark, landed_at.clean("doc"), DOC).collect()
    assert len({p.stock_code for p in pages}) == len(pages) == 3  # equal reports stay two
    assert [p.html.count("other") for p in sorted(pages, key=lambda p: p.file_size)] == [0, 0, 1]
