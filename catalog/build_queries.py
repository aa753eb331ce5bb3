"""The builds as a user runs them: landed folders in, silver folders out."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.operators import serve
from barlake.operators.runs import failed_codes, run_step_rollup
from barlake.plans.build import Paths, build_all, build_full, build_incremental, build_repair, stored_steps
from barlake.plans.landed import LANDED_KEYS, dedup_landed, save_steps
from barlake.schemas import ADJ_FACTOR, DAILY, DOC, FINANCE_MEASURES, MINUTE, PRICES, STEP_LOG
from barlake.session import work_dir
from barlake.sources.files import land_documents, write_documents
from barlake.sources.sinks import read_version

from .registry import query, rounded
from .table_queries import _ADJ_ALL, _ADJ_OUT, _DAILY_OUT

C = F.col


def land(t, with_docs: bool = False, day: str | None = None) -> Paths:
    """Write the derived inputs as landed tables; ``day`` leaves out later bars."""
    root = work_dir(t.spark, "build")
    tables = {
        "stocks": t.fx_stocks(), "finance": t.fx_finance(), "xdxr": t.fx_xdxr(),
        "minute": t.fx_minute_raw(), "daily_primary": t.fx_daily_a(),
        "daily_secondary": t.fx_daily_b(),
    }
    for name, df in tables.items():
        if day is not None and name == "daily_primary":
            df = df.filter(C("datetime") <= day)
        if day is not None and name == "daily_secondary":
            df = df.filter(C("date") <= day)
        df.write.mode("overwrite").parquet(f"{root}/bronze/{name}")
    if with_docs:
        # a file per report; a name without digits, which would be read as a date
        number = F.translate(F.monotonically_increasing_id().cast("string"), "0123456789", "abcdefghij")
        write_documents(t.fx_reports().select(F.concat(F.lit("report-"), number).alias("name"), "text"), f"{root}/bronze/docs")
    return Paths(f"{root}/bronze", f"{root}/silver")


def stored(t, paths):
    table = read_version(t.spark, paths.clean("daily"), DAILY)
    return rounded(table.select(*DAILY.fieldNames()), 4, "amount", "change_pct")


@query("build_full", f"SELECT {_DAILY_OUT} FROM fx_daily")
def _(t):
    paths = land(t)
    build_full(t.spark, "daily", paths)
    return stored(t, paths)


@query("build_incremental", f"SELECT {_DAILY_OUT} FROM fx_daily")
def _(t):
    paths = land(t, day="2024-01-29")
    build_full(t.spark, "daily", paths)
    t.fx_daily_a().filter("datetime > '2024-01-29'").write.mode("append").parquet(paths.raw("daily_primary"))
    t.fx_daily_b().filter("date > '2024-01-29'").write.mode("append").parquet(paths.raw("daily_secondary"))
    build_incremental(t.spark, "daily", paths, "2024-01-30")
    return stored(t, paths)


@query("build_repair", "SELECT stock_code, trade_date, close FROM (SELECT stock_code, trade_date, CASE WHEN stock_code IN ('600002', '680003') THEN close * 2 ELSE close END AS close FROM fx_daily)")
def _(t):
    paths = land(t)
    build_full(t.spark, "daily", paths)
    prices = ["open", "high", "low", "close"]
    doubled = lambda df: df.withColumns({c: C(c) * 2 for c in prices})
    doubled(t.fx_daily_a()).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths.raw("daily_primary"))
    doubled(t.fx_daily_b()).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths.raw("daily_secondary"))
    build_repair(t.spark, "daily", paths, ["600002", "680003"])
    return stored(t, paths).select("stock_code", "trade_date", "close")


@query("build_all", "SELECT 'stock_map' AS target, 'partial' AS status, count(*) AS rows_written FROM fx_stock_map UNION ALL SELECT 'daily', 'ok', count(*) FROM fx_daily UNION ALL SELECT 'adj_factor', 'ok', count(*) FROM fx_factors UNION ALL SELECT 'minute', 'ok', count(*) FROM fx_minute UNION ALL SELECT 'finance', 'ok', count(*) FROM fx_finance_rows UNION ALL SELECT 'doc', 'ok', count(*) FROM part")
def _(t):
    out = build_all(t.spark, "full", land(t, with_docs=True))
    return out.select("target", "status", "rows_written")


def _bad(df, date):
    """A few bars whose date can't be read."""
    return df.filter(C(date).startswith("2024-01-02")).withColumn(date, F.lit("some day"))


@query("build_late_day", f"SELECT {_DAILY_OUT} FROM fx_daily")
def _(t):
    # one day and some undated bars land last; the bars after that day are corrected
    paths, day = land(t), "2024-01-15"
    names = {"daily_primary": (t.fx_daily_a(), "datetime"), "daily_secondary": (t.fx_daily_b(), "date")}
    for name, (df, date) in names.items():
        df.filter(~C(date).startswith(day)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths.raw(name))
    build_full(t.spark, "daily", paths)
    for name, (df, date) in names.items():
        df.filter(C(date).startswith(day)).unionByName(_bad(df, date)).write.mode("append").parquet(paths.raw(name))
    for _ in range(2):  # the second time nothing is new
        build_incremental(t.spark, "daily", paths, day)
    return stored(t, paths)


@query("build_repair_failed", "SELECT stock_code, trade_date, close FROM (SELECT stock_code, trade_date, CASE WHEN stock_code IN (SELECT code FROM fx_failed) THEN close * 2 ELSE close END AS close FROM fx_daily)")
def _(t):
    # the codes come straight from the ingest log
    paths = land(t)
    build_full(t.spark, "daily", paths)
    doubled = lambda df: df.withColumns({c: C(c) * 2 for c in ("open", "high", "low", "close")})
    doubled(t.fx_daily_a()).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths.raw("daily_primary"))
    doubled(t.fx_daily_b()).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths.raw("daily_secondary"))
    build_repair(t.spark, "daily", paths, failed_codes(t.fx_results()).select("code"))
    return stored(t, paths).select("stock_code", "trade_date", "close")


@query("landed_dedup", "SELECT code, updated_date, ingested_at FROM fx_finance WHERE ingested_at = TIMESTAMP '2024-02-02' UNION ALL SELECT 'rows', before, NULL FROM (SELECT count(*) AS before FROM fx_finance)")
def _(t):
    paths = land(t)
    counts = dedup_landed(t.spark, paths.bronze, {"finance": ["code"]})
    kept = t.spark.read.parquet(paths.raw("finance")).select("code", "updated_date", "ingested_at")
    total = counts.select(F.lit("rows").alias("code"), C("before").alias("updated_date"), F.lit(None).cast("timestamp_ntz").alias("ingested_at"))
    return kept.unionByName(total)


_REPEATED = " UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) + count(*) FILTER (WHERE {again}) AS before, count(*) AS after, 'done' AS status, round(sum({value}) + count(*) FILTER (WHERE {again}), 2) AS total FROM {table}" for name, table, again, value in (
    ("daily_primary", "fx_daily_a", "CAST(stock_code AS INTEGER) % 2 = 0", "close"), ("daily_secondary", "fx_daily_b", "CAST(stock_code AS INTEGER) % 2 = 0", "close"), ("minute", "fx_minute", "CAST(stock_code AS INTEGER) % 2 = 0", "close"),
    ("finance", "fx_finance_rows", "CAST(stock_code AS INTEGER) % 2 = 0", FINANCE_MEASURES[0])))


@query("landed_dedup_all", _REPEATED + " UNION ALL SELECT 'xdxr', count(*), count(DISTINCT (code, d, category)), 'done', round(sum(peigujia) FILTER (WHERE first), 2) FROM (SELECT *, row_number() OVER (PARTITION BY code, d, category ORDER BY arrival DESC) = 1 AS first FROM fx_xdxr) UNION ALL SELECT 'stocks', count(*), count(*), 'skipped', NULL FROM fx_stocks")
def _(t):
    # half of the codes land again with other values; stocks have no stamps
    bronze, one, two = work_dir(t.spark, "bronze"), F.lit("2024-02-01").cast("timestamp_ntz"), F.lit("2024-02-02").cast("timestamp_ntz")
    finance = t.fx_finance().filter("ingested_at = timestamp_ntz'2024-02-02'").drop("ingested_at")
    tables = {"daily_primary": (t.fx_daily_a(), "stock_code", "close"), "daily_secondary": (t.fx_daily_b(), "stock_code", "close"),
              "minute": (t.fx_minute_raw(), "stock_code", "close"), "finance": (finance, "code", FINANCE_MEASURES[0])}
    for name, (df, code, value) in tables.items():
        again = df.filter(F.right(code, F.lit(6)).cast("int") % 2 == 0).withColumn(value, C(value) + 1)
        df.withColumn("ingested_at", one).unionByName(again.withColumn("ingested_at", two)).write.parquet(f"{bronze}/{name}")
    t.fx_xdxr().write.parquet(f"{bronze}/xdxr")
    t.fx_stocks().write.parquet(f"{bronze}/stocks")
    counts = dedup_landed(t.spark, bronze, LANDED_KEYS | {"stocks": ["code"]})
    totals = None
    for name, value in [(n, v) for n, (_, _, v) in tables.items()] + [("xdxr", "peigujia")]:
        one_row = t.spark.read.parquet(f"{bronze}/{name}").agg(F.round(F.sum(value), 2).alias("total")).select(F.lit(name).alias("table"), "total")
        totals = one_row if totals is None else totals.unionByName(one_row)
    return counts.join(totals, "table", "left").select("table", "before", "after", "status", "total")


@query("run_log", """SELECT plan_id, step_name, CAST(row_number() OVER (PARTITION BY plan_id ORDER BY step_name) - 1 AS INTEGER) AS seq, rows, failed, status, n FROM (
 SELECT plan_id, step_name, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(failed) AS BIGINT) AS failed, CASE WHEN sum(failed) = 0 THEN 'ok' ELSE 'partial' END AS status, CAST(count(*) FILTER (WHERE status <> 'ok') * 3 AS BIGINT) AS n FROM fx_results GROUP BY 1, 2)""")
def _(t):
    root = work_dir(t.spark, "log")
    steps = run_step_rollup(t.fx_results())
    save_steps(t.spark, f"{root}/step", steps.withColumn("status", F.lit("running")))
    save_steps(t.spark, f"{root}/step", steps)
    return read_version(t.spark, f"{root}/step", STEP_LOG).select("plan_id", "step_name", "seq", "rows", "failed", "status", C("n_errors").alias("n"))


# ---- all years, and the tables kept beside the targets --------------------------------


def _later(df, column, code="stock_code", days=366):
    """A third of the codes trade for another year."""
    kind = df.schema[column].dataType.simpleString()
    shifted = (C(column).cast("timestamp_ntz") + F.expr(f"interval {days} days"))
    text = F.date_format(shifted, "yyyy-MM-dd HH:mm:ss") if kind == "string" else shifted.cast(kind)
    return df.unionByName(df.filter(F.right(code, F.lit(6)).cast("int") % 3 == 0).withColumn(column, text))


_MINUTE_OUT = "stock_code, datetime, open, high, low, close, vol, round(amount, 4) AS amount"
_MINUTE_YEARS = f"SELECT {_MINUTE_OUT} FROM (SELECT * FROM fx_minute UNION ALL SELECT * REPLACE (datetime + INTERVAL 366 DAY AS datetime) FROM fx_minute WHERE CAST(stock_code AS INTEGER) % 3 = 0)"


def _stored_minute(t, paths):
    return rounded(read_version(t.spark, paths.clean("minute"), MINUTE).select(*MINUTE.fieldNames()), 4, "amount")


def _land_minute(t, paths, rows, at, mode="append"):
    stamped = rows.withColumn("ingested_at", F.lit(at).cast("timestamp_ntz"))
    stamped.write.mode(mode).option("partitionOverwriteMode", "static").parquet(paths.raw("minute"))


@query("build_incremental_minute", _MINUTE_YEARS)
def _(t):
    # three landings; the second holds the last days of the first year, the third another year and repeats
    paths, rows = Paths(*(work_dir(t.spark, n) for n in ("bronze", "silver"))), _later(t.fx_minute_raw(), "datetime")
    early, late = C("datetime") < "2024-01-20", C("datetime") >= "2025"
    _land_minute(t, paths, rows.filter(early), "2024-02-01")
    build_full(t.spark, "minute", paths)
    _land_minute(t, paths, rows.filter(~early & ~late), "2024-02-02")
    build_incremental(t.spark, "minute", paths, "2024-02-02")
    _land_minute(t, paths, rows.filter(late | (C("datetime") >= "2024-01-25")), "2025-02-02")
    for _ in range(2):  # the second time nothing is new
        build_incremental(t.spark, "minute", paths, "2025-02-02")
    return _stored_minute(t, paths)


@query("build_repair_minute", _MINUTE_YEARS.replace("open, high, low, close, vol", ", ".join(f"CASE WHEN stock_code IN (SELECT code FROM fx_failed) THEN {c} * 2 ELSE {c} END AS {c}" for c in ("open", "high", "low", "close")) + ", vol"))
def _(t):
    paths, rows = Paths(*(work_dir(t.spark, n) for n in ("bronze", "silver"))), _later(t.fx_minute_raw(), "datetime")
    _land_minute(t, paths, rows, "2024-02-01")
    build_full(t.spark, "minute", paths)
    doubled = rows.withColumns({c: C(c) * 2 for c in ("open", "high", "low", "close")})
    _land_minute(t, paths, doubled, "2024-02-02", "overwrite")
    build_repair(t.spark, "minute", paths, failed_codes(t.fx_results()).select("code"))
    return _stored_minute(t, paths)


@query("build_late_days", f"SELECT {_DAILY_OUT.replace('round(change_pct, 4)', 'round(CASE WHEN pre_close > 0 THEN (close - pre_close) / pre_close * 100 END, 4)').replace('volume,', 'CAST(CASE WHEN volume < 1 THEN 0 ELSE volume END AS BIGINT) AS volume,')} FROM (SELECT *, lag(close) OVER (PARTITION BY stock_code ORDER BY trade_date) AS pre_close FROM (SELECT * FROM fx_merged UNION ALL SELECT * REPLACE (CAST(trade_date + INTERVAL 366 DAY AS DATE) AS trade_date) FROM fx_merged WHERE CAST(stock_code AS INTEGER) % 3 = 0) WHERE close > 0 AND high >= low)")
def _(t):
    # two years; the last day of the first and a day of the second land late
    paths = Paths(*(work_dir(t.spark, n) for n in ("bronze", "silver")))
    feeds = {"daily_primary": (_later(t.fx_daily_a(), "datetime"), "datetime"), "daily_secondary": (_later(t.fx_daily_b(), "date"), "date")}
    days = ["2024-01-30", "2025-01-15"]
    for name, (df, date) in feeds.items():
        df.filter(~C(date).substr(1, 10).isin(days)).write.parquet(paths.raw(name))
    build_full(t.spark, "daily", paths)
    for day in days:
        for name, (df, date) in feeds.items():
            df.filter(C(date).startswith(day)).write.mode("append").parquet(paths.raw(name))
        build_incremental(t.spark, "daily", paths, day)
    return stored(t, paths)


def _factors_in_two_steps(t):
    """Daily bars and events landed, the later half of the events built incrementally."""
    paths = Paths(*(work_dir(t.spark, n) for n in ("bronze", "silver")))
    t.fx_daily_a().write.parquet(paths.raw("daily_primary"))
    t.fx_daily_b().write.parquet(paths.raw("daily_secondary"))
    build_full(t.spark, "daily", paths)
    early = C("day") < 15
    t.fx_xdxr().filter(early).write.parquet(paths.raw("xdxr"))
    build_full(t.spark, "adj_factor", paths)
    t.fx_xdxr().filter(~early).write.mode("append").parquet(paths.raw("xdxr"))
    build_incremental(t.spark, "adj_factor", paths, "2024-01-30")
    return paths


@query("build_incremental_factors", "SELECT stock_code, trade_date, round(fenhong, 6) AS fenhong, round(songzhuangu, 6) AS songzhuangu, round(peigu, 6) AS peigu, peigu_price, round(single_factor, 6) AS single_factor FROM fx_factors")
def _(t):
    paths = _factors_in_two_steps(t)
    out = read_version(t.spark, paths.clean("adj_factor"), ADJ_FACTOR)
    return rounded(out, 6, "fenhong", "songzhuangu", "peigu", "single_factor")


@query("q_daily_qfq_stored", _ADJ_OUT.format(rows=_ADJ_ALL.format(op="* p", cmp=">"), codes="SELECT stock_code FROM fx_events"))
def _(t):
    # from the stored bars of the range, the bar before it and the kept step table
    paths = _factors_in_two_steps(t)
    daily = read_version(t.spark, paths.clean("daily"), DAILY)
    codes = read_version(t.spark, paths.clean("adj_factor"), ADJ_FACTOR).select("stock_code").distinct()
    out = serve.daily_batch(daily, codes, "2024-01-05", "2024-01-20", "qfq", steps=stored_steps(t.spark, paths))
    return rounded(rounded(out.select(*DAILY.fieldNames()), 4, *PRICES, "pre_close", "amount"), 6, "change_pct")


@query("build_incremental_doc", """SELECT printf('%06d', doc_id) AS stock_code, substr(sha256(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10))), 1, 16) AS source_hash, doc_id % 5 = 0 AS rewritten FROM (
 SELECT doc_id, '=== a ===' || chr(10) || text || chr(10) || '=== b ===' || chr(10) || 'tail' || CASE WHEN doc_id % 5 = 0 THEN ' changed' ELSE '' END AS t FROM documents)""")
def _(t):
    # one of two sections changes in every fifth report; its page is new, with the other section as it was
    paths = Paths(*(work_dir(t.spark, n) for n in ("bronze", "silver")))
    change = F.when(C("doc_id") % 5 == 0, " changed").otherwise("")
    text = lambda tail: F.concat(F.lit("=== a ===\n"), "text", F.lit("\n=== b ===\ntail"), tail)
    rows = t.table("documents").select(
        F.format_string("%06d", "doc_id").alias("stock_code"), F.lit("2024-01-05").cast("date").alias("trade_date"), "doc_id", "text"
    )
    plain = lambda df, tail: df.select("stock_code", "trade_date", F.regexp_replace(text(tail), "\r\n?", "\n").alias("text"))
    land_documents(plain(rows, F.lit("")), paths.raw("docs_landed"), "b1")
    build_full(t.spark, "doc", paths)
    before = read_version(t.spark, paths.clean("doc"), DOC).select("stock_code", C("file_hash").alias("__was"))
    before = spark_table(t, before)
    land_documents(plain(rows, change), paths.raw("docs_landed"), "b2")
    build_incremental(t.spark, "doc", paths, "2024-01-06")
    now = read_version(t.spark, paths.clean("doc"), DOC)
    return now.join(before, "stock_code").select("stock_code", "source_hash", (C("file_hash") != C("__was")).alias("rewritten"))


def spark_table(t, df):
    """Rows as they are now: the versions they come from may be dropped."""
    path = work_dir(t.spark, "rows")
    df.write.parquet(path)
    return t.spark.read.parquet(path)
