"""Sources and sinks: each query writes or reads real files in a work folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.plans.landed import append_intraday
from barlake.session import work_dir
from barlake.sources import files, parsers, sinks

from .fixtures import PLACES, _code, _market, fx_code, fx_market
from .registry import query

C = F.col
_SHOWN = ["code", "name", "current_price", "update_time", "change_pct", "currency", "tail"]


@query("src_kline_json", """SELECT market || stock_code AS stock_code, CAST(trade_date AS VARCHAR) AS date,
 round(open, 2) AS open, round(close, 2) AS close, round(high, 2) AS high, round(low, 2) AS low, round(lots, 2) AS volume,
 CAST(CASE WHEN day(trade_date) % 7 = 0 THEN NULL WHEN day(trade_date) % 5 = 0 THEN 12.5 WHEN day(trade_date) % 3 = 0 THEN 7.5 END AS DOUBLE) AS amount,
 CASE WHEN day(trade_date) % 7 = 0 THEN '{"fh":1}' WHEN day(trade_date) % 5 = 0 THEN '{"fh":2}' END AS extra FROM fx_daily_b""")
def _(t):
    out = parsers.parse_kline_json(t.fx_kline_json(), "stock_code", fq="qfq")
    return out.withColumn("extra", F.replace("extra", F.lit(" "), F.lit("")))


@query("src_quote_lines", f"SELECT poll_id, {', '.join(_SHOWN)}, md5(concat_ws('~', {', '.join(PLACES)})) AS fields FROM fx_quotes")
def _(t):
    # all fields, in order, as a digest beside those shown
    fields = F.md5(F.concat_ws("~", *PLACES)).alias("fields")
    return parsers.parse_quote_lines(t.fx_quote_lines()).select("poll_id", *_SHOWN, fields)


@query("src_positional_lines", "SELECT poll_id, " + ", ".join(f"string_split(value, '~')[{i + 1}] AS c{i}" for i in range(12)) + " FROM fx_quote_lines")
def _(t):
    return parsers.parse_positional(t.fx_quote_lines(), 12)


@query("src_minute_cumulative", "SELECT stock_code, event_id, string_split(item, ' ')[1] AS time, CAST(string_split(item, ' ')[2] AS DOUBLE) AS price, CAST(string_split(item, ' ')[3] AS DOUBLE) AS volume, CAST(string_split(item, ' ')[4] AS DOUBLE) AS amount FROM fx_intraday WHERE len(string_split(item, ' ')) >= 4")
def _(t):
    return parsers.parse_intraday(t.fx_intraday())


@query("src_gbk_text", "SELECT '行情~' || c_name || '~' || v AS value FROM customer, (SELECT unnest(['a', '其他']) AS v)")
def _(t):
    # the CSV writer knows the encoding: one column, no quotes, hence plain lines
    path = work_dir(t.spark, "gbk") + "/quotes"
    lines = t.table("customer").select("c_name", F.explode(F.array(F.lit("a"), F.lit("其他"))).alias("v"))
    lines = lines.select(F.concat(F.lit("行情~"), "c_name", F.lit("~"), "v").alias("value"))
    lines.write.mode("overwrite").option("encoding", "GBK").option("quote", "").option("lineSep", "\r\n").csv(path)
    return files.read_gbk(t.spark, path).select("value")


@query("src_documents", "SELECT CAST(doc_id AS VARCHAR) AS stock_code, substr(sha256(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10)), 1, 16) AS h, CASE WHEN doc_id % 5 = 0 THEN DATE '2024-01-31' ELSE DATE '2024-02-01' + CAST(doc_id % 28 AS INTEGER) END AS trade_date FROM documents")
def _(t):
    path, d = work_dir(t.spark, "docs"), C("doc_id")
    # a name per document; every fifth has no date
    day = F.date_format(F.date_add(F.lit("2024-02-01").cast("date"), (d % 28).cast("int")), "yyyyMMdd")
    name = F.concat(d.cast("string"), F.when(d % 5 == 0, "").otherwise(F.concat(F.lit("_"), day)))
    files.write_documents(t.table("documents").select(name.alias("name"), "text"), path)
    docs = files.read_documents(t.spark, path, "2024-01-31")
    return docs.select("stock_code", F.substring(F.sha2("text", 256), 1, 16).alias("h"), "trade_date")


@query("src_documents_landed", "SELECT CAST(doc_id AS VARCHAR) AS stock_code, doc_id % 3 = 0 AS changed, md5(text || CASE WHEN doc_id % 3 = 0 THEN ' again' ELSE '' END) AS h FROM documents")
def _(t):
    # every document lands; then a third of them changes, another third lands again as it was
    path, d = work_dir(t.spark, "landed") + "/docs", C("doc_id")
    docs = t.table("documents").select(d.cast("string").alias("stock_code"), F.lit("2024-01-31").cast("date").alias("trade_date"), "text", "doc_id")
    files.land_documents(docs.drop("doc_id"), path, "b1")
    known = files.landed_documents(t.spark, path).select("stock_code", F.substring(F.sha2("text", 256), 1, 16).alias("source_hash"))
    known.write.parquet(path + "-known")  # as of now
    known = t.spark.read.parquet(path + "-known")
    again = docs.filter(d % 3 < 2).withColumn("text", F.when(d % 3 == 0, F.concat("text", F.lit(" again"))).otherwise(C("text")))
    files.land_documents(again.withColumn("trade_date", F.lit("2024-02-01").cast("date")).drop("doc_id"), path, "b2")
    changed = files.landed_documents(t.spark, path, known).select("stock_code", F.lit(True).alias("changed"))
    newest = files.landed_documents(t.spark, path).select("stock_code", F.md5("text").alias("h"))
    return newest.join(changed, "stock_code", "left").select("stock_code", F.coalesce("changed", F.lit(False)).alias("changed"), "h")


@query("src_documents_compacted", "SELECT CAST(doc_id AS VARCHAR) AS stock_code, md5(text || CASE WHEN doc_id % 3 = 0 THEN ' again' WHEN doc_id % 3 = 1 THEN ' last' ELSE '' END) AS h, true AS few FROM documents")
def _(t):
    # twenty landings, compacted, some more, compacted again, and one that stays beside the container
    path, d = work_dir(t.spark, "compact") + "/docs", C("doc_id")
    docs = t.table("documents").select(d.cast("string").alias("stock_code"), F.lit("2024-01-31").cast("date").alias("trade_date"), "text", "doc_id")
    batches = F.format_string("b%02d", d % 20)
    landed = docs.select("stock_code", "trade_date", F.substring(F.sha2("text", 256), 1, 16).alias("source_hash"), "text", batches.alias("batch"))
    landed.write.partitionBy("batch").parquet(path)
    files.compact_documents(t.spark, path)
    change = lambda k, tail: docs.filter(d % 3 == k).withColumn("text", F.concat("text", F.lit(tail))).drop("doc_id")
    files.land_documents(change(0, " again"), path, "b20")
    files.land_documents(change(1, " first"), path, "b21")
    files.compact_documents(t.spark, path)
    files.land_documents(change(1, " last"), path, "b22")
    few = t.spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count() <= 40
    return files.landed_documents(t.spark, path).select("stock_code", F.md5("text").alias("h"), F.lit(few).alias("few"))


@query("sink_intraday", "SELECT DISTINCT " + _market("user_id") + " || " + _code("user_id") + " AS stock_code, CAST(ts AS DATE) AS trade_date, strftime(ts, '%H%M') AS time, true AS stored FROM events")
def _(t):
    path, u = work_dir(t.spark, "intraday") + "/points", C("user_id")
    points = t.table("events").select(
        F.concat(fx_market(u), fx_code(u)).alias("stock_code"), F.date_format("ts", "HHmm").alias("time"), F.to_date("ts").alias("day"), C("value").alias("price"))
    days = sorted(str(r[0]) for r in points.select("day").distinct().collect())  # one run per trading day
    for day in [*days, days[0]]:  # one day is fetched twice
        append_intraday(points.filter(C("day") == day).drop("day"), path, day)
    return t.spark.read.parquet(path).select("stock_code", C("trade_date").cast("date"), "time", F.lit(True).alias("stored"))


@query("src_industry_csv", "SELECT code, name, industry FROM fx_industry WHERE industry IS NOT NULL")
def _(t):
    path = work_dir(t.spark, "industry")
    t.fx_industry().write.mode("overwrite").csv(path, header=True)
    return files.read_industry(t.spark, path)


@query("sink_append_lineage", "SELECT event_id, TIMESTAMP '2024-02-01' AS ingested_at, 'primary' AS source_system, 'ticks' AS source_api, b AS batch_id FROM events, (SELECT unnest(['b1', 'b2']) AS b)")
def _(t):
    path = work_dir(t.spark, "append") + "/ticks"
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    for b in ("b1", "b2"):
        sinks.append_bronze(t.table("events").select("event_id"), path, "primary", "ticks", b, stamp)
    return t.spark.read.parquet(path)


@query("sink_insert_new", "SELECT event_id, value FROM events UNION ALL SELECT event_id + 1000000, value FROM events WHERE event_type = 'view'")
def _(t):
    path = work_dir(t.spark, "insert") + "/ticks"
    e = t.table("events").select("event_id", "value", "event_type")
    first = e.filter("event_type <> 'error'").select("event_id", "value")
    again = e.select("event_id", "value").unionByName(
        e.filter("event_type = 'view'").select((C("event_id") + 1000000).alias("event_id"), "value")
    )
    sinks.insert_new(first, path, ["event_id"])
    sinks.insert_new(again.unionByName(again), path, ["event_id"])
    return t.spark.read.parquet(path)


@query("sink_snapshot", "SELECT code, name FROM fx_stocks")
def _(t):
    root = work_dir(t.spark, "snapshot") + "/stocks"
    stocks = t.fx_stocks().select("code", "name")
    sinks.overwrite_snapshot(stocks.withColumn("name", F.lit("old")), root)
    sinks.overwrite_snapshot(stocks, root)
    return sinks.read_version(t.spark, root, stocks.schema)


@query("sink_year_partition", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def _(t):
    path = work_dir(t.spark, "years") + "/orders"
    sinks.write_by_year(t.table("orders").select("o_orderkey", "o_orderdate"), path, "o_orderdate")
    stored = t.spark.read.parquet(path)
    present = sinks.years_present(stored)
    return stored.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).join(present, "year")


@query("sink_freq_partition", "SELECT f AS freq, 'bfq' AS adj, count(*) AS n FROM (SELECT 'daily' AS f FROM fx_daily_a UNION ALL SELECT '1h' FROM fx_minute) GROUP BY 1")
def _(t):
    path = work_dir(t.spark, "freq") + "/bars"
    sinks.write_by_freq(t.fx_daily_a().select("stock_code", "datetime", "close"), path, "daily", "bfq")
    sinks.write_by_freq(t.fx_minute_raw().select("stock_code", "datetime", "close"), path, "1h", "bfq")
    return t.spark.read.parquet(path).groupBy("freq", "adj").agg(F.count(F.lit(1)).alias("n"))


@query("src_brief_lines", f"SELECT poll_id, count(*) AS n, max(string_split(value, '~')[{PLACES['tail']}]) AS tail FROM fx_quote_lines GROUP BY 1")
def _(t):
    blank = t.fx_quote_lines().withColumn("value", F.lit("  "))
    lines = t.fx_quote_lines().unionByName(blank)
    out = parsers.parse_positional(lines, len(PLACES))
    return out.groupBy("poll_id").agg(F.count(F.lit(1)).alias("n"), F.max(f"c{PLACES['tail'] - 1}").alias("tail"))


def intraday_payloads(t):
    """Responses of at most fifty items each, as the intraday API returns them."""
    e = t.table("events")
    u = C("user_id")
    item = F.concat(F.lit('"'), F.date_format("ts", "HHmm"), F.lit(" 1.5 "), C("event_id").cast("string"), F.lit(' 2"'))
    code = F.concat(fx_market(u), fx_code(u))
    return e.groupBy(code.alias("code"), F.floor(C("event_id") / 50).alias("part")).agg(F.array_sort(F.collect_list(item)).alias("items")).select(
        "code", F.concat(F.lit('{"code": 0, "data": {"'), "code", F.lit('": {"data": ['), F.array_join("items", ","), F.lit("]}}}")).alias("payload")
    )


@query("src_intraday_json", f"SELECT strftime(ts, '%H%M') AS time, CAST(1.5 AS DOUBLE) AS price, CAST(event_id AS DOUBLE) AS volume, CAST(2.0 AS DOUBLE) AS amount FROM events")
def _(t):
    return parsers.parse_intraday_json(intraday_payloads(t)).drop("stock_code")
