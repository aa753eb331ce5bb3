"""Joins, aggregations, windows, set operations, table modes, quality, read queries, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake.functions import code_to_prefixed, industry_label, is_a_share, pct_or_zero
from barlake.operators import aggregates, complete, joins, quality, runs, serve, setops, upsert, windows
from barlake.plans import silver
from barlake.schemas import FINANCE_MEASURES, PRICES
from barlake.sources.parsers import parse_quote_lines

from .fixtures import fx_code
from .registry import joined, query, rounded

C = F.col
DAY = ["stock_code", "trade_date"]
REF = ("000000", "300001")


def plain_b(t):
    return silver.secondary_bars(t.fx_daily_b())


# ---- joins ------------------------------------------------------------------------


@query("merge_source_priority", "SELECT stock_code, trade_date, open, high, low, close, round(volume, 4) AS volume, round(amount, 4) AS amount FROM fx_merged")
def _(t):
    out = joins.merge_source_priority(silver.primary_bars(t.fx_daily_a()), plain_b(t), DAY)
    return rounded(out, 4, "volume", "amount")


@query("merge_by_priority", "SELECT stock_code, trade_date, open, high, low, close, round(volume, 4) AS volume, round(amount, 4) AS amount FROM fx_merged")
def _(t):
    out = joins.merge_by_priority([silver.primary_bars(t.fx_daily_a()), plain_b(t)], DAY, ["open"])
    return rounded(out, 4, "volume", "amount")


@query("enrich_dimension", "SELECT code, name, market, ipo_date FROM fx_stocks LEFT JOIN (SELECT code, ipo_date FROM fx_finance WHERE ingested_at = TIMESTAMP '2024-02-02') USING (code)")
def _(t):
    return joins.enrich_dimension(t.fx_stocks(), t.fx_finance(), "code", ["ipo_date"], ["updated_date", "ingested_at"]).select("code", "name", "market", "ipo_date")


@query("event_price_join", "SELECT stock_code, trade_date, round(fenhong, 6) AS fenhong, pre_close FROM fx_events LEFT JOIN fx_daily USING (stock_code, trade_date)")
def _(t):
    out = joins.event_price_join(silver.corporate_actions(t.fx_xdxr()), t.fx_daily(), DAY, "pre_close")
    return rounded(out, 6, "fenhong").select(*DAY, "fenhong", "pre_close")


def calendar(t):
    return joins.reference_calendar(t.fx_daily(), "stock_code", C("trade_date"), REF)


@query("expected_calendar", "SELECT stock_code, trade_date FROM fx_stock_map JOIN fx_cal ON trade_date >= ipo_date")
def _(t):
    return joins.expected_calendar(t.fx_stock_map(), calendar(t), "stock_code", "ipo_date")


@query("find_missing", "SELECT stock_code, trade_date FROM fx_stock_map JOIN fx_cal ON trade_date >= ipo_date EXCEPT SELECT stock_code, trade_date FROM fx_daily")
def _(t):
    expected = joins.expected_calendar(t.fx_stock_map(), calendar(t), "stock_code", "ipo_date")
    return joins.find_missing(expected, t.fx_daily(), DAY)


@query("semi_present", "SELECT stock_code FROM fx_stock_map WHERE ipo_date IS NULL AND stock_code IN (SELECT stock_code FROM fx_daily)")
def _(t):
    return complete.present_without_start(t.fx_stock_map(), t.fx_daily()).select("stock_code")


@query("new_keys_only", "SELECT stock_code, trade_date FROM fx_events WHERE (stock_code, trade_date) NOT IN (SELECT stock_code, trade_date FROM fx_daily)")
def _(t):
    return joins.new_keys_only(silver.corporate_actions(t.fx_xdxr()), t.fx_daily(), DAY).select(*DAY)


@query("newer_than_watermark", "SELECT stock_code, datetime FROM fx_minute m LEFT JOIN (SELECT stock_code, max(trade_date) AS mark FROM fx_factors WHERE single_factor IS NOT NULL AND trade_date < DATE '2024-01-20' GROUP BY 1) USING (stock_code) WHERE mark IS NULL OR datetime > mark")
def _(t):
    marks = t.fx_factors().filter("single_factor is not null and trade_date < date '2024-01-20'").select(
        "stock_code", C("trade_date").cast("timestamp_ntz").alias("datetime")
    )
    return joins.newer_than_watermark(t.fx_minute(), marks, "stock_code", "datetime").select("stock_code", "datetime")


def quotes(t):
    q = parse_quote_lines(t.fx_quote_lines()).select(F.regexp_replace("code", "^s[hz](?=.)", "").alias("code"), "name", "tail", pct_or_zero(C("change_pct")).alias("pct"))
    industry = t.fx_industry().filter("industry is not null").withColumn("industry", industry_label(C("industry")))
    return joins.industry_join(q, industry, "其他")


_IND = "(SELECT code, name AS iname, CASE WHEN industry LIKE 'C27%' THEN substr(industry, 4) ELSE industry END AS ind FROM fx_industry WHERE industry IS NOT NULL)"
_QIND = f"(SELECT code, tail, CASE WHEN ind IS NULL THEN name ELSE iname END AS name, CAST(change_pct AS DOUBLE) AS pct, coalesce(ind, '其他') AS industry FROM fx_live LEFT JOIN {_IND} USING (code))"


@query("industry_join", f"SELECT * FROM {_QIND}")
def _(t):
    return quotes(t)


_ASOF = """SELECT b.stock_code, b.trade_date,
 round(coalesce(product(coalesce(f.single_factor, 1)) FILTER (WHERE f.trade_date > b.trade_date), 1), 6) AS factor_after,
 round(coalesce(product(coalesce(f.single_factor, 1)) FILTER (WHERE f.trade_date <= b.trade_date), 1), 6) AS factor_upto
 FROM fx_daily b LEFT JOIN fx_factors f ON f.stock_code = b.stock_code GROUP BY 1, 2"""


@query("factor_asof", _ASOF)
def _(t):
    out = joins.factor_asof(t.fx_daily(), t.fx_factors(), "stock_code", "trade_date")
    return rounded(out, 6, "factor_after", "factor_upto").select(*DAY, "factor_after", "factor_upto")


# ---- aggregations -----------------------------------------------------------------


@query("merge_same_day_events", "SELECT stock_code, trade_date, round(fenhong, 6) AS fenhong, peigu_price, round(songzhuangu, 6) AS songzhuangu, round(peigu, 6) AS peigu FROM fx_events")
def _(t):
    return rounded(silver.corporate_actions(t.fx_xdxr()), 6, "fenhong", "songzhuangu", "peigu")


@query("dedup_latest_ties", "SELECT event_id, value, ingested_at FROM (SELECT *, rank() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS r FROM fx_bronze_dup) WHERE r = 1")
def _(t):
    return aggregates.dedup_latest_ties(t.fx_bronze_dup(), ["event_id"], "ingested_at").select("event_id", "value", "ingested_at")


@query("dedup_keep_last", "SELECT event_id, user_id, value, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS r FROM fx_bronze_dup) WHERE r = 1")
def _(t):
    return aggregates.dedup_keep_last(t.fx_bronze_dup(), ["event_id"], ["ingested_at"]).select("event_id", "user_id", "value", "ingested_at")


@query("distinct_keys", "SELECT DISTINCT stock_code FROM fx_daily_a")
def _(t):
    return aggregates.distinct_keys(t.fx_daily_a(), column="stock_code")


@query("max_per_key", "SELECT stock_code, max(datetime) AS max_ts FROM fx_minute GROUP BY 1")
def _(t):
    return aggregates.max_per_key(t.fx_minute(), "stock_code", "datetime")


@query("bars_per_day", "SELECT stock_code, CAST(datetime AS DATE) AS trade_date, count(*) AS bars FROM fx_minute GROUP BY 1, 2")
def _(t):
    return aggregates.bars_per_day(t.fx_minute(), "stock_code", "datetime")


@query("short_days", "SELECT stock_code, CAST(datetime AS DATE) AS trade_date, count(*) AS bars FROM fx_minute GROUP BY 1, 2 HAVING count(*) < 3")
def _(t):
    return aggregates.short_days(aggregates.bars_per_day(t.fx_minute(), "stock_code", "datetime"), 3)


@query("duplicate_groups", "SELECT event_id, count(*) AS cnt FROM fx_bronze_dup GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return aggregates.duplicate_groups(t.fx_bronze_dup(), ["event_id"])


@query("null_profile", "SELECT 'pre_close' AS \"column\", count(*) FILTER (WHERE pre_close IS NULL) AS nulls, count(*) AS total FROM fx_daily UNION ALL SELECT 'amount', count(*) FILTER (WHERE amount IS NULL), count(*) FROM fx_daily")
def _(t):
    return aggregates.null_profile(t.fx_daily(), ["pre_close", "amount"])


@query("coverage_ratio", "SELECT count(ipo_date) AS present, count(*) AS total, round(count(ipo_date) * 100.0 / count(*), 1) AS pct FROM fx_stock_map")
def _(t):
    return aggregates.coverage_ratio(t.fx_stock_map(), "ipo_date")


@query("freshness", "SELECT CAST(max(ts) AS DATE) AS last_date, CAST(max(ts) AS DATE) = DATE '2024-01-30' AS fresh FROM events")
def _(t):
    return aggregates.freshness(t.table("events"), "ts", F.lit("2024-01-30").cast("date"))


@query("industry_groups", f"SELECT industry, CAST(tail AS BIGINT) // 500 AS part, string_agg(code || ':' || name || ':' || CAST(CAST(pct AS INTEGER) AS VARCHAR), ',' ORDER BY abs(pct) DESC, code, name, pct) AS members FROM {_QIND} GROUP BY 1, 2")
def _(t):
    # pieces of 500 orders keep every array bounded however many quotes an industry has
    out = aggregates.industry_groups(quotes(t), "industry", F.floor(C("tail").cast("bigint") / 500))
    text = F.transform("members", lambda m: F.concat_ws(":", m["code"], m["name"], m["pct"].cast("int").cast("string")))
    return out.select("industry", "part", joined(text).alias("members"))


@query("industry_members", f"SELECT industry, row_number() OVER (PARTITION BY industry ORDER BY abs(pct) DESC, code, name, pct) AS place, code, name, pct FROM {_QIND}")
def _(t):
    return aggregates.industry_members(quotes(t), "industry")


@query("industry_average", f"SELECT industry, round(avg(pct), 6) AS avg_pct, count(*) AS members, CASE WHEN abs(avg(pct)) >= 8 THEN 5 WHEN abs(avg(pct)) >= 6 THEN 4 WHEN abs(avg(pct)) >= 4 THEN 3 WHEN abs(avg(pct)) >= 2 THEN 2 ELSE 1 END AS tier FROM {_QIND} GROUP BY 1")
def _(t):
    return rounded(aggregates.industry_average(quotes(t), "industry", "pct"), 6, "avg_pct")


_COMPLETE = """SELECT stock_code, ipo_date, actual_days + missing_count AS expected_days, actual_days, missing_count, missing_dates, note FROM (
 SELECT s.stock_code, s.ipo_date, (SELECT count(*) FROM fx_daily d WHERE d.stock_code = s.stock_code) AS actual_days,
  count(*) AS missing_count, string_agg(CAST(c.trade_date AS VARCHAR), ',' ORDER BY c.trade_date) AS missing_dates, CAST(NULL AS VARCHAR) AS note
 FROM fx_stock_map s JOIN fx_cal c ON c.trade_date >= s.ipo_date LEFT JOIN fx_daily k ON k.stock_code = s.stock_code AND k.trade_date = c.trade_date
 WHERE k.stock_code IS NULL GROUP BY 1, 2
 UNION ALL SELECT s.stock_code, s.ipo_date, count(*), NULL, NULL, 'no listing date' FROM fx_stock_map s JOIN fx_daily USING (stock_code) WHERE ipo_date IS NULL GROUP BY 1, 2)"""


@query("completeness_report", _COMPLETE)
def _(t):
    out = complete.completeness_report(t.fx_stock_map(), t.fx_daily(), REF)
    return out.withColumn("missing_dates", joined("missing_dates"))


@query("completeness_daily", f"SELECT * FROM ({_COMPLETE}) WHERE stock_code IN (SELECT code FROM fx_industry WHERE industry IS NOT NULL)")
def _(t):
    codes = t.fx_industry().filter("industry is not null").select("code")
    out = complete.completeness_daily(t.fx_stock_map(), t.fx_daily(), codes, REF)
    return out.withColumn("missing_dates", joined("missing_dates"))


_RANGES = """SELECT * FROM (WITH c AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS r FROM fx_cal),
 m AS (SELECT s.stock_code, c.trade_date, c.r - row_number() OVER (PARTITION BY s.stock_code ORDER BY c.r) AS g FROM fx_stock_map s JOIN c ON c.trade_date >= s.ipo_date
  LEFT JOIN fx_daily k ON k.stock_code = s.stock_code AND k.trade_date = c.trade_date WHERE k.stock_code IS NULL)
 SELECT stock_code, min(trade_date) AS first_day, max(trade_date) AS last_day, count(*) AS days FROM m GROUP BY stock_code, g)"""


@query("missing_ranges", _RANGES)
def _(t):
    return complete.daily_ranges(t.fx_stock_map(), t.fx_daily(), reference=REF)


# two days are one request if less than three trading days lie between them
@query("backfill_ranges", f"""SELECT * FROM (WITH c AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS r FROM fx_cal), x AS (SELECT q.*, a.r AS a, b.r AS b FROM ({_RANGES}) q JOIN c a ON a.trade_date = first_day JOIN c b ON b.trade_date = last_day),
 y AS (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY stock_code ORDER BY a) <= 3 THEN 0 ELSE 1 END AS head FROM x), z AS (SELECT *, sum(head) OVER (PARTITION BY stock_code ORDER BY a) AS part FROM y)
 SELECT stock_code, min(first_day) AS first_day, max(last_day) AS last_day, CAST(sum(days) AS BIGINT) AS days FROM z GROUP BY stock_code, part)""")
def _(t):
    calendar = joins.reference_calendar(t.fx_daily(), "stock_code", C("trade_date"), REF)
    ranges = complete.daily_ranges(t.fx_stock_map(), t.fx_daily(), reference=REF)
    return runs.backfill_ranges(ranges, calendar, bridge=2)


@query("minute_ranges", """SELECT * FROM (WITH d AS (SELECT DISTINCT stock_code, CAST(datetime AS DATE) AS day FROM fx_minute), cal AS (SELECT day, row_number() OVER (ORDER BY day) AS r FROM d WHERE stock_code = '000000'),
 s AS (SELECT 'x' || code AS stock_code, (SELECT max(day) FROM cal) AS latest FROM fx_stocks UNION ALL SELECT stock_code, max(day) FROM d GROUP BY 1),
 m AS (SELECT s.stock_code, cal.day, r - row_number() OVER (PARTITION BY s.stock_code ORDER BY r) AS g FROM s JOIN cal ON cal.day <= latest LEFT JOIN d ON d.stock_code = s.stock_code AND d.day = cal.day WHERE d.day IS NULL)
 SELECT stock_code, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM m GROUP BY stock_code, g)""")
def _(t):
    codes = t.fx_stocks().select("code").union(t.fx_stocks().select(F.concat(F.lit("x"), "code")))  # half of them never traded
    return complete.minute_ranges(t.fx_minute(), "000000", codes)


_MINUTE = """SELECT stock_code, missing_date, CAST((SELECT count(*) FROM cal WHERE d > missing_date AND d <= latest) AS INTEGER) AS "offset", daily_bars FROM (
 SELECT l.stock_code, c.d AS missing_date, l.latest, CAST(NULL AS BIGINT) AS daily_bars FROM last l JOIN cal c ON c.d <= l.latest
 WHERE NOT EXISTS (SELECT 1 FROM per_day p WHERE p.stock_code = l.stock_code AND p.d = c.d)
 UNION ALL SELECT stock_code, d, latest, bars FROM per_day JOIN last USING (stock_code) WHERE bars < 3)"""
_MINUTE = "SELECT * FROM (WITH cal AS (SELECT DISTINCT CAST(datetime AS DATE) AS d FROM fx_minute WHERE stock_code = '000000'), per_day AS (SELECT stock_code, CAST(datetime AS DATE) AS d, count(*) AS bars FROM fx_minute GROUP BY 1, 2), last AS (SELECT stock_code, max(d) AS latest FROM per_day GROUP BY 1) " + _MINUTE + ")"


@query("completeness_minute", _MINUTE)
def _(t):
    return complete.completeness_minute(t.fx_minute(), "000000", min_bars=3)


@query("completeness_minute_codes", f"SELECT * FROM ({_MINUTE}) WHERE stock_code IN (SELECT code FROM fx_industry WHERE industry IS NOT NULL)")
def _(t):
    # the codes are a table; those without any bar are left out of the comparison
    codes = t.fx_industry().filter("industry is not null").select("code").join(t.fx_minute().select(C("stock_code").alias("code")), "code", "left_semi")
    return complete.completeness_minute(t.fx_minute(), "000000", codes, min_bars=3)


@query("minute_marks", "SELECT stock_code, max(datetime) AS mark FROM fx_minute GROUP BY 1")
def _(t):
    # marks of the first days, merged with those of the rest
    first = joins.marks_of(t.fx_minute().filter("datetime < '2024-01-10'"), "stock_code", "datetime")
    rest = joins.marks_of(t.fx_minute().filter("datetime >= '2024-01-10'"), "stock_code", "datetime")
    return joins.merge_marks(first, rest, "stock_code")


_TWO_YEARS = """SELECT * FROM (WITH m AS (SELECT stock_code, CAST(datetime AS DATE) AS d FROM fx_minute UNION ALL SELECT stock_code, CAST(datetime + INTERVAL 366 DAY AS DATE) FROM fx_minute WHERE CAST(stock_code AS INTEGER) % 3 = 0),
 cal AS (SELECT DISTINCT d, year(d) AS y FROM m WHERE stock_code = '000000'),
 per_day AS (SELECT stock_code, d, year(d) AS y, count(*) AS bars FROM m GROUP BY 1, 2), last AS (SELECT stock_code, y, max(d) AS latest FROM per_day GROUP BY 1, 2)
 SELECT stock_code, missing_date, CAST((SELECT count(*) FROM cal WHERE d > missing_date AND d <= latest) AS INTEGER) AS "offset", daily_bars FROM (
  SELECT l.stock_code, c.d AS missing_date, l.latest, CAST(NULL AS BIGINT) AS daily_bars FROM last l JOIN cal c ON c.y = l.y AND c.d <= l.latest
   WHERE NOT EXISTS (SELECT 1 FROM per_day p WHERE p.stock_code = l.stock_code AND p.d = c.d)
  UNION ALL SELECT stock_code, d, latest, bars FROM per_day JOIN last USING (stock_code, y) WHERE bars < 3))"""


@query("completeness_minute_per_year", _TWO_YEARS)
def _(t):
    bars = t.fx_minute().select("stock_code", "datetime")
    later = bars.filter(C("stock_code").cast("int") % 3 == 0).withColumn("datetime", C("datetime") + F.expr("interval 366 days"))
    return complete.completeness_minute(bars.unionByName(later), "000000", min_bars=3, per_year=True)


def landed(t):
    expected = t.fx_stocks().filter(is_a_share(C("code"), C("market"))).select("code")
    prefixed = expected.select(code_to_prefixed(C("code")).alias("code"))
    stamp = C("datetime").cast("timestamp_ntz").alias("ingested_at")
    primary = t.fx_daily_a().select("stock_code", stamp)
    secondary = t.fx_daily_b().select("stock_code", C("date").cast("timestamp_ntz").alias("ingested_at"))
    bulk = t.table("orders").select(C("o_orderdate").alias("ingested_at"))
    return [
        complete.Landed("daily_primary", "primary", primary, "stock_code", expected),
        complete.Landed("daily_secondary", "secondary", secondary, "stock_code", prefixed),
        complete.Landed("minute", "primary", t.fx_minute_raw().select("stock_code", stamp), "stock_code", expected),
        complete.Landed("stocks", "primary", bulk),
    ]


def day10():
    return F.lit("2024-01-10").cast("date")
_LANDED = """WITH e AS (SELECT code, market || code AS pcode FROM fx_stocks WHERE (market = 'sz' AND left(code, 2) IN ('00', '30')) OR (market = 'sh' AND left(code, 2) IN ('60', '68'))),
 exp AS (SELECT 'daily_primary' AS t, 'primary' AS s, code FROM e UNION ALL SELECT 'daily_secondary', 'secondary', pcode FROM e UNION ALL SELECT 'minute', 'primary', code FROM e),
 seen AS (SELECT DISTINCT 'daily_primary' AS t, stock_code AS code FROM fx_daily_a WHERE trade_date = DATE '2024-01-10' UNION SELECT 'daily_secondary', market || stock_code FROM fx_daily_b WHERE trade_date = DATE '2024-01-10' UNION SELECT 'minute', stock_code FROM fx_minute WHERE CAST(datetime AS DATE) = DATE '2024-01-10'),
 gone AS (SELECT t, s, code FROM exp WHERE (t, code) NOT IN (SELECT t, code FROM seen)) """


@query("coverage_missing", "SELECT * FROM (" + _LANDED + "SELECT t AS \"table\", s AS source, code FROM gone)")
def _(t):
    return complete.coverage_missing(landed(t), day10())


@query("coverage_by_table", "SELECT * FROM (" + _LANDED + """
 SELECT x.t AS "table", x.s AS source, x.n AS expected, (SELECT count(*) FROM seen WHERE seen.t = x.t) AS present, (SELECT count(*) FROM gone WHERE gone.t = x.t) AS missing,
  CASE WHEN (SELECT count(*) FROM gone WHERE gone.t = x.t) = 0 THEN 'ok' ELSE 'gap' END AS status
 FROM (SELECT t, s, count(*) AS n FROM exp GROUP BY 1, 2) x
 UNION ALL SELECT 'stocks', 'primary', 1, 0, 1, 'missing' WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '2024-01-10'))""")
def _(t):
    return complete.coverage_by_table(landed(t), day10())


def _bitmaps(t):
    """Numbers of all codes, and the day bitmaps of two tables, put together from two halves of the days."""
    numbers = windows.surrogate_id(t.fx_stocks().select("code").distinct(), "code", name="number")
    tables = []
    for name, df, code, ts in (("daily", t.fx_daily_a(), "stock_code", "datetime"), ("minute", t.fx_minute(), "stock_code", "datetime")):
        early = F.to_date(C(ts)) < "2024-01-12"
        halves = [complete.day_bitmaps(df.filter(half), code, ts, numbers) for half in (early, ~early)]
        tables.append(complete.merge_bitmaps(*halves).withColumn("table", F.lit(name)))
    expected = t.fx_stocks().filter(is_a_share(C("code"), C("market"))).select("code")
    return tables[0].unionByName(tables[1]), complete.code_bitmap(expected, numbers)


_ARRIVED = "(SELECT 'daily' AS \"table\", stock_code AS code, trade_date AS day FROM fx_daily_a UNION SELECT 'minute', stock_code, CAST(datetime AS DATE) FROM fx_minute)"
_COVERED = """SELECT {by}, (SELECT count(*) FROM fx_stock_map) AS expected, count(DISTINCT code) AS present, (SELECT count(*) FROM fx_stock_map) - count(DISTINCT s.stock_code) AS missing,
 CASE WHEN (SELECT count(*) FROM fx_stock_map) = count(DISTINCT s.stock_code) THEN 'ok' ELSE 'gap' END AS status FROM {rows} a LEFT JOIN fx_stock_map s ON s.stock_code = a.code {where} GROUP BY {by}"""


@query("coverage_by_day", _COVERED.format(by='"table", day', rows=_ARRIVED, where=""))
def _(t):
    bitmaps, expected = _bitmaps(t)
    return complete.bitmap_coverage(bitmaps, expected, ["table", "day"])


@query("coverage_of_span", _COVERED.format(by='"table"', rows=_ARRIVED, where="WHERE day BETWEEN DATE '2024-01-09' AND DATE '2024-01-16'"))
def _(t):
    bitmaps, expected = _bitmaps(t)
    span = bitmaps.filter(C("day").between("2024-01-09", "2024-01-16"))
    return complete.bitmap_coverage(span.drop("day"), expected, ["table"])


@query("run_step_rollup", """SELECT plan_id, step_name, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(elapsed_ms) AS BIGINT) AS elapsed_ms,
 (SELECT coalesce(string_agg(error, '|' ORDER BY seq, pos), '') FROM (SELECT * FROM (SELECT f.seq, u.pos, CASE u.pos WHEN 0 THEN f.code || ': timeout' WHEN 1 THEN 'general failure' ELSE 'sh' || f.code || ': empty: x' END AS error FROM fx_results f, (SELECT unnest([0, 1, 2]) AS pos) u WHERE f.status <> 'ok' AND f.plan_id = r.plan_id AND f.step_name = r.step_name) ORDER BY seq, pos LIMIT 50)) AS errors,
 (SELECT coalesce(string_agg(code, ',' ORDER BY code), '') FROM (SELECT DISTINCT code FROM (SELECT f.code FROM fx_results f WHERE f.status <> 'ok' AND f.plan_id = r.plan_id AND f.step_name = r.step_name UNION ALL SELECT 'sh' || f.code FROM fx_results f WHERE f.status <> 'ok' AND f.plan_id = r.plan_id AND f.step_name = r.step_name) ORDER BY code LIMIT 100)) AS failed_codes,
 CAST(count(*) FILTER (WHERE status <> 'ok') * 3 AS BIGINT) AS n_errors, CAST(2 * count(DISTINCT code) FILTER (WHERE status <> 'ok') AS BIGINT) AS n_failed_codes,
 CASE WHEN sum(failed) = 0 THEN 'ok' ELSE 'partial' END AS status FROM fx_results r GROUP BY 1, 2""")
def _(t):
    out = runs.run_step_rollup(t.fx_results())
    return out.withColumns({"errors": joined("errors", "|"), "failed_codes": joined("failed_codes")})


@query("step_errors", "SELECT plan_id, step_name, seq, CAST(u.pos AS INTEGER) AS pos, CASE u.pos WHEN 0 THEN code || ': timeout' WHEN 1 THEN 'general failure' ELSE 'sh' || code || ': empty: x' END AS error FROM fx_results, (SELECT unnest([0, 1, 2]) AS pos) u WHERE status <> 'ok'")
def _(t):
    return runs.step_errors(t.fx_results())


@query("step_failed_codes", "SELECT plan_id, step_name, code FROM fx_results WHERE status <> 'ok' UNION SELECT plan_id, step_name, 'sh' || code FROM fx_results WHERE status <> 'ok'")
def _(t):
    return runs.step_failed_codes(t.fx_results())


# ---- windows ----------------------------------------------------------------------


@query("pre_close", "SELECT stock_code, trade_date, close, pre_close FROM fx_daily")
def _(t):
    kept = t.fx_daily().drop("pre_close")
    return windows.pre_close(kept, "stock_code", "trade_date").select(*DAY, "close", "pre_close")


@query("pre_close_chunked", "SELECT user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS pre_close FROM events")
def _(t):
    ticks = t.table("events").select("user_id", "ts", "value")
    return windows.pre_close(ticks, "user_id", "ts", "value", chunk="day")


@query("change_pct", "SELECT stock_code, trade_date, round(change_pct, 4) AS change_pct FROM fx_daily")
def _(t):
    return t.fx_daily().select(*DAY, F.round(windows.change_pct(C("close"), C("pre_close")), 4).alias("change_pct"))


@query("surrogate_id", "SELECT 100 + row_number() OVER (ORDER BY code) AS id, code FROM fx_stocks")
def _(t):
    return windows.surrogate_id(t.fx_stocks().select("code"), "code", 100)


@query("trading_day_offset", "SELECT stock_code, trade_date, latest, CAST((SELECT count(*) FROM fx_cal c WHERE c.trade_date > d.trade_date AND c.trade_date <= latest) AS INTEGER) AS \"offset\" FROM (SELECT stock_code, trade_date, max(trade_date) OVER (PARTITION BY stock_code) AS latest FROM fx_events) d")
def _(t):
    days = silver.corporate_actions(t.fx_xdxr()).select(*DAY)
    last = days.groupBy("stock_code").agg(F.max("trade_date").alias("latest"))
    return windows.trading_day_offset(days.join(last, "stock_code"), calendar(t), "trade_date", "latest").select(*DAY, "latest", "offset")


@query("single_factor", "SELECT stock_code, trade_date, round(fenhong, 6) AS fenhong, peigu_price, round(songzhuangu, 6) AS songzhuangu, round(peigu, 6) AS peigu, round(single_factor, 6) AS single_factor FROM fx_factors")
def _(t):
    return rounded(t.fx_factors(), 6, "fenhong", "songzhuangu", "peigu", "single_factor")


_ADJ_ALL = """SELECT stock_code, trade_date, open, high, low, close, pre_close, volume, round(amount, 4) AS amount,
 round(CASE WHEN pre_close > 0 THEN (close - pre_close) / pre_close * 100 END, 6) AS change_pct FROM (
 SELECT b.stock_code, b.trade_date, b.open {op} AS open, b.high {op} AS high, b.low {op} AS low, b.close {op} AS close, b.volume, b.amount,
  coalesce(lag(b.close {op}) OVER (PARTITION BY b.stock_code ORDER BY b.trade_date), b.pre_close {op}) AS pre_close
 FROM fx_daily b JOIN (SELECT b.stock_code, b.trade_date, coalesce(product(coalesce(f.single_factor, 1)) FILTER (WHERE f.trade_date {cmp} b.trade_date), 1) AS p FROM fx_daily b LEFT JOIN fx_factors f ON f.stock_code = b.stock_code GROUP BY 1, 2) x ON x.stock_code = b.stock_code AND x.trade_date = b.trade_date)"""
_ADJ_OUT = "SELECT * REPLACE (round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low, round(close, 4) AS close, round(pre_close, 4) AS pre_close) FROM ({rows}) WHERE stock_code IN ({codes}) AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
_ADJ = "SELECT b.stock_code, b.trade_date, round(b.close {op}, 4) AS close, round(b.open {op}, 4) AS open FROM fx_daily b JOIN (SELECT b.stock_code, b.trade_date, coalesce(product(coalesce(f.single_factor, 1)) FILTER (WHERE f.trade_date {cmp} b.trade_date), 1) AS p FROM fx_daily b LEFT JOIN fx_factors f ON f.stock_code = b.stock_code GROUP BY 1, 2) x ON x.stock_code = b.stock_code AND x.trade_date = b.trade_date"
_QFQ = _ADJ.format(op="* p", cmp=">")
_HFQ = _ADJ.format(op="/ nullif(p, 0)", cmp="<=")


@query("factor_steps", """SELECT * FROM (WITH e AS (SELECT stock_code, trade_date, product(coalesce(single_factor, 1)) AS f FROM fx_factors GROUP BY 1, 2),
 k AS (SELECT stock_code, trade_date FROM e UNION ALL SELECT DISTINCT stock_code, CAST(NULL AS DATE) FROM e)
 SELECT k.stock_code, k.trade_date AS "from", CAST(min(e.trade_date) FILTER (WHERE later) - 1 AS DATE) AS "to",
  round(coalesce(product(f) FILTER (WHERE later), 1), 6) AS factor_after, round(coalesce(product(f) FILTER (WHERE NOT later), 1), 6) AS factor_upto
 FROM k JOIN (SELECT * FROM e) e ON e.stock_code = k.stock_code, LATERAL (SELECT k.trade_date IS NULL OR e.trade_date > k.trade_date AS later) GROUP BY 1, 2)""")
def _(t):
    return rounded(windows.factor_steps(t.fx_factors()), 6, "factor_after", "factor_upto")


@query("step_factor", "SELECT stock_code, trade_date, round(p, 6) AS factor_after, round(q, 6) AS factor_upto FROM (SELECT b.stock_code, b.trade_date, coalesce(product(coalesce(f.single_factor, 1)) FILTER (WHERE f.trade_date > b.trade_date), 1) AS p, coalesce(product(coalesce(f.single_factor, 1)) FILTER (WHERE f.trade_date <= b.trade_date), 1) AS q FROM fx_daily b LEFT JOIN fx_factors f ON f.stock_code = b.stock_code GROUP BY 1, 2)")
def _(t):
    # the steps of half of the codes come from an update of a table without events after a day
    factors, codes = t.fx_factors(), t.fx_factors().filter(C("stock_code") >= "3").select("stock_code")
    old = factors.filter((C("stock_code") < "3") | (C("trade_date") < "2024-01-15"))
    steps = windows.update_steps(windows.factor_steps(old), factors, codes)
    out = windows.step_factor(t.fx_daily(), steps, "2023-12-01", "2024-03-01")
    return rounded(out, 6, "factor_after", "factor_upto").select(*DAY, "factor_after", "factor_upto")


@query("last_before", "SELECT code AS stock_code, max(trade_date) AS trade_date, max_by(close, trade_date) AS close FROM fx_stocks JOIN fx_daily ON stock_code = code WHERE trade_date < DATE '2024-01-12' GROUP BY 1")
def _(t):
    wanted = t.fx_stocks().select(C("code").alias("stock_code"))
    return windows.last_before(t.fx_daily(), "stock_code", "trade_date", "2024-01-12", wanted, lookback=2)


@query("adjust_forward", _QFQ)
def _(t):
    out = windows.adjust_forward(t.fx_daily(), t.fx_factors())
    return rounded(out, 4, "close", "open").select(*DAY, "close", "open")


@query("adjust_backward", _HFQ)
def _(t):
    out = windows.adjust_backward(t.fx_daily(), t.fx_factors())
    return rounded(out, 4, "close", "open").select(*DAY, "close", "open")


# ---- set operations and table modes -------------------------------------------------


@query("union_aligned", "SELECT stock_code, trade_date, amount FROM fx_daily_a UNION ALL SELECT stock_code, trade_date, NULL FROM fx_daily_b")
def _(t):
    a = silver.primary_bars(t.fx_daily_a()).select(*DAY, "amount")
    return setops.union_aligned(a, plain_b(t).select(*DAY))


@query("union_keys", "SELECT stock_code FROM fx_daily_a UNION SELECT stock_code FROM fx_daily_b")
def _(t):
    return setops.union_keys(t.fx_daily_a(), plain_b(t), column="stock_code")


@query("except_keys", "SELECT code FROM fx_industry EXCEPT SELECT code FROM fx_stocks")
def _(t):
    return setops.except_keys(t.fx_industry(), t.fx_stocks(), ["code"])


@query("src_market_union", "SELECT code, name, market FROM fx_stocks")
def _(t):
    s = t.fx_stocks()
    lists = {m: s.filter(C("market") == m).drop("market") for m in ("sz", "sh")}
    return setops.union_markets({**lists, "bj": None})


def versions(t):
    e = t.table("events").select("event_id", "value")
    target = e.join(t.table("events").filter("event_type <> 'error'").select("event_id"), "event_id", "left_semi")
    return target, t.fx_bronze_dup()


_TARGET = "(SELECT event_id, value FROM events WHERE event_type <> 'error')"
_BATCH = "(SELECT event_id, value, ingested_at FROM fx_bronze_dup WHERE event_type IN ('error', 'view'))"


def batch(t):
    return t.fx_bronze_dup().filter("event_type in ('error', 'view')").withColumn("value", C("value") * 2)


@query("upsert_ignore", f"SELECT * FROM {_TARGET} UNION ALL SELECT event_id, first(value * 2 ORDER BY ingested_at) FROM {_BATCH} WHERE event_id NOT IN (SELECT event_id FROM {_TARGET}) GROUP BY 1")
def _(t):
    out = upsert.upsert_ignore(versions(t)[0], batch(t), ["event_id"], ["ingested_at"])
    return out.select("event_id", "value")


@query("upsert_update", f"SELECT * FROM {_TARGET} WHERE event_id NOT IN (SELECT event_id FROM {_BATCH}) UNION ALL SELECT event_id, last(value * 2 ORDER BY ingested_at) FROM {_BATCH} GROUP BY 1")
def _(t):
    out = upsert.upsert_update(versions(t)[0], batch(t), ["event_id"], ["ingested_at"])
    return out.select("event_id", "value")


@query("replace_keys", "SELECT stock_code, trade_date, close FROM fx_daily WHERE stock_code NOT IN (SELECT code FROM fx_industry WHERE industry IS NOT NULL) UNION ALL SELECT stock_code, trade_date, close * 2 FROM fx_daily WHERE stock_code IN (SELECT code FROM fx_industry WHERE industry IS NOT NULL)")
def _(t):
    daily = t.fx_daily().select(*DAY, "close")
    codes = t.fx_industry().filter("industry is not null").select("code")
    return upsert.replace_keys(daily, daily.withColumn("close", C("close") * 2), "stock_code", codes)


@query("replace_row", "SELECT plan_id, CASE WHEN plan_id = 'plan_199605' THEN 'ok' ELSE 'running' END AS status FROM (SELECT DISTINCT plan_id FROM fx_results)")
def _(t):
    log = t.fx_results().select("plan_id").distinct().withColumn("status", F.lit("running"))
    row = log.filter("plan_id = 'plan_199605'").withColumn("status", F.lit("ok"))
    return upsert.replace_row(log, row, ["plan_id"])


# ---- quality ------------------------------------------------------------------------


_NONE = "CAST(NULL AS DATE)"


def _issue_sql(level, table, message, raw, source, code="''", date=_NONE, column=""):
    return f"SELECT '{level}' AS level, '{table}' AS \"table\", {code} AS stock_code, {date} AS trade_date, '{column}' AS \"column\", {message} AS message, CAST({raw} AS VARCHAR) AS raw_value FROM {source}"


def _null_sql(level, table, column, source):
    return _issue_sql(level, table, f"'{column} is null in ' || n || ' of ' || total || ' rows'", "n || '/' || total",
                      f"(SELECT count(*) FILTER (WHERE {column} IS NULL) AS n, count(*) AS total FROM {source}) WHERE n > 0", column=column)


def _dup_sql(table, keys, source):
    return _issue_sql("error", table, f"n || ' duplicate groups of {keys}'", "n",
                      f"(SELECT count(*) AS n FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)) WHERE n > 0")


_REJ = _issue_sql("warning", "silver.daily_kline", "'quality gate rejected ' || n || ' rows'", "n", "(SELECT count(*) AS n FROM fx_merged WHERE NOT (close > 0 AND high >= low)) WHERE n > 0")
_DQ_MAP = " UNION ALL ".join([
    _issue_sql("warning", "silver.stock_map", "'ipo_date missing for ' || stock_code", "'NULL'", "fx_stock_map WHERE ipo_date IS NULL", code="stock_code", column="ipo_date"),
    _issue_sql("warning", "silver.stock_map", "'stock_name missing for ' || stock_code", "'NULL'", "fx_stock_map WHERE stock_name IS NULL OR stock_name = ''", code="stock_code", column="stock_name"),
    _issue_sql("error", "silver.stock_map", "'finance covers ' || (total - n) || '/' || total || ' (' || printf('%.1f', round(100 - n * 100.0 / total, 1)) || '%)'", "n || '/' || total",
               "(SELECT count(*) FILTER (WHERE ipo_date IS NULL) AS n, count(*) AS total FROM fx_stock_map) WHERE n > 0", column="ipo_date"),
])
_DQ_DAILY = _REJ + " UNION ALL " + _null_sql("info", "silver.daily_kline", "pre_close", "fx_daily")
_DQ_ADJ = _null_sql("warning", "silver.adj_factor", "single_factor", "fx_factors") + " UNION ALL " + _issue_sql(
    "warning", "silver.adj_factor", "'implausible factor ' || printf('%.6f', single_factor)", "printf('%.6f', single_factor)",
    "fx_factors WHERE single_factor <= 0 OR single_factor > 1.5", code="stock_code", date="trade_date", column="single_factor")


@query("dq_stock_map", _DQ_MAP)
def _(t):
    return quality.dq_stock_map(t.fx_stock_map())


@query("dq_daily", _DQ_DAILY)
def _(t):
    bars, rejects = silver.daily_bars(t.fx_daily_a(), t.fx_daily_b())
    return quality.dq_daily(bars, rejects)


@query("dq_adj_factor", _DQ_ADJ)
def _(t):
    return quality.dq_adj_factor(t.fx_factors())


@query("dq_minute", _dup_sql("silver.minute_kline", "stock_code, datetime", "(SELECT * FROM fx_minute UNION ALL SELECT * FROM fx_minute WHERE close > 400)") + " UNION ALL " + _issue_sql(
    "warning", "silver.minute_kline", "'quality gate rejected ' || n || ' rows'", "n", "(SELECT count(*) AS n FROM fx_minute WHERE close > 300) WHERE n > 0"))
def _(t):
    raw = t.fx_minute_raw()  # copies of some bars have no price
    bars, rejects = silver.minute_bars(raw.unionByName(raw.filter("close > 300").withColumn("close", F.lit(0.0))))
    return quality.dq_minute(bars.unionByName(bars.filter("close > 400")), rejects)


_ODD_FINANCE = "(SELECT stock_code, report_date FROM fx_finance_rows UNION ALL SELECT stock_code, CASE WHEN left(stock_code, 2) = '60' THEN report_date END FROM fx_finance_rows WHERE left(stock_code, 2) IN ('60', '30'))"


@query("dq_finance", _null_sql("warning", "silver.finance", "report_date", _ODD_FINANCE) + " UNION ALL " + _dup_sql("silver.finance", "stock_code, report_date", _ODD_FINANCE))
def _(t):
    rows = t.fx_finance_rows()  # some statements come twice, some have lost their date
    board = F.substring("stock_code", 1, 2)
    odd = rows.filter(board.isin("60", "30")).withColumn("report_date", F.when(board == "60", C("report_date")))
    return quality.dq_finance(rows.unionByName(odd))


@query("dq_doc", _null_sql("warning", "silver.doc", "html", "d") .replace("FROM d)", "FROM (SELECT NULLIF(lang, 'fr') AS html FROM documents))") + " UNION ALL " + _dup_sql("silver.doc", "stock_code, trade_date", "(SELECT source AS stock_code, DATE '2024-01-01' AS trade_date FROM documents)"))
def _(t):
    docs = t.table("documents").select(
        C("source").alias("stock_code"), F.lit("2024-01-01").cast("date").alias("trade_date"),
        F.expr("nullif(lang, 'fr')").alias("html"),
    )
    return quality.dq_doc(docs)


@query("issues_table", _DQ_DAILY + " UNION ALL " + _DQ_ADJ)
def _(t):
    bars, rejects = silver.daily_bars(t.fx_daily_a(), t.fx_daily_b())
    return quality.issues_table(quality.dq_daily(bars, rejects), quality.dq_adj_factor(silver.adj_factors(t.fx_xdxr(), bars)))


@query("build_status", f"SELECT count(*) FILTER (WHERE level = 'error') AS errors, count(*) FILTER (WHERE level = 'warning') AS warnings, count(*) FILTER (WHERE level = 'info') AS infos, CASE WHEN count(*) FILTER (WHERE level = 'error') = 0 THEN 'ok' ELSE 'partial' END AS status FROM ({_DQ_MAP})")
def _(t):
    return quality.build_status(quality.dq_stock_map(t.fx_stock_map()), 1)


# ---- read queries -------------------------------------------------------------------


@query("q_stock_list", "SELECT * FROM fx_stock_map WHERE ipo_date <= DATE '2024-01-08' AND (delist_date IS NULL OR delist_date > DATE '2024-01-08')")
def _(t):
    return serve.stock_list(t.fx_stock_map(), "2024-01-08")


@query("q_stock_info", "SELECT * FROM fx_stock_map WHERE stock_code = '600002'")
def _(t):
    return serve.stock_info(t.fx_stock_map(), "sh600002")


_DAILY_OUT = "stock_code, trade_date, open, high, low, close, pre_close, volume, round(amount, 4) AS amount, round(change_pct, 4) AS change_pct"


@query("q_daily", f"SELECT {_DAILY_OUT} FROM fx_daily WHERE stock_code = '600002' AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _(t):
    return rounded(serve.daily(t.fx_daily(), "sh600002", "2024-01-05", "2024-01-20"), 4, "amount", "change_pct")


@query("q_daily_qfq", _ADJ_OUT.format(rows=_ADJ_ALL.format(op="* p", cmp=">"), codes="SELECT stock_code FROM fx_events"))
def _(t):
    codes = silver.corporate_actions(t.fx_xdxr()).select("stock_code").distinct()
    out = serve.daily_batch(t.fx_daily(), codes, "2024-01-05", "2024-01-20", "qfq", t.fx_factors())
    return rounded(rounded(out, 4, *PRICES, "pre_close", "amount"), 6, "change_pct")


@query("q_daily_hfq", _ADJ_OUT.format(rows=_ADJ_ALL.format(op="/ nullif(p, 0)", cmp="<="), codes="SELECT stock_code FROM fx_events"))
def _(t):
    codes = silver.corporate_actions(t.fx_xdxr()).select("stock_code").distinct()
    out = serve.daily_batch(t.fx_daily(), codes, "2024-01-05", "2024-01-20", "hfq", t.fx_factors())
    return rounded(rounded(out, 4, *PRICES, "pre_close", "amount"), 6, "change_pct")


@query("q_daily_batch", f"SELECT {_DAILY_OUT} FROM fx_daily WHERE stock_code IN ('000000', '600002', '680003') AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _(t):
    return rounded(serve.daily_batch(t.fx_daily(), ["sz000000", "600002", "680003"], "2024-01-05", "2024-01-20"), 4, "amount", "change_pct")


@query("q_minute", "SELECT stock_code, datetime, open, high, low, close, vol, round(amount, 4) AS amount FROM fx_minute WHERE stock_code = '600002' AND CAST(datetime AS DATE) = DATE '2024-01-10'")
def _(t):
    return rounded(serve.minute(t.fx_minute(), "sh600002", "2024-01-10"), 4, "amount")


@query("q_adj_factor", "SELECT stock_code, trade_date, round(single_factor, 6) AS single_factor FROM fx_factors WHERE stock_code = '600002' AND trade_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _(t):
    out = serve.adj_factor(t.fx_factors(), "600002", "2024-01-05", "2024-01-20")
    return rounded(out, 6, "single_factor").select(*DAY, "single_factor")


@query("q_finance", f"SELECT stock_code, report_date, ipo_date, {FINANCE_MEASURES[0]} FROM fx_finance_rows WHERE stock_code = '600002'")
def _(t):
    return serve.finance(t.fx_finance_rows(), "600002").select("stock_code", "report_date", "ipo_date", FINANCE_MEASURES[0])


@query("q_latest_doc", "SELECT source AS stock_code, doc_id, text FROM documents d WHERE doc_id = (SELECT max(doc_id) FROM documents e WHERE e.source = d.source)")
def _(t):
    docs = t.table("documents").select(C("source").alias("stock_code"), "doc_id", "text")
    return serve.latest_document(docs, date="doc_id")


_PLANS = "(SELECT plan_id, 'daily' AS action, min(status) AS status, min(seq) AS started_at, max(seq) AS finished_at FROM fx_results GROUP BY plan_id)"


@query("q_recent_runs", f"SELECT * FROM {_PLANS} ORDER BY started_at DESC, plan_id LIMIT 20")
def _(t):
    plans = t.fx_results().groupBy("plan_id").agg(
        F.lit("daily").alias("action"), F.min("status").alias("status"),
        F.min("seq").alias("started_at"), F.max("seq").alias("finished_at"),
    )
    return serve.recent_runs(plans, 20)


@query("q_run_steps", "SELECT step_name, seq, status, elapsed_ms, rows, failed, failed_codes FROM (SELECT *, CASE WHEN status = 'ok' THEN '' ELSE code END AS failed_codes FROM fx_results) WHERE plan_id = 'plan_199605'")
def _(t):
    steps = t.fx_results().withColumn("failed_codes", F.split(F.coalesce(F.get("errors", F.lit(0)), F.lit("")), ":").getItem(0))
    return serve.run_steps(steps, "plan_199605")


# ---- plans over whole tables ----------------------------------------------------------


@query("build_stock_map", "SELECT * FROM fx_stock_map")
def _(t):
    return t.fx_stock_map()


@query("build_daily", f"SELECT {_DAILY_OUT} FROM fx_daily")
def _(t):
    return rounded(t.fx_daily(), 4, "amount", "change_pct")


@query("build_minute", "SELECT stock_code, datetime, open, high, low, close, vol, round(amount, 4) AS amount FROM fx_minute")
def _(t):
    return rounded(t.fx_minute(), 4, "amount")


@query("build_finance", f"SELECT stock_code, report_date, ipo_date, {', '.join(f'round({m}, 4) AS {m}' for m in FINANCE_MEASURES)} FROM fx_finance_rows")
def _(t):
    return rounded(t.fx_finance_rows(), 4, *FINANCE_MEASURES)


# ---- runs -----------------------------------------------------------------------------


@query("failed_codes", "SELECT replace(\"table\", 'bronze.', '') AS \"table\", code FROM fx_failed")
def _(t):
    return runs.failed_codes(t.fx_results())


_TARGET_CASE = "CASE \"table\" WHEN 'bronze.bars_daily_primary' THEN 'daily' WHEN 'bronze.bars_minute_2024' THEN 'minute' WHEN 'bronze.xdxr' THEN 'adj_factor' WHEN 'bronze.finance' THEN 'finance' END"


@query("failed_codes_by_action", f"SELECT {_TARGET_CASE} AS \"table\", code FROM fx_failed WHERE \"table\" <> 'bronze.quotes'")
def _(t):
    return runs.failed_codes(t.fx_results(), t.rules())


@query("route_targets", f"SELECT \"table\", seq, {_TARGET_CASE} AS target FROM fx_results")
def _(t):
    return runs.route_targets(t.fx_results(), t.rules()).select("table", "seq", "target")


@query("pending_targets", f"SELECT DISTINCT {_TARGET_CASE} AS target FROM fx_results WHERE status IN ('ok', 'partial') AND rows > 0 AND \"table\" <> 'bronze.quotes'")
def _(t):
    return runs.pending_targets(t.fx_results(), t.rules())


@query("retry_outcome", """SELECT "table", code, CASE WHEN NOT again THEN 'succeeded' WHEN round < 2 THEN 'retry' ELSE 'shelved' END AS outcome, CASE WHEN again THEN least(round + 1, 2) ELSE round END AS round
 FROM (SELECT DISTINCT "table", code, CAST(code[1] AS INTEGER) % 2 + 1 AS round, ("table", code) IN (SELECT "table", code FROM fx_results WHERE status = 'fail') AS again FROM fx_results)""")
def _(t):
    r = t.fx_results().join(t.table("orders").select(C("o_orderkey").alias("seq"), fx_code(C("o_custkey")).alias("code")), "seq")
    tried = r.select("table", "code").distinct().withColumn("round", F.substring("code", 1, 1).cast("int") % 2 + 1)
    return runs.retry_outcome(tried, r.filter("status = 'fail'"))


@query("backfill_worklist", f"SELECT stock_code, missing_count, CAST(CASE WHEN left(stock_code, 2) = '60' THEN 2 ELSE 1 END AS INTEGER) AS round FROM ({_COMPLETE}) WHERE missing_count > 0 AND left(stock_code, 2) <> '30'")
def _(t):
    # boards 60 and 30 were tried before, the latter twice
    tried = t.fx_stocks().select(C("code").alias("stock_code"), F.when(C("code").startswith("60"), F.array(F.lit(1))).when(C("code").startswith("30"), F.array(F.lit(1), F.lit(2))).alias("r"))
    tried = tried.select("stock_code", F.explode("r").alias("round"))
    return runs.backfill_worklist(complete.completeness_report(t.fx_stock_map(), t.fx_daily(), REF), tried)


_FEEDS = [("bronze.finance", "finance"), ("bronze.finance", "stock_map"), ("bronze.bars_daily_primary", "daily"), ("bronze.xdxr", "adj_factor")]


@query("repair_worklist", "SELECT DISTINCT target, code FROM (SELECT DISTINCT \"table\", code FROM fx_results) JOIN (SELECT unnest(['bronze.finance', 'bronze.finance', 'bronze.bars_daily_primary', 'bronze.xdxr']) AS \"table\", unnest(['finance', 'stock_map', 'daily', 'adj_factor']) AS target) USING (\"table\") WHERE (\"table\", code) NOT IN (SELECT \"table\", code FROM fx_results WHERE status = 'fail')")
def _(t):
    r = t.fx_results().join(t.table("orders").select(C("o_orderkey").alias("seq"), fx_code(C("o_custkey")).alias("code")), "seq")
    outcome = runs.retry_outcome(r.select("table", "code").distinct().withColumn("round", F.lit(1)), r.filter("status = 'fail'"))
    return runs.repair_worklist(outcome, t.spark.createDataFrame(_FEEDS, "table string, target string"))


@query("heal_worklist", "SELECT * FROM (" + _LANDED + """
 SELECT t AS "table", s AS source, CASE WHEN s = 'secondary' THEN substr(code, 3) ELSE code END AS plain_code,
  CASE WHEN s = 'secondary' THEN code WHEN left(code, 1) = '6' THEN 'sh' || code ELSE 'sz' || code END AS prefixed_code FROM gone
 UNION ALL SELECT 'stocks', 'primary', NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '2024-01-10'))""")
def _(t):
    tables = landed(t)
    return runs.heal_worklist(complete.coverage_by_table(tables, day10()), complete.coverage_missing(tables, day10()))
