"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlake import functions as fn

from .fixtures import fx_code, fx_market
from .registry import query, rounded

C = F.col
_UC = "(['00', '30', '60', '68', '90'][user_id % 5 + 1] || lpad(CAST(user_id AS VARCHAR), 4, '0'))"
_UM = "(CASE WHEN user_id % 5 < 2 THEN 'sz' ELSE 'sh' END)"
_CODES = f"(SELECT DISTINCT {_UC} AS code, {_UM} AS market FROM events)"


def codes(t):
    return t.table("events").select(fx_code(C("user_id")).alias("code"), fx_market(C("user_id")).alias("market")).distinct()


@query("code_to_plain", f"SELECT code, code AS p1, code AS p2, market AS p3 FROM {_CODES}")
def _(t):
    both = F.concat("market", "code")
    return codes(t).select(
        "code", fn.code_to_plain(C("code")).alias("p1"), fn.code_to_plain(both).alias("p2"),
        fn.code_to_plain(C("market")).alias("p3"),
    )


@query("strip_exchange", f"SELECT market || code AS full_code, code AS plain FROM {_CODES}")
def _(t):
    return codes(t).select(F.concat("market", "code").alias("full_code")).withColumn(
        "plain", fn.strip_exchange(C("full_code"))
    )


@query("code_to_prefixed",
       f"SELECT code, CASE WHEN left(code, 2) IN ('00', '30') THEN 'sz' || code WHEN left(code, 2) IN ('60', '68') THEN 'sh' || code ELSE code END AS prefixed FROM {_CODES}")
def _(t):
    return codes(t).select("code", fn.code_to_prefixed(C("code")).alias("prefixed"))


@query("code_to_prefixed_lookup",
       f"SELECT code, CASE WHEN left(code, 1) IN ('6', '9') THEN 'sh' ELSE 'sz' END || code AS prefixed FROM {_CODES}")
def _(t):
    return codes(t).select("code", fn.code_to_prefixed_lookup(C("code")).alias("prefixed"))


@query("filter_a_share",
       "SELECT code, name, market FROM fx_stocks WHERE (market = 'sz' AND left(code, 2) IN ('00', '30')) OR (market = 'sh' AND left(code, 2) IN ('60', '68'))")
def _(t):
    return fn.filter_a_share(t.fx_stocks())


@query("filter_index",
       "SELECT code, market FROM (SELECT '399' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS code, 'sz' AS market FROM part UNION ALL SELECT '000' || lpad(CAST(p_size AS VARCHAR), 3, '0'), CASE WHEN p_size % 2 = 0 THEN 'sh' ELSE 'sz' END FROM part) WHERE (market = 'sz' AND code LIKE '399%') OR (market = 'sh' AND code LIKE '000%')")
def _(t):
    part, size = t.table("part"), F.lpad(C("p_size").cast("string"), 3, "0")
    listed = part.select(F.concat(F.lit("399"), size).alias("code"), F.lit("sz").alias("market")).unionByName(
        part.select(F.concat(F.lit("000"), size).alias("code"),
                    F.when(C("p_size") % 2 == 0, "sh").otherwise("sz").alias("market"))
    )
    return fn.filter_index(listed)


@query("int_to_date",
       "SELECT code, updated_date, CAST(try_strptime(CAST(updated_date AS VARCHAR), '%Y%m%d') AS DATE) AS updated, ipo_date, CAST(try_strptime(CAST(CASE WHEN ipo_date > 0 THEN ipo_date END AS VARCHAR), '%Y%m%d') AS DATE) AS ipo FROM fx_finance")
def _(t):
    return t.fx_finance().select(
        "code", "updated_date", fn.int_to_date(C("updated_date")).alias("updated"),
        "ipo_date", fn.int_to_date(C("ipo_date")).alias("ipo"),
    )


@query("ymd_to_date",
       "SELECT p_partkey, TRY_CAST(printf('%04d-%02d-%02d', 2024, p_size % 13 + 1, p_partkey % 31 + 1) AS DATE) AS d FROM part")
def _(t):
    return t.table("part").select(
        "p_partkey",
        fn.ymd_to_date(F.lit(2024), C("p_size") % 13 + 1, C("p_partkey") % 31 + 1).alias("d"),
    )


@query("datetime_to_date", "SELECT event_id, CAST(ts AS DATE) AS d FROM events")
def _(t):
    return t.table("events").select("event_id", fn.datetime_to_date(C("ts").cast("string")).alias("d"))


@query("text_to_timestamp",
       "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS t FROM events")
def _(t):
    text = F.when(C("event_type") == "error", "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return t.table("events").select("event_id", fn.text_to_timestamp(text).alias("t"))


@query("coerce_numeric",
       "SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL WHEN 'click' THEN NULL ELSE value END AS v, CASE WHEN event_type <> 'error' THEN value END AS w FROM events")
def _(t):
    # text that is no number, a NaN and a Java float literal all become NULL
    text = (
        F.when(C("event_type") == "error", "--").when(C("event_type") == "view", "NaN")
        .when(C("event_type") == "click", F.concat(C("value").cast("string"), F.lit("d")))
        .otherwise(C("value").cast("string"))
    )
    nan = F.when(C("event_type") == "error", F.lit("NaN").cast("double")).otherwise(C("value"))
    return fn.coerce_numeric(
        t.table("events").select("event_id", text.alias("v"), nan.alias("w")), ["v", "w"]
    )


@query("fill_zero", "SELECT code, fenhong, coalesce(peigu, 0) AS peigu FROM fx_xdxr")
def _(t):
    return fn.fill_zero(t.fx_xdxr(), ["fenhong", "peigu"]).select("code", "fenhong", "peigu")


@query("lots_to_shares", "SELECT stock_code, trade_date, round(lots * 100, 6) AS volume FROM fx_daily_b")
def _(t):
    return t.fx_daily_b().select(
        F.substring("stock_code", 3, 6).alias("stock_code"), C("date").cast("date").alias("trade_date"),
        F.round(fn.lots_to_shares(C("volume")), 6).alias("volume"),
    )


@query("clean_volume",
       "SELECT event_id, CAST(CASE WHEN event_type = 'error' OR value - 3 < 1 THEN 0 ELSE trunc(value - 3) END AS BIGINT) AS v FROM events")
def _(t):
    raw = F.when(C("event_type") != "error", C("value") - 3)
    return t.table("events").select("event_id", fn.clean_volume(raw).alias("v"))


@query("per_ten_to_per_share",
       "SELECT code, round(fenhong / 10, 6) AS fenhong, round(songzhuangu / 10, 6) AS songzhuangu, peigujia FROM fx_xdxr")
def _(t):
    out = fn.per_ten_to_per_share(t.fx_xdxr(), ["fenhong", "songzhuangu"])
    return rounded(out, 6, "fenhong", "songzhuangu").select("code", "fenhong", "songzhuangu", "peigujia")


@query("quality_gate",
       "SELECT stock_code, trade_date, close, high, low, close > 0 AND high >= low AS kept FROM fx_daily_a")
def _(t):
    kept, rejects = fn.quality_gate(t.fx_daily_a())
    both = kept.withColumn("kept", F.lit(True)).unionByName(rejects.withColumn("kept", F.lit(False)))
    return both.select("stock_code", C("datetime").cast("date").alias("trade_date"), "close", "high", "low", "kept")


@query("project_silver", "SELECT event_id, user_id, value FROM fx_bronze_dup")
def _(t):
    return fn.project_silver(t.fx_bronze_dup(), ["event_id", "user_id", "value"])


@query("rename_keys", "SELECT code AS stock_code, updated_date AS report_date FROM fx_finance")
def _(t):
    out = fn.rename_keys(t.fx_finance(), {"code": "stock_code", "updated_date": "report_date"})
    return out.select("stock_code", "report_date")


@query("date_prefix_filter",
       "SELECT 'text' AS kind, stock_code AS id FROM fx_daily_a WHERE trade_date = DATE '2024-01-10' UNION ALL SELECT 'ts', CAST(event_id AS VARCHAR) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def _(t):
    text = fn.date_prefix_filter(t.fx_daily_a(), "datetime", "2024-01-10")
    stamp = fn.date_prefix_filter(t.table("events"), "ts", "2024-01-10")
    return text.select(F.lit("text").alias("kind"), C("stock_code").alias("id")).unionByName(
        stamp.select(F.lit("ts").alias("kind"), C("event_id").cast("string").alias("id"))
    )


@query("code_in_list",
       "SELECT 'short' AS kind, stock_code, trade_date FROM fx_daily WHERE stock_code IN ('000000', '300001', '600002') UNION ALL SELECT 'frame', stock_code, trade_date FROM fx_daily WHERE stock_code IN (SELECT code FROM fx_industry WHERE industry IS NOT NULL)")
def _(t):
    daily = t.fx_daily().select("stock_code", "trade_date")
    short = fn.code_in_list(daily, "stock_code", ["000000", "300001", "600002"])
    frame = fn.code_in_list(daily, "stock_code", t.fx_industry().filter("industry is not null").select("code"))
    return short.withColumn("kind", F.lit("short")).unionByName(frame.withColumn("kind", F.lit("frame")))


@query("trading_session_filter",
       "SELECT event_id FROM events WHERE isodow(ts) <= 5 AND (CAST(ts AS TIME) BETWEEN TIME '09:25:00' AND TIME '11:35:00' OR CAST(ts AS TIME) BETWEEN TIME '12:55:00' AND TIME '15:05:00')")
def _(t):
    return fn.trading_session_filter(t.table("events"), "ts").select("event_id")


@query("industry_label",
       "SELECT code, CASE WHEN industry LIKE 'C27%' THEN substr(industry, 4) ELSE industry END AS label FROM fx_industry")
def _(t):
    return t.fx_industry().select("code", fn.industry_label(C("industry")).alias("label"))


@query("pct_or_zero",
       "SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE round(value, 2) END AS pct FROM events")
def _(t):
    text = F.when(C("event_type") == "error", "").otherwise(C("value").cast("string"))
    return t.table("events").select("event_id", fn.pct_or_zero(text).alias("pct"))


@query("heat_tier",
       "SELECT tail, CASE WHEN abs(p) >= 8 THEN 5 WHEN abs(p) >= 6 THEN 4 WHEN abs(p) >= 4 THEN 3 WHEN abs(p) >= 2 THEN 2 ELSE 1 END AS tier FROM (SELECT tail, CAST(change_pct AS DOUBLE) AS p FROM fx_quotes)")
def _(t):
    from barlake.sources.parsers import parse_quote_lines

    return parse_quote_lines(t.fx_quote_lines()).select(
        "tail", fn.heat_tier(C("change_pct").cast("double")).alias("tier")
    )


@query("route_source", f"SELECT code, source FROM (SELECT code, 'primary' AS source FROM {_CODES} UNION ALL SELECT market || code, 'secondary' FROM {_CODES})")
def _(t):
    c = codes(t)
    return fn.route_source(c.select("code").unionByName(c.select(F.concat("market", "code").alias("code"))))
