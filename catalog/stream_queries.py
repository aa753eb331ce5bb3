"""Streaming jobs, run over landed files until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions import industry_label
from barlake.plans import silver
from barlake.schemas import QUOTE_FIELDS
from barlake.session import work_dir
from barlake.sources.sinks import read_version, with_year
from barlake.streaming import quotes as st

from .registry import query, rounded

C = F.col
_LIVE = ["poll_id", "code", "name", "current_price", "update_time", "change_pct", "tail"]
_EVENT = "try_strptime(update_time, '%Y%m%d%H%M%S')"


def land(t) -> str:
    """Quote lines as files, one folder per poll."""
    path = work_dir(t.spark, "landing") + "/quotes"
    lines = t.fx_quote_lines().withColumn("poll", C("poll_id")).select("poll", "value")
    lines.write.mode("overwrite").partitionBy("poll").text(path)
    return path


def live(t) -> DataFrame:
    return st.stream_quotes(t.spark, land(t), encoding="UTF-8", max_files=16)


def poll_by_poll(t):
    """The stream again and again, each time with one more poll landed."""
    path = work_dir(t.spark, "landing") + "/quotes"
    lines = t.fx_quote_lines().withColumn("poll", C("poll_id")).select("poll", "value")
    for poll in sorted(r[0] for r in lines.select("poll").distinct().collect()):
        lines.filter(C("poll") == poll).write.mode("append").partitionBy("poll").text(path)
        yield st.stream_quotes(t.spark, path, encoding="UTF-8")


def drain(t, sdf: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream to its end into Parquet and read the result."""
    root = work_dir(t.spark, "stream")
    if mode == "append":
        q = (sdf.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    else:
        q = st.run_available(
            sdf, f"{root}/checkpoint",
            lambda df, i: df.write.mode("overwrite").parquet(f"{root}/out"), mode=mode)
    q.awaitTermination()
    return t.spark.read.parquet(f"{root}/out")


@query("stream_quotes", f"SELECT {', '.join(_LIVE)} FROM fx_live")
def _(t):
    return drain(t, live(t)).select(*_LIVE)


@query("stream_latest", f"SELECT {', '.join(_LIVE)} FROM fx_latest")
def _(t):
    return drain(t, st.stream_latest(live(t)), "complete").select(*_LIVE)


@query("stream_snapshot_replace", f"SELECT DISTINCT {', '.join(_LIVE)} FROM fx_live WHERE poll_id = (SELECT max(poll_id) FROM fx_live)")
def _(t):
    root, sdf = work_dir(t.spark, "replace"), live(t)
    st.stream_snapshot_replace(sdf, f"{root}/snapshot", f"{root}/checkpoint").awaitTermination()
    return read_version(t.spark, f"{root}/snapshot", sdf.schema).select(*_LIVE).distinct()


def subscriptions(t) -> DataFrame:
    wanted = t.fx_stocks().select(F.concat(F.lit("sub_"), "market").alias("sub_id"), F.concat("market", "code").alias("code"))
    everything = t.table("region").select(F.concat(F.lit("all_"), C("r_regionkey").cast("string")).alias("sub_id"), F.lit(None).cast("string").alias("code"))
    return wanted.unionByName(everything)


@query("stream_subscribe", "SELECT sub_id, code, count(*) AS n FROM (SELECT 'sub_' || market AS sub_id, code FROM fx_live JOIN fx_stocks USING (code) UNION ALL SELECT 'all_' || r_regionkey, code FROM fx_live, region) GROUP BY 1, 2")
def _(t):
    wanted = subscriptions(t)
    out = drain(t, st.stream_subscribe(live(t), wanted).select("sub_id", "code"))
    counts = out.groupBy("sub_id", "code").agg(F.count(F.lit(1)).alias("n"))
    # the counts of the shared channel hold for each of its subscribers
    shared = st.wildcard_subscribers(wanted).withColumn("channel", F.lit(st.EVERYTHING))
    everyone = shared.join(counts.withColumnRenamed("sub_id", "channel"), "channel").select("sub_id", "code", "n")
    return counts.filter(C("sub_id") != st.EVERYTHING).unionByName(everyone)


@query("stream_session_gate", f"SELECT {', '.join(_LIVE)} FROM fx_live WHERE isodow({_EVENT}) <= 5 AND (CAST({_EVENT} AS TIME) BETWEEN TIME '09:25:00' AND TIME '11:35:00' OR CAST({_EVENT} AS TIME) BETWEEN TIME '12:55:00' AND TIME '15:05:00')")
def _(t):
    return drain(t, st.stream_session_gate(live(t))).select(*_LIVE)


_INDUSTRY = """SELECT industry, round(avg(pct), 6) AS avg_pct, count(*) AS members, CASE WHEN abs(avg(pct)) >= 8 THEN 5 WHEN abs(avg(pct)) >= 6 THEN 4 WHEN abs(avg(pct)) >= 4 THEN 3 WHEN abs(avg(pct)) >= 2 THEN 2 ELSE 1 END AS tier
 FROM (SELECT coalesce(CASE WHEN industry LIKE 'C27%' THEN substr(industry, 4) ELSE industry END, '其他') AS industry, CAST(change_pct AS DOUBLE) AS pct FROM fx_latest LEFT JOIN fx_industry USING (code)) GROUP BY 1"""


@query("stream_industry", _INDUSTRY)
def _(t):
    root = work_dir(t.spark, "industry")
    industry = t.fx_industry().filter("industry is not null").withColumn("industry", industry_label(C("industry")))
    st.stream_industry(live(t), industry, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    schema = "industry string, avg_pct double, members bigint, tier int"
    empty = t.spark.createDataFrame([], schema)
    return rounded(read_version(t.spark, f"{root}/out", empty.schema), 6, "avg_pct")


@query("stream_industry_changes", _INDUSTRY)
def _(t):
    # poll after poll: each run takes the old quotes of its codes out and puts the new ones in
    root = work_dir(t.spark, "industry")
    industry = t.fx_industry().filter("industry is not null").withColumn("industry", industry_label(C("industry")))
    for sdf in poll_by_poll(t):
        st.stream_industry_changes(sdf, industry, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    schema = t.spark.createDataFrame([], "industry string, avg_pct double, members bigint, tier int").schema
    return rounded(read_version(t.spark, f"{root}/out/out", schema), 6, "avg_pct")


@query("stream_split_late", f"""SELECT q.poll_id, code, update_time, current_price, ts IS NULL OR coalesce(ts < mark - INTERVAL 1000 DAY, false) AS late FROM (SELECT *, {_EVENT} AS ts FROM fx_live) q
 JOIN (SELECT p.poll_id, max(m.mark) AS mark FROM (SELECT DISTINCT poll_id FROM fx_live) p LEFT JOIN (SELECT poll_id, max({_EVENT}) AS mark FROM fx_live GROUP BY 1) m ON m.poll_id < p.poll_id GROUP BY 1) b ON b.poll_id = q.poll_id""")
def _(t):
    root, names = work_dir(t.spark, "late"), ["poll_id", "code", "update_time", "current_price"]
    for sdf in poll_by_poll(t):
        st.stream_split_late(sdf, root, f"{root}/checkpoint", "1000 days").awaitTermination()
    read = lambda name: t.spark.read.parquet(f"{root}/{name}").select(*names)
    return read("on_time").withColumn("late", F.lit(False)).unionByName(read("late").withColumn("late", F.lit(True)))


@query("stream_dedup", "SELECT DISTINCT code, update_time FROM fx_live")
def _(t):
    # a delay longer than the data's span: every repeat is inside the watermark
    return drain(t, st.stream_dedup(live(t), "4000 days").select("code", "update_time"))


@query("stream_bronze_to_silver", "SELECT stock_code, datetime, open, high, low, close, vol, round(amount, 4) AS amount FROM fx_minute")
def _(t):
    root = work_dir(t.spark, "silver")
    raw = t.fx_minute_raw()
    # every bar lands twice, in different files
    raw.unionByName(raw).write.mode("overwrite").parquet(f"{root}/bronze")
    st.stream_bronze_to_silver(
        t.spark, f"{root}/bronze", raw.schema,
        lambda df: with_year(silver.minute_bars(df)[0], "datetime"),
        f"{root}/minute", silver.MINUTE_KEYS, f"{root}/checkpoint", ["year"], max_files=8,
    ).awaitTermination()
    return rounded(t.spark.read.parquet(f"{root}/minute").drop("year"), 4, "amount")


__all__ = ["QUOTE_FIELDS"]
