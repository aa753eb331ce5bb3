"""Live quotes: latest row per code, subscriptions, industry averages, bronze to silver.

Every job reads files that land in a folder, so it can be replayed. Checkpoints belong in
a shared folder; versions are numbered by batch from where the checkpoint began, so a repeated
batch writes the same and a new checkpoint continues above what is there. Sinks keep the
last two versions, so finding the current one costs the same however long a stream runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import code_to_plain, heat_tier, in_trading_session, pct_or_zero
from ..operators.aggregates import industry_average
from ..operators.joins import industry_join
from ..operators.upsert import new_rows
from ..schemas import QUOTE_FIELDS
from ..sources.files import gbk_lines
from ..sources.parsers import parse_quote_lines
from ..sources.sinks import (
    current_version, drop_old_versions, drop_unused_parts, next_versions, read_table, read_version,
    remove_path, table_parts, touched_partitions, write_parts, write_version,
)

#: Where streams keep state that grows with the rows: on disk, changes written batch by batch.
_STORE = "spark.sql.streaming.stateStore"
DISK_STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
#: Channel of those who want all codes.
EVERYTHING = "*"


def poll_of(path: Column) -> Column:
    """Poll number out of a path such as ``.../poll17.txt`` or ``.../poll=17/...``."""
    return F.regexp_extract(path, r"poll[_=]?(\d+)", 1).try_cast("bigint")


def stream_quotes(
    spark: SparkSession, path: str, encoding: str = "GBK", max_files: int | None = None
) -> DataFrame:
    """Landed quote files as a typed stream, with ``poll_id`` and ``event_time``."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if encoding.upper() == "GBK":
        schema = "path string, modificationTime timestamp, length bigint, content binary"
        lines = gbk_lines(reader.format("binaryFile").schema(schema).load(path))
        lines = lines.select(poll_of(F.col("path")).alias("poll_id"), "value")
    else:
        lines = reader.text(path).select(
            poll_of(F.col("_metadata.file_path")).alias("poll_id"), "value"
        )
    quotes = parse_quote_lines(lines)
    return quotes.withColumn("code", code_to_plain(F.col("code"))).withColumn(
        "event_time", F.try_to_timestamp("update_time", F.lit("yyyyMMddHHmmss"))
    )


def _newest(columns: Sequence[str]) -> Column:
    """Whole row of the latest update; the remaining columns settle exact ties."""
    first = ["update_time", "poll_id"]
    return F.max(F.struct(*first, *[c for c in columns if c not in first]))


def stream_latest(sdf: DataFrame, key: str = "code") -> DataFrame:
    """Current row per code. State is one row per code; run in complete or update mode."""
    rest = [c for c in sdf.columns if c != key]
    return sdf.groupBy(key).agg(_newest(rest).alias("q")).select(
        key, *[F.col("q")[c].alias(c) for c in rest]
    )


def stream_session_gate(sdf: DataFrame, ts: str = "event_time") -> DataFrame:
    """Drop quotes from outside the trading sessions, by their own time."""
    return sdf.filter(in_trading_session(F.col(ts)))


def stream_subscribe(sdf: DataFrame, subscriptions: DataFrame, key: str = "code") -> DataFrame:
    """Quotes by channel (sub_id): one copy per subscriber that wants the code, one for EVERYTHING.

    A subscription with a NULL code wants all codes. Such subscribers share the channel
    EVERYTHING, which carries each quote once; ``wildcard_subscribers`` lists them. So what is
    sent grows with the quotes, not with quotes times wildcard subscribers.
    """
    wanted = subscriptions.filter(F.col("code").isNotNull()).select(
        "sub_id", code_to_plain(F.col("code")).alias("__want")
    ).distinct()
    some = sdf.join(wanted, sdf[key] == wanted["__want"]).select("sub_id", *[sdf[c] for c in sdf.columns])
    return some.unionByName(sdf.select(F.lit(EVERYTHING).alias("sub_id"), *sdf.columns))


def wildcard_subscribers(subscriptions: DataFrame) -> DataFrame:
    """The subscribers (sub_id) of the channel EVERYTHING."""
    return subscriptions.filter(F.col("code").isNull()).select("sub_id").distinct()


def stream_dedup(
    sdf: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = ("code", "update_time"),
    ts: str = "event_time",
) -> DataFrame:
    """Suppress repeated identical polls inside the watermark.

    State is one row per quote, kept once, on the executors' disks: the session's streams use
    RocksDB from here on, so state takes bounded memory and a batch costs its own rows, while the
    default store copies the map of all keys for every batch. A poll has a quote once, so a key's copies in a
    batch are the batch's polls at most; they meet one row of state, however many they are.
    """
    for name, value in DISK_STATE.items():
        sdf.sparkSession.conf.set(name, value)
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_split_late(
    sdf: DataFrame, root: str, checkpoint: str, delay: str = "10 minutes", ts: str = "event_time"
) -> StreamingQuery:
    """Rows in time under ``root``/on_time, and those behind the watermark under ``root``/late with their reason.

    A watermark drops late rows unseen; here they are a table, to be looked at or merged by
    a repair. The mark of a batch is the latest event time of all batches before it, less the
    delay, and is stored with the batch, as a version; so a repeated batch is split as it was. A row without
    an event time is late, too. Every row of the input is in exactly one of the two tables.
    """
    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = current_version(spark, f"{root}/marks", below=batch_id)
        seen = None if before is None else spark.read.schema("mark timestamp").parquet(before).first()["mark"]
        mark = F.lit(seen).cast("timestamp")
        edge = mark - F.expr(f"INTERVAL {delay}")
        reason = F.when(F.col(ts).isNull(), "no event time").when(
            F.col(ts) < edge, F.concat(F.lit("behind "), F.date_format(edge, "yyyy-MM-dd HH:mm:ss"))
        )
        rows = batch.withColumn("reason", reason).persist()
        try:
            for name, part in (("on_time", rows.filter("reason is null").drop("reason")), ("late", rows.filter("reason is not null"))):
                part.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{name}/batch={batch_id}")
            newest = rows.agg(F.greatest(F.max(F.col(ts).cast("timestamp")), mark).alias("mark"))
            write_version(newest, f"{root}/marks", batch_id)
        finally:
            rows.unpersist()
        drop_old_versions(spark, f"{root}/marks")

    return run_available(sdf, checkpoint, split)


def run_available(
    sdf: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> StreamingQuery:
    """Process what has landed, batch by batch, then stop."""
    return (
        sdf.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )


def stream_snapshot_replace(sdf: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """The newest poll replaces the snapshot, so codes absent from it vanish.

    A poll may arrive in several batches and older polls may come late: of stored and new rows only
    those of the highest poll stay, each once. A row without a poll number is an error, for its
    file's name can't be placed.

    A batch is worked out once: its rows that aren't older than the snapshot are stored by poll. The
    highest poll's make a new snapshot, or they are added to the stored one as another part, so a poll of many
    batches isn't written again with each. Rows lie with their hash (``__hash``, which isn't in the
    stream's schema): of the stored rows only hashes are read, and the rows whose hash comes again, which are
    compared whole. A batch that brings nothing new leaves the snapshot as it is.
    """
    schema, first = sdf.schema, next_versions(sdf.sparkSession, root, checkpoint)
    names, hashed = schema.fieldNames(), StructType([*schema.fields]).add("__hash", "long")

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, first + batch_id
        stored, number = current_version(spark, root, below=version), F.col("poll_id")
        known = read_version(spark, root, hashed, below=version)
        have = None if stored is None else known.agg(F.max(number).alias("newest")).first()["newest"]
        held = f"{checkpoint}/held"
        try:
            rows = batch if have is None else batch.filter(number.isNull() | (number >= F.lit(have)))
            writer = rows.withColumn("__hash", F.xxhash64(*names)).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "static").partitionBy("poll_id").parquet(held)
            seen = spark.read.schema(hashed).parquet(held)
            polls = [r["poll_id"] for r in seen.select("poll_id").distinct().collect()]  # a number per poll of the batch
            if None in polls:
                raise ValueError(f"{seen.filter(number.isNull()).count()} quotes come from files without a poll number")
            if not polls and stored is not None:
                return
            newest = max(polls, default=None)
            fresh = seen.filter(number == F.lit(newest).cast("bigint")).select(*names, "__hash")
            added = have is not None and newest == have
            if added and not table_parts(spark, root, stored):  # it was written whole, without hashes
                whole = known.select(*names).withColumn("__hash", F.xxhash64(*names))
                fresh, added = fresh.unionByName(whole), False
            again = known.select("__hash").join(fresh.select("__hash"), "__hash", "left_semi").distinct()
            if added and not again.isEmpty():
                old = known.join(again, "__hash", "left_semi").select(*names, "__hash").withColumn("__old", F.lit(True))
                both = fresh.withColumn("__old", F.lit(False)).unionByName(old)
                once = both.groupBy(*names, "__hash").agg(F.bool_or("__old").alias("__old")).filter("not __old").drop("__old")
                if once.isEmpty():
                    return
            else:
                once = fresh.distinct()
            write_parts(
                once, root, "poll_id", replaced=[] if added else None, path=f"{root}/v={version:020d}", below=version, spread=False
            )
        finally:
            remove_path(spark, held)
        drop_unused_parts(spark, root)

    return run_available(sdf, checkpoint, replace)


def stream_industry(
    sdf: DataFrame, industry: DataFrame, root: str, checkpoint: str, default: str = "其他"
) -> StreamingQuery:
    """Industry averages of the latest quotes after every update."""
    first = next_versions(sdf.sparkSession, root, checkpoint)

    def publish(batch: DataFrame, batch_id: int) -> None:
        quotes = batch.withColumn("pct", pct_or_zero(F.col("change_pct")))
        joined = industry_join(quotes.select("code", "name", "pct"), industry, default)
        write_version(industry_average(joined, "industry", "pct"), root, first + batch_id)
        drop_old_versions(batch.sparkSession, root)

    return run_available(stream_latest(sdf), checkpoint, publish, mode="complete")


def stream_industry_changes(
    sdf: DataFrame, industry: DataFrame, root: str, checkpoint: str, default: str = "其他", buckets: int = 64
) -> StreamingQuery:
    """``stream_industry`` at the cost of the quotes that moved.

    Kept are each code's last quote, in buckets of its hash, and per industry the exact sum
    and count of its members' changes. A batch takes the old quotes of its codes out of the sums and puts
    the new ones in; only buckets with a moved code are written. Quotes, sums and averages are
    versions numbered by batch, made from those below it, so a repeated batch writes the
    same. A quote that isn't newer than the one kept changes nothing.
    """
    spark = sdf.sparkSession
    rest = [c for c in sdf.columns if c != "code"]
    quote = StructType([f for f in sdf.schema.fields])
    first = next_versions(spark, f"{root}/sums", checkpoint)
    sums_schema = "industry string, total decimal(38,9), members bigint"
    tail = [F.col(c) for c in ["update_time", "poll_id", *[c for c in rest if c not in ("update_time", "poll_id")]]]

    def members(quotes: DataFrame) -> DataFrame:
        named = quotes.select("code", "name", pct_or_zero(F.col("change_pct")).alias("pct"))
        joined = industry_join(named, industry, default)
        return joined.groupBy("industry").agg(
            F.sum(F.col("pct").cast("decimal(28,9)")).alias("total"), F.count(F.lit(1)).alias("members")
        )

    def change(batch: DataFrame, batch_id: int) -> None:
        session, version = batch.sparkSession, first + batch_id
        below = current_version(session, f"{root}/quotes", below=version)
        bucket = F.pmod(F.xxhash64("code"), F.lit(buckets)).cast("int")
        newest = batch.groupBy("code").agg(F.max(F.struct(*tail)).alias("q")).select("code", *[F.col("q")[c].alias(c) for c in rest])
        newest = newest.withColumn("bucket", bucket).persist()
        try:
            touched = [r[0] for r in newest.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
            held = read_version(session, f"{root}/quotes", quote, below=version)
            held = held.withColumn("bucket", F.lit(None).cast("int")) if "bucket" not in held.columns else held
            held = held.filter(F.col("bucket").isin(touched)).select("code", *rest, "bucket")
            both = held.withColumn("__new", F.lit(False)).unionByName(newest.withColumn("__new", F.lit(True)))
            last = both.groupBy("code", "bucket").agg(F.max(F.struct(*tail, "__new")).alias("q"))
            now = last.select("code", *[F.col("q")[c].alias(c) for c in rest], F.col("q")["__new"].alias("__new"), "bucket").persist()
            moved = now.filter("__new")
            old = held.join(moved.select("code"), "code", "left_semi")
            sums = [members(moved), members(old).select("industry", (-F.col("total")).alias("total"), (-F.col("members")).alias("members"))]
            stored = current_version(session, f"{root}/sums", below=version)
            if stored is not None:
                sums.append(session.read.schema(sums_schema).parquet(stored))
            total = reduce(DataFrame.unionByName, sums).groupBy("industry").agg(
                F.sum("total").cast("decimal(38,9)").alias("total"), F.sum("members").cast("bigint").alias("members")
            ).filter("members > 0")
            write_parts(
                now.drop("__new"), f"{root}/quotes", "bucket", ["code"], None if below is None else touched,
                f"{root}/quotes/v={version:020d}", below=version,
            )
            kept = write_version(total, f"{root}/sums", version)
            average = (F.col("total") / F.col("members")).cast("double")
            shown = session.read.schema(sums_schema).parquet(kept).select("industry", average.alias("avg_pct"), "members")
            write_version(shown.withColumn("tier", heat_tier(F.col("avg_pct"))), f"{root}/out", version)
            now.unpersist()
        finally:
            newest.unpersist()
        for name in ("sums", "out"):
            drop_old_versions(session, f"{root}/{name}")
        drop_unused_parts(session, f"{root}/quotes")

    return run_available(sdf, checkpoint, change)


def stream_bronze_to_silver(
    spark: SparkSession,
    source: str,
    schema: StructType,
    clean: Callable[[DataFrame], DataFrame],
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
) -> StreamingQuery:
    """New landed files, cleaned and added to a keyed table where their keys are unseen.

    With ``partition_by`` (a function of the keys) a batch is compared with the stored
    rows of its own partitions only.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch).persist()
        stored = read_table(batch.sparkSession, target, rows.schema)
        stored = touched_partitions(stored, rows, partition_by)
        new_rows(stored, rows, keys).write.mode("append").partitionBy(*partition_by).parquet(target)
        rows.unpersist()

    return run_available(reader.parquet(source), checkpoint, merge)


__all__ = [
    "QUOTE_FIELDS", "poll_of", "run_available", "stream_bronze_to_silver", "stream_dedup",
    "stream_industry", "stream_industry_changes", "stream_latest", "stream_quotes", "stream_session_gate",
    "stream_snapshot_replace", "stream_split_late", "stream_subscribe", "wildcard_subscribers",
]
