"""Aggregations. All are combined map-side; none collects an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import heat_tier
from ..session import work_dir
from .keep import keep_last


def merge_same_day_events(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    first: str,
    order: Sequence[str],
) -> DataFrame:
    """One event per key: amounts add up, the rights price is the first by ``order``."""
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min_by(first, F.struct(*order)).alias(first),
    )


def dedup_latest_ties(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows carrying their key's latest time stamp; ties survive.

    Rows with a NULL in the key or the time stamp are kept, as a row-value NOT IN would
    keep them. The latest stamp comes from an aggregate and an equi-join (split by AQE
    when a key is hot) instead of a ranking window that gathers a key in one task.
    """
    latest = df.groupBy(*keys).agg(F.max(ts).alias("__latest"))
    return (
        df.join(latest, list(keys), "left")
        .filter(
            F.col("__latest").isNull() | F.col(ts).isNull() | (F.col(ts) == F.col("__latest"))
        )
        .select(*df.columns)
    )


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_last(df, keys, order)


def distinct_keys(*frames: DataFrame, column: str) -> DataFrame:
    """Distinct values over one or several sources."""
    keys = frames[0].select(column)
    for frame in frames[1:]:
        keys = keys.union(frame.select(column))
    return keys.distinct()


def max_per_key(df: DataFrame, key: str, ts: str, name: str = "max_ts") -> DataFrame:
    return df.groupBy(key).agg(F.max(ts).alias(name))


def bars_per_day(df: DataFrame, key: str, ts: str, day: str = "trade_date") -> DataFrame:
    return df.groupBy(key, F.to_date(F.col(ts)).alias(day)).agg(
        F.count(F.lit(1)).alias("bars")
    )


def short_days(counts: DataFrame, min_bars: int = 240) -> DataFrame:
    return counts.filter(F.col("bars") < min_bars)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: NULLs and rows, measured in one pass and unpivoted afterwards."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot("total", list(columns), "column", "nulls").select(
        "column", "nulls", "total"
    )


def coverage_ratio(df: DataFrame, column: str) -> DataFrame:
    """Share of rows that have the column, in percent to one decimal."""
    return df.agg(
        F.count(column).alias("present"), F.count(F.lit(1)).alias("total")
    ).withColumn("pct", F.round(F.try_divide(F.col("present") * 100.0, F.col("total")), 1))


def freshness(df: DataFrame, ts: str, day: Column) -> DataFrame:
    """Whether the newest row is from the given day."""
    return df.agg(F.max(F.to_date(F.col(ts))).alias("last_date")).withColumn(
        "fresh", F.coalesce(F.col("last_date") == day, F.lit(False))
    )


def industry_members(df: DataFrame, group: str) -> DataFrame:
    """One row per member of an industry with its place by size of move, largest first.

    The main form: a reader takes the rows of the industries it shows. Ties follow code,
    name and change. Members are numbered in ranges of (industry, place) and shifted by the
    sizes of the industry's earlier ranges, so no task sorts a whole industry. Rows are stored
    before they are ranged, so that the sample of them doesn't work them out twice, and after it, so that all
    that follows sees the same ranges. Only the table of range sizes, a row for each range and
    industry in it, is windowed by industry.
    """
    spark, path, size = df.sparkSession, work_dir(df.sparkSession, "members"), F.abs(F.col("pct")).desc()
    rows = df.select(group, "code", "name", "pct")
    rows.write.parquet(f"{path}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    ranged = rows.repartitionByRange(group, size, "code", "name", "pct").withColumn("__range", F.spark_partition_id())
    ranged.write.parquet(f"{path}/ranged")
    cut = spark.read.schema(ranged.schema).parquet(f"{path}/ranged")
    earlier = Window.partitionBy("__group").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    shifts = cut.groupBy(F.col(group).alias("__group"), F.col("__range").alias("__at")).agg(F.count(F.lit(1)).alias("__n")).select(
        "__group", "__at", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift")
    )
    order = Window.partitionBy("__range", group).orderBy(size, "code", "name", "pct")
    placed = cut.withColumn("__place", F.row_number().over(order)).join(
        F.broadcast(shifts), (F.col("__range") == F.col("__at")) & F.col(group).eqNullSafe(F.col("__group"))
    )
    return placed.select(group, (F.col("__shift") + F.col("__place")).cast("int").alias("place"), "code", "name", "pct")


def industry_groups(df: DataFrame, group: str, part: Column | None = None) -> DataFrame:
    """Members of each industry as an array of (code, name, pct), largest move first.

    One row per (industry, part): ``part`` cuts an industry into pieces, so that a group
    holding much of the universe is never one array. The default is sixteen pieces by
    code; pass ``F.lit(0)`` for a single array where industries are known to be small.
    Use it on quotes reduced to one row per code; ``industry_members`` has no such bound.
    """
    pieces = F.pmod(F.xxhash64("code"), F.lit(16)) if part is None else part
    size = F.abs(F.col("pct"))
    ranked = F.array_sort(
        F.collect_list(F.struct((-size).alias("neg"), "code", "name", "pct"))
    )
    return (
        df.groupBy(group, pieces.alias("part"))
        .agg(ranked.alias("members"))
        .withColumn(
            "members",
            F.transform("members", lambda m: F.struct(m["code"], m["name"], m["pct"])),
        )
    )


def industry_average(df: DataFrame, group: str, pct: str) -> DataFrame:
    """Unweighted mean change and heat tier per industry, hottest first."""
    return (
        df.groupBy(group)
        .agg(F.avg(pct).alias("avg_pct"), F.count(F.lit(1)).alias("members"))
        .withColumn("tier", heat_tier(F.col("avg_pct")))
        .orderBy(F.desc("tier"), F.desc(F.abs(F.col("avg_pct"))), group)
    )
