"""Upkeep of landed tables, and the stored log of ingest runs."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.aggregates import dedup_latest_ties
from ..operators.upsert import upsert_update
from ..schemas import PLAN_LOG, STEP_LOG
from ..sources.sinks import (
    drop_old_versions, insert_new, measured, path_exists, read_version, remove_path, write_version,
)

# The business key of each landed table.
LANDED_KEYS = {
    "daily_primary": ["stock_code", "datetime"],
    "minute": ["stock_code", "datetime"],
    "xdxr": ["code", "year", "month", "day", "category"],
    "finance": ["code"],
    "daily_secondary": ["stock_code", "date"],
}


def dedup_landed(
    spark: SparkSession, bronze: str, keys: Mapping[str, Sequence[str]] = LANDED_KEYS, ts: str = "ingested_at"
) -> DataFrame:
    """Keep the latest landed rows per key of each table there is; (table, before, after, status).

    A table without stamps can't be reduced and is ``skipped``. The rows that stay are stored
    beside the table before they replace it. A driver lost while they do leaves them there,
    under ``dedup-...``.
    """
    counts = []
    for name, key in keys.items():
        path = f"{bronze}/{name}"
        if not path_exists(spark, path):
            continue
        landed = spark.read.parquet(path)
        if ts not in landed.columns:
            n = landed.count()
            counts.append((name, n, n, "skipped"))
            continue
        beside, seen = f"{bronze}/dedup-{name}-{time.time_ns()}", Observation()
        kept = dedup_latest_ties(landed, key, ts).observe(seen, F.count(F.lit(1)).alias("n"))
        kept.write.parquet(beside)
        before, after = landed.count(), measured(seen, "n")["n"]  # the first is in the files' footers
        if after < before:
            spark.read.schema(landed.schema).parquet(beside).write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).parquet(path)
        remove_path(spark, beside)
        counts.append((name, before, after, "done"))
    return spark.createDataFrame(counts, "table string, before bigint, after bigint, status string")


def append_intraday(df: DataFrame, path: str, day: str) -> int:
    """Add a day's intraday points (stock_code, time, ...), once per code, day and time."""
    dated = df.withColumn("trade_date", F.lit(day).cast("date"))
    return insert_new(dated, path, ["stock_code", "trade_date", "time"], ["trade_date"])


def save_plan(spark: SparkSession, root: str, plans: DataFrame) -> None:
    """Insert or replace rows of the plan log, by plan_id."""
    rows = plans.select(*[F.col(f.name).cast(f.dataType) for f in PLAN_LOG.fields])
    write_version(upsert_update(read_version(spark, root, PLAN_LOG), rows, ["plan_id"]), root)
    drop_old_versions(spark, root)


def save_steps(spark: SparkSession, root: str, steps: DataFrame) -> None:
    """Insert or replace rows of the step log, by plan and step.

    A step that is stored keeps its number; others get the next ones of their plan, in the
    order of their names. A plan has few steps, which bounds the window.
    """
    stored = read_version(spark, root, STEP_LOG)
    known = stored.select("plan_id", "step_name", F.col("seq").alias("__seq"))
    tops = stored.groupBy("plan_id").agg(F.max("seq").alias("__top"))
    fresh = Window.partitionBy("plan_id", F.col("__seq").isNull()).orderBy("step_name")
    rows = steps.drop("seq").join(known, ["plan_id", "step_name"], "left").join(tops, "plan_id", "left")
    number = F.coalesce("__seq", F.coalesce(F.col("__top") + 1, F.lit(0)) + F.row_number().over(fresh) - 1)
    rows = rows.withColumn("seq", number.cast("int"))
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in STEP_LOG.fields])
    write_version(upsert_update(stored, rows, ["plan_id", "step_name"]), root)
    drop_old_versions(spark, root)
