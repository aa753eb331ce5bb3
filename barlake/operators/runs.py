"""Follow-up work derived from the accumulated ingest-result log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import code_to_prefixed
from .windows import calendar_index

MAX_ROUNDS = 2


def _short(table):
    return F.element_at(F.split(table, r"\."), -1)


def match_rules(df: DataFrame, rules: DataFrame, table: str = "table") -> DataFrame:
    """First matching rule per row: rules(pattern, kind, target, priority).

    ``kind`` is 'exact', 'prefix' or 'exclude'. The rules are turned into equi-join keys:
    every table name is probed with each of its own prefixes, whose number is the length
    of the name, so no condition is a scan of the rules per row. Names are reduced to the
    distinct ones first.
    """
    names = df.select(table).distinct().withColumn("__short", _short(F.col(table)))
    probes = names.select(
        table, "__short",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("__short")),
                lambda n: F.substring(F.col("__short"), F.lit(1), n),
            )
        ).alias("pattern"),
    )
    whole = F.col("pattern") == F.col("__short")
    hits = (
        probes.join(rules, "pattern")
        .filter(whole | (F.col("kind") == "prefix"))
        .groupBy(table)
        .agg(
            F.min_by(
                F.struct("kind", "target"),
                F.struct(F.col("kind") != "exclude", F.col("kind") != "exact", "priority"),
            ).alias("__hit")
        )
        .filter(F.col("__hit.kind") != "exclude")
        .select(table, F.col("__hit.target").alias("target"))
    )
    return df.join(hits, table, "left")


def route_targets(results: DataFrame, rules: DataFrame) -> DataFrame:
    """Ingest results with the table they feed; NULL when none."""
    return match_rules(results, rules)


def pending_targets(results: DataFrame, rules: DataFrame) -> DataFrame:
    """Tables to build: those fed by a result that brought rows."""
    useful = results.filter(F.col("status").isin("ok", "partial") & (F.col("rows") > 0))
    return route_targets(useful, rules).select("target").filter(
        F.col("target").isNotNull()
    ).distinct()


def error_codes(results: DataFrame) -> DataFrame:
    """(table, code) named by 'code: reason' errors; other errors name no code."""
    parts = results.select("table", F.explode("errors").alias("error")).filter(
        F.contains(F.col("error"), F.lit(":"))
    )
    code = F.trim(F.split(F.col("error"), ":").getItem(0))
    return parts.select("table", code.alias("code")).filter(
        F.col("code").rlike("^([0-9]+$|sh|sz)")
    )


def failed_codes(results: DataFrame, retry_rules: DataFrame | None = None) -> DataFrame:
    """Distinct failed codes per table, or per retry action when rules are given."""
    failed = results.filter(F.col("status").isin("partial", "fail"))
    found = error_codes(failed)
    if retry_rules is None:
        return found.select(_short(F.col("table")).alias("table"), "code").distinct()
    return (
        match_rules(found, retry_rules)
        .filter(F.col("target").isNotNull())
        .select(F.col("target").alias("table"), "code")
        .distinct()
    )


def retry_outcome(tried: DataFrame, failed: DataFrame, rounds: int = MAX_ROUNDS) -> DataFrame:
    """tried(table, code, round) -> outcome succeeded / retry / shelved."""
    again = failed.select("table", "code", F.lit(True).alias("__failed")).distinct()
    return tried.join(again, ["table", "code"], "left").select(
        "table", "code",
        F.when(F.col("__failed").isNull(), "succeeded")
        .when(F.col("round") < rounds, "retry")
        .otherwise("shelved").alias("outcome"),
        F.when(F.col("__failed").isNull(), F.col("round"))
        .otherwise(F.least(F.col("round") + 1, F.lit(rounds))).alias("round"),
    )


def backfill_worklist(
    report: DataFrame, tried: DataFrame | None = None, key: str = "stock_code", rounds: int = MAX_ROUNDS
) -> DataFrame:
    """Instruments with gaps that a backfill could close, with the round it would be.

    ``tried`` (key, round) lists the rounds made so far; an instrument is fetched ``rounds``
    times at most. Without it everything is in round 1.
    """
    gaps = report.filter(F.col("missing_count") > 0).select(key, "missing_count")
    if tried is None:
        return gaps.withColumn("round", F.lit(1))
    last = tried.groupBy(key).agg(F.max("round").alias("__last"))
    due = gaps.join(last, key, "left").withColumn("round", F.coalesce(F.col("__last"), F.lit(0)) + 1)
    return due.filter(F.col("round") <= rounds).select(key, "missing_count", "round")


def backfill_ranges(
    ranges: DataFrame, calendar: DataFrame, key: str = "stock_code", date: str = "trade_date", bridge: int = 0
) -> DataFrame:
    """(key, first_day, last_day, days): one request per row for the days of ``missing_ranges``.

    Runs with at most ``bridge`` trading days between them become one request; ``days`` counts the
    missing ones. A window group holds a key's runs.
    """
    rank = calendar_index(calendar, date)
    placed = ranges
    for day, name in (("first_day", "__a"), ("last_day", "__b")):
        placed = placed.join(rank.select(F.col(date).alias(day), F.col("rank").alias(name)), day)
    w = Window.partitionBy(key).orderBy("__a")
    near = F.col("__a") - F.lag("__b").over(w) <= bridge + 1
    heads = placed.withColumn("__head", F.when(near, 0).otherwise(1))
    parts = heads.withColumn("__part", F.sum("__head").over(w))
    return parts.groupBy(key, "__part").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("days").alias("days")
    ).drop("__part")


def repair_worklist(outcome: DataFrame, feeds: DataFrame) -> DataFrame:
    """(target, code) to rebuild after a retry: every table that a succeeded feed serves.

    ``outcome`` is that of ``retry_outcome``; ``feeds`` (table, target) may list several
    targets per feed, e.g. finance serves both statements and the instrument list.
    """
    done = outcome.filter(F.col("outcome") == "succeeded").select("table", "code")
    return done.join(feeds.select("table", "target"), "table").select("target", "code").distinct()


def heal_worklist(coverage: DataFrame, missing: DataFrame) -> DataFrame:
    """Work per table that is not ok: its missing codes in both code forms, or the table.

    A bulk table without codes yields one row with NULL codes: fetch it whole.
    """
    sick = coverage.filter(F.col("status") != "ok").select("table", "source")
    plain = F.regexp_replace("code", "^s[hz](?=.)", "")
    return sick.join(missing.select("table", "code"), "table", "left").select(
        "table", "source",
        plain.alias("plain_code"),
        code_to_prefixed(plain).alias("prefixed_code"),
    )


def step_errors(
    results: DataFrame, keys: Sequence[str] = ("plan_id", "step_name"), order: Sequence[str] = ("seq",)
) -> DataFrame:
    """Every error of every step, with its place in its result."""
    return results.select(*keys, *order, F.posexplode("errors").alias("pos", "error"))


def step_failed_codes(results: DataFrame, keys: Sequence[str] = ("plan_id", "step_name")) -> DataFrame:
    """Every code that a step's errors name, once."""
    return error_codes(results.withColumn("table", F.struct(*keys))).select(
        *[F.col("table")[k].alias(k) for k in keys], "code"
    ).distinct()


def run_step_rollup(
    results: DataFrame,
    keys: Sequence[str] = ("plan_id", "step_name"),
    order: Sequence[str] = ("seq",),
    max_errors: int = 50,
    max_codes: int = 100,
) -> DataFrame:
    """Step summary: sums, status, counts, and a preview of errors and failed codes.

    Nothing is lost: ``n_errors`` and ``n_failed_codes`` are true counts, and all of them are
    the rows of ``step_errors`` and ``step_failed_codes``. The previews are top-k; the rank
    filter lets Spark drop the surplus on the map side before the shuffle, so a step with
    millions of errors never meets in one task.
    """
    keys = list(keys)
    sums = results.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("failed").alias("failed"),
        F.sum("elapsed_ms").alias("elapsed_ms"),
        F.sum(F.coalesce(F.size("errors"), F.lit(0))).alias("n_errors"),
    )
    by_step = Window.partitionBy(*keys)
    lines = step_errors(results, keys, order)
    top = (
        lines.withColumn("rn", F.row_number().over(by_step.orderBy(*order, "pos", "error")))
        .filter(F.col("rn") <= max_errors)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("rn", "error"))).alias("errors"))
        .withColumn("errors", F.col("errors.error"))
    )
    named = step_failed_codes(results, keys)
    codes = (
        named.withColumn("rn", F.row_number().over(by_step.orderBy("code")))
        .filter(F.col("rn") <= max_codes)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("code")).alias("failed_codes"))
    )
    nothing = F.array().cast("array<string>")
    counts = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_failed_codes"))
    return (
        sums.join(top, keys, "left").join(codes, keys, "left").join(counts, keys, "left")
        .withColumns({
            "n_failed_codes": F.coalesce("n_failed_codes", F.lit(0)),
            "errors": F.coalesce("errors", nothing),
            "failed_codes": F.coalesce("failed_codes", nothing),
        })
        .withColumn(
            "status",
            F.when((F.col("failed") == 0) & (F.col("n_failed_codes") == 0), "ok").otherwise("partial"),
        )
    )
