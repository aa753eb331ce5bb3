"""Joins of bars, events, instruments and calendars.

No join carries a broadcast hint: Spark broadcasts a side when its estimated or, under
AQE, its measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
sort-merges with skewed partitions split at run time. All conditions are equalities, so
there is always such a way out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keep import keep_first, keep_last, without_keys


def merge_source_priority(
    primary: DataFrame, secondary: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """All primary rows plus the secondary rows whose key the primary lacks."""
    fill = secondary.join(primary.select(*keys), list(keys), "left_anti")
    return primary.unionByName(fill.select(*secondary.columns))


def merge_by_priority(
    sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key from any number of sources, the earliest listed source winning.

    A single aggregation over the union does the merge and the in-source dedup
    together: one shuffle, combined map-side, where the anti-join form needs one per side.
    """
    tagged = None
    for rank, source in enumerate(sources):
        part = source.withColumn("__rank", F.lit(rank))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    return keep_first(tagged, keys, ["__rank", *order]).drop("__rank")


def enrich_dimension(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Left join on a trimmed key; the right side is first reduced to its latest row."""
    trimmed = right.withColumn(key, F.trim(F.col(key).cast("string")))
    latest = keep_last(
        trimmed.select(key, *dict.fromkeys([*columns, *order])), [key], [*order, *columns]
    ).select(key, *columns)
    return left.withColumn(key, F.trim(F.col(key).cast("string"))).join(latest, key, "left")


def event_price_join(
    events: DataFrame, bars: DataFrame, keys: Sequence[str], price: str, date: str = "trade_date"
) -> DataFrame:
    """Corporate action with the price of the bar on the same instrument and day.

    Bars partitioned by ``year`` are met on it too, so that Spark prunes the partitions by
    the years of the events, which are few, before it reads any bar.
    """
    if "year" not in bars.columns or date not in keys:
        return events.join(bars.select(*keys, price), list(keys), "left")
    dated = events.withColumn("year", F.year(date))
    found = dated.join(bars.select(*keys, "year", price), [*keys, "year"], "inner").drop("year")
    priced = found.select(*keys, price)
    return events.join(priced, list(keys), "left")


def reference_calendar(
    bars: DataFrame, key: str, date: Column, reference: Sequence[str], name: str = "trade_date"
) -> DataFrame:
    """Trading days, taken from instruments that trade practically every day."""
    return bars.filter(F.col(key).isin(list(reference))).select(date.alias(name)).distinct()


def expected_calendar(
    instruments: DataFrame,
    calendar: DataFrame,
    key: str,
    start: str,
    date: str = "trade_date",
    end: str | None = None,
) -> DataFrame:
    """Every (instrument, trading day) from the instrument's start day onwards.

    The range condition ``trade_date >= start`` would plan as a nested-loop join. Here
    each instrument emits its civil days up to the calendar's end and the calendar keeps
    the trading days through an equi semi-join, so the work stays proportional to the
    output (about 365/250 of it) and never depends on a broadcast. Instruments are few
    bytes but become many rows, so they are spread over all tasks before they multiply.
    """
    tasks = int(instruments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = calendar.select(F.max(date)).scalar()
    first = calendar.select(F.min(date)).scalar()
    stop = last if end is None else F.least(F.col(end), last)
    begin = F.greatest(F.col(start), first)
    spans = instruments.filter(F.col(start).isNotNull()).select(
        key, begin.alias("__begin"), stop.alias("__stop")
    )
    days = spans.filter("__begin <= __stop").repartition(tasks, key).select(
        key, F.explode(F.sequence("__begin", "__stop")).alias(date)
    )
    return days.join(calendar.select(date).distinct(), date, "left_semi").select(key, date)


def find_missing(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def semi_present(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys), keys, "left_semi")


def new_keys_only(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not stored; a stored NULL key makes a NULL key known."""
    return without_keys(batch, target, keys)


def marks_of(table: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, mark): each key's last time, one row per key."""
    return table.groupBy(key).agg(F.max(ts).alias("mark"))


def merge_marks(marks: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Marks after more rows: the later of a key's marks, so a table needn't be read again."""
    return marks_of(marks.select(key, "mark").unionByName(more.select(key, "mark")), key, "mark")


def newer_than_marks(batch: DataFrame, marks: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows later than their key's mark; keys without one stay whole."""
    known = marks.select(key, F.col("mark").alias("__mark"))
    return (
        batch.join(known, key, "left")
        .filter(F.col("__mark").isNull() | (F.col(ts) > F.col("__mark")))
        .select(*batch.columns)
    )


def newer_than_watermark(
    batch: DataFrame, target: DataFrame, key: str, ts: str
) -> DataFrame:
    """Rows later than the target's last row of the same key; unseen keys stay whole.

    The target is read as a whole for that; where it grows by batches, keep its marks
    (``merge_marks``) and use ``newer_than_marks``.
    """
    return newer_than_marks(batch, marks_of(target, key, ts), key, ts)


def industry_join(
    quotes: DataFrame,
    industry: DataFrame,
    default: str,
    code: str = "code",
    name: str = "name",
) -> DataFrame:
    """Quotes with their industry; unmatched ones get ``default`` and keep their own name."""
    lookup = industry.groupBy(F.col("code").alias(code)).agg(
        F.max(F.struct("industry", "name")).alias("__hit")
    )
    joined = quotes.join(lookup, code, "left")
    hit = F.col("__hit")
    return joined.select(
        *[c for c in quotes.columns if c != name],
        F.when(hit.isNull(), F.col(name)).otherwise(hit["name"]).alias(name),
        F.coalesce(hit["industry"], F.lit(default)).alias("industry"),
    )


def factor_asof(
    bars: DataFrame,
    events: DataFrame,
    key: str,
    date: str,
    factor: str = "single_factor",
    after: str | None = "factor_after",
    upto: str | None = "factor_upto",
) -> DataFrame:
    """Product of event factors strictly after, and up to, each bar's date.

    Events are appended as rows of their own, so events on days without a bar count, and
    a range frame over the date yields the products: one shuffle and no range join. An
    unknown factor counts as 1. Bars are unique per (key, date) and events are reduced to
    one per (key, date), which bounds a window group by the number of civil days.
    """
    marks = (
        events.groupBy(key, date)
        .agg(F.product(F.coalesce(F.col(factor), F.lit(1.0))).alias("__factor"))
        .withColumn("__bar", F.lit(False))
    )
    rows = bars.withColumn("__bar", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    per_key = Window.partitionBy(key)
    day = F.unix_date(F.col(date))  # whole days, so that a frame can end one day away
    extra = {}
    if after:
        frame = per_key.orderBy(day.desc()).rangeBetween(Window.unboundedPreceding, -1)
        extra[after] = F.coalesce(F.product("__factor").over(frame), F.lit(1.0))
    if upto:
        frame = per_key.orderBy(day).rangeBetween(Window.unboundedPreceding, 0)
        extra[upto] = F.coalesce(F.product("__factor").over(frame), F.lit(1.0))
    return rows.withColumns(extra).filter("__bar").drop("__bar", "__factor")
