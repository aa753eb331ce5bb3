"""Completeness of bars against a trading calendar, and coverage of landed tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import code_in_list
from .aggregates import bars_per_day, short_days
from .joins import expected_calendar, find_missing, reference_calendar, semi_present
from .windows import calendar_index, trading_day_offset


def completeness_report(
    instruments: DataFrame,
    bars: DataFrame,
    reference: Sequence[str],
    codes: Sequence[str] | DataFrame | None = None,
    key: str = "stock_code",
    date: str = "trade_date",
    start: str = "ipo_date",
) -> DataFrame:
    """Missing trading days per instrument since its listing.

    Complete instruments are left out. Instruments without a listing date but with bars
    come with NULLs and a note. ``expected_days`` is actual plus missing, where actual
    counts days off the calendar too. ``missing_dates`` holds at most one entry per
    calendar day.
    """
    calendar = reference_calendar(bars, key, F.col(date), reference, date)
    if codes is not None:
        instruments = code_in_list(instruments, key, codes)
        bars = code_in_list(bars, key, codes)
    days = bars.select(key, date)
    expected = expected_calendar(instruments, calendar, key, start, date)
    missing = (
        find_missing(expected, days, [key, date])
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("missing_count"),
            F.array_sort(F.collect_list(date)).alias("missing_dates"),
        )
    )
    actual = days.groupBy(key).agg(F.count(F.lit(1)).alias("actual_days"))
    listed = instruments.select(key, start)
    gaps = (
        listed.filter(F.col(start).isNotNull())
        .join(missing, key)
        .join(actual, key, "left")
        .withColumn("actual_days", F.coalesce(F.col("actual_days"), F.lit(0)))
        .withColumn("note", F.lit(None).cast("string"))
    )
    unknown = (
        listed.filter(F.col(start).isNull())
        .join(actual, key)
        .withColumns({
            "missing_count": F.lit(None).cast("bigint"),
            "missing_dates": F.lit(None).cast("array<date>"),
            "note": F.lit("no listing date"),
        })
    )
    return gaps.unionByName(unknown).select(
        key, start,
        (F.col("actual_days") + F.col("missing_count")).alias("expected_days"),
        "actual_days", "missing_count", "missing_dates", "note",
    )


def missing_ranges(
    spans: DataFrame,
    bars: DataFrame,
    calendar: DataFrame,
    key: str = "stock_code",
    date: str = "trade_date",
    start: str = "ipo_date",
    end: str | None = None,
) -> DataFrame:
    """(key, first_day, last_day, days): runs of trading days that a key has no bar on.

    ``spans`` has one row per key with the day it starts on and maybe the day it ends on, the
    calendar's last by default. Days are numbered by the calendar, and a run of missing days is the gap
    between the numbers of two bars that follow each other, or between a bar and an end
    of the span. So the work follows the bars there are, not the days there should be: a key
    that never traded is one row. Bars off the calendar or outside the span close no gap.
    A window group holds a key's trading days. Keys without a start are left out.
    """
    index = calendar_index(calendar, date)  # every civil day with the trading days up to it
    ranked = calendar.select(date).distinct().join(index, date)
    limits = calendar.agg(F.min(date).alias("__lo"), F.max(date).alias("__hi"))
    lo, hi = limits.select("__lo").scalar(), limits.select("__hi").scalar()
    begin = F.greatest(F.col(start), lo)
    stop = hi if end is None else F.least(F.col(end), hi)
    dated = spans.filter(F.col(start).isNotNull()).select(key, begin.alias("__begin"), stop.alias("__stop")).filter("__begin <= __stop")
    # numbers just outside the span, as if there were a bar
    rank = lambda name: index.select(F.col(date).alias(name), F.col("rank").alias(f"{name}_rank"))
    edges = (
        dated.withColumn("__before", F.date_sub("__begin", 1))
        .join(rank("__stop"), "__stop").join(rank("__before"), "__before", "left")
        .select(key, F.coalesce("__before_rank", F.lit(0)).alias("__from"), (F.col("__stop_rank") + 1).alias("__to"))
    )
    there = bars.select(key, date).join(ranked, date).select(key, "rank").distinct()
    within = there.join(edges, key).filter((F.col("rank") > F.col("__from")) & (F.col("rank") < F.col("__to"))).select(key, "rank")
    marks = within.union(edges.select(key, F.explode(F.array("__from", "__to")).alias("rank")))
    following = F.lead("rank").over(Window.partitionBy(key).orderBy("rank"))
    gaps = marks.withColumn("__next", following).filter(F.col("__next") - F.col("rank") > 1)
    day = lambda name, c: ranked.select(F.col("rank").alias(c), F.col(date).alias(name))
    return (
        gaps.select(key, (F.col("rank") + 1).alias("__first"), (F.col("__next") - 1).alias("__last"))
        .join(day("first_day", "__first"), "__first").join(day("last_day", "__last"), "__last")
        .select(key, "first_day", "last_day", (F.col("__last") - F.col("__first") + 1).cast("bigint").alias("days"))
    )


def daily_ranges(
    stock_map: DataFrame, daily: DataFrame, codes: Sequence[str] | DataFrame | None = None,
    reference: Sequence[str] = ("600000", "000001"),
) -> DataFrame:
    """The runs of days behind ``completeness_daily``, one row per run."""
    calendar = reference_calendar(daily, "stock_code", F.col("trade_date"), reference)
    if codes is not None:
        stock_map, daily = (code_in_list(df, "stock_code", codes) for df in (stock_map, daily))
    return missing_ranges(stock_map, daily, calendar)


def minute_ranges(
    minute: DataFrame, reference: str = "600000", codes: Sequence[str] | DataFrame | None = None,
    key: str = "stock_code", ts: str = "datetime",
) -> DataFrame:
    """Runs of days without minute bars, up to each instrument's last day.

    A requested code without any bar is one run over the whole calendar.
    """
    day = F.to_date(F.col(ts))
    calendar = reference_calendar(minute, key, day, [reference])
    checked = minute if codes is None else code_in_list(minute, key, codes)
    days = checked.select(key, day.alias("trade_date")).distinct()
    spans = days.groupBy(key).agg(F.max("trade_date").alias("__last"))
    if codes is not None:
        spans = _code_table(minute, codes, key).join(spans, key, "left")
    spans = spans.withColumns({
        "__first": calendar.select(F.min("trade_date")).scalar(),
        "__last": F.coalesce("__last", calendar.select(F.max("trade_date")).scalar()),
    })
    return missing_ranges(spans, days, calendar, key, start="__first", end="__last")


def _code_table(df: DataFrame, codes: Sequence[str] | DataFrame, key: str) -> DataFrame:
    """The distinct requested codes as a table (key)."""
    if not isinstance(codes, DataFrame):
        codes = df.sparkSession.createDataFrame([(c,) for c in codes], "code string")
    return codes.select(F.col(codes.columns[0]).alias(key)).filter(F.col(key).isNotNull()).distinct()


def completeness_daily(
    stock_map: DataFrame,
    daily: DataFrame,
    codes: Sequence[str] | DataFrame | None = None,
    reference: Sequence[str] = ("600000", "000001"),
) -> DataFrame:
    return completeness_report(stock_map, daily, reference, codes)


def completeness_minute(
    minute: DataFrame,
    reference: str = "600000",
    codes: Sequence[str] | DataFrame | None = None,
    key: str = "stock_code",
    ts: str = "datetime",
    min_bars: int = 240,
    listed: DataFrame | None = None,
    per_year: bool = False,
) -> DataFrame:
    """Missing days and short days of minute bars, with their distance in trading days.

    Missing are calendar days up to the instrument's (or the calendar's) last day.
    ``listed`` (key, ipo_date) adds a lower bound. A requested code without any bar is
    missing on every calendar day. ``per_year`` restarts calendar and last day each year
    and skips years the reference instrument lacks; the offset needs no restart, because
    both of its ends lie in the same year. ``daily_bars`` is NULL for a missing day.
    """
    def period(day: str) -> Column:
        return (F.year(day) if per_year else F.lit(0)).alias("__period")

    calendar = reference_calendar(minute, key, F.to_date(F.col(ts)), [reference])
    bounds = [F.min("trade_date").alias("__from"), F.max("trade_date").alias("__last")]
    periods = calendar.groupBy(period("trade_date")).agg(*bounds)
    checked = minute if codes is None else code_in_list(minute, key, codes)
    counts = bars_per_day(checked, key, ts).withColumn("__period", period("trade_date"))
    last = counts.groupBy(key, "__period").agg(F.max("trade_date").alias("latest"))
    if codes is None and per_year:
        spans = last.join(periods, "__period")
    elif codes is None:
        spans = last.withColumns(
            {name: calendar.select(bound).scalar() for name, bound in zip(("__from", "__last"), bounds)}
        ).filter(F.col("__from").isNotNull())
    else:
        listing = periods.agg(F.collect_list(F.struct("*"))).scalar()
        spans = (
            _code_table(minute, codes, key).withColumn("__p", F.explode(listing)).select(key, "__p.*")
            .join(last, [key, "__period"], "left")
            .withColumn("latest", F.coalesce("latest", "__last"))
        )
    if listed is not None:
        spans = (
            spans.join(listed.select(key, "ipo_date"), key, "left")
            .withColumn("__from", F.greatest("__from", "ipo_date"))
        )
    expected = expected_calendar(spans, calendar, key, "__from", end="latest")
    gone = find_missing(expected, counts, [key, "trade_date"]).withColumn(
        "bars", F.lit(None).cast("bigint")
    )
    short = short_days(counts, min_bars).select(key, "trade_date", "bars")
    found = (
        gone.select(key, "trade_date", "bars").unionByName(short)
        .withColumn("__period", period("trade_date"))
        .join(spans.select(key, "__period", "latest"), [key, "__period"])
    )
    return trading_day_offset(found, calendar, "trade_date", "latest").select(
        key,
        F.col("trade_date").alias("missing_date"),
        "offset",
        F.col("bars").alias("daily_bars"),
    )


@dataclass(frozen=True)
class Landed:
    """A landed table to check. Without a code column only its presence is checked."""

    name: str
    source: str
    df: DataFrame
    code: str | None = None
    expected: DataFrame | None = None  # one column of codes in this source's own form


def _arrived(table: Landed, day: Column, ts: str) -> DataFrame:
    start = day.cast("timestamp")
    return table.df.filter(
        (F.col(ts) >= start) & (F.col(ts) < F.date_add(day, 1).cast("timestamp"))
    )


def coverage_missing(tables: Sequence[Landed], day: Column, ts: str = "ingested_at") -> DataFrame:
    """(table, source, code) for every expected code that did not arrive that day."""
    parts = []
    for t in tables:
        if t.code is None:
            continue
        wanted = t.expected.select(F.col(t.expected.columns[0]).alias("code")).distinct()
        seen = _arrived(t, day, ts).select(F.col(t.code).cast("string").alias("code"))
        parts.append(
            wanted.join(seen, "code", "left_anti")
            .select(F.lit(t.name).alias("table"), F.lit(t.source).alias("source"), "code")
        )
    return reduce(DataFrame.unionByName, parts)


def coverage_by_table(tables: Sequence[Landed], day: Column, ts: str = "ingested_at") -> DataFrame:
    """Expected, present and missing code counts per table, with a status.

    Per-code tables are ``ok`` or ``gap``; bulk tables ``ok`` or ``missing``, any row of
    the day being enough. The missing codes themselves are the rows of
    :func:`coverage_missing`.
    """
    parts = []
    for t in tables:
        arrived = _arrived(t, day, ts)
        if t.code is None:
            n = F.col("present")
            parts.append(
                arrived.limit(1).agg(F.count(F.lit(1)).alias("present")).select(
                    F.lit(t.name).alias("table"), F.lit(t.source).alias("source"),
                    F.lit(1).cast("bigint").alias("expected"), n,
                    (1 - n).alias("missing"),
                    F.when(n > 0, "ok").otherwise("missing").alias("status"),
                )
            )
            continue
        wanted = t.expected.select(F.col(t.expected.columns[0]).alias("code")).distinct()
        seen = arrived.select(F.col(t.code).cast("string").alias("code")).distinct()
        both = wanted.withColumn("w", F.lit(True)).join(
            seen.withColumn("s", F.lit(True)), "code", "full"
        )
        absent = F.col("w") & F.col("s").isNull()
        parts.append(
            both.agg(
                F.count("w").alias("expected"),
                F.count("s").alias("present"),
                F.count_if(absent).alias("missing"),
            ).select(
                F.lit(t.name).alias("table"), F.lit(t.source).alias("source"),
                "expected", "present", "missing",
                F.when(F.col("missing") == 0, "ok").otherwise("gap").alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# ---- coverage as bitmaps ----------------------------------------------------------------


def _bits(numbers: Column) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(numbers)).alias("bits")


def code_bitmap(codes: DataFrame, numbers: DataFrame) -> DataFrame:
    """(bucket, bits) of a set of codes, by their numbers (code, number from 1, dense).

    A bucket stands for 32,768 numbers and is 4 KB. Codes without a number are left out.
    """
    known = codes.select(F.col(codes.columns[0]).alias("code")).join(numbers, "code")
    return known.groupBy(F.bitmap_bucket_number("number").alias("bucket")).agg(_bits(F.col("number")))


def day_bitmaps(df: DataFrame, code: str, ts: str, numbers: DataFrame) -> DataFrame:
    """(day, bucket, bits): which codes arrived on each day.

    Bits are set in every task before the shuffle, so it moves a bitmap per day, bucket and
    task, however many rows a day has. Stored, the bitmaps stand for the rows in any question of
    coverage: those of more rows, or of another day, are put together by ``merge_bitmaps``.
    """
    rows = df.select(F.col(code).cast("string").alias("code"), F.to_date(F.col(ts)).alias("day")).filter("day is not null")
    known = rows.join(numbers, "code")
    return known.groupBy("day", F.bitmap_bucket_number("number").alias("bucket")).agg(_bits(F.col("number")))


def merge_bitmaps(*bitmaps: DataFrame, by: Sequence[str] = ("day",)) -> DataFrame:
    """The union of bitmaps per ``by`` and bucket; with no ``by``, of all days together."""
    every = reduce(DataFrame.unionByName, bitmaps)
    return every.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_coverage(bitmaps: DataFrame, expected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, expected, present, missing and a status, from bitmaps alone.

    ``bitmaps`` has ``by``, bucket and bits, e.g. a month of stored day bitmaps, whose union says
    which codes arrived in it; ``expected`` (bucket, bits) are the codes there should
    be. Missing is what the union with the expected ones adds to those present.
    """
    groups, empty = bitmaps.select(*by).distinct() if by else None, F.lit(b"\0")
    wanted = expected.withColumnRenamed("bits", "wanted")
    there = merge_bitmaps(bitmaps, by=by)
    all_buckets = wanted
    if by:
        # the expected bitmap beside every group: a few buckets each
        listed = wanted.agg(F.collect_list(F.struct("bucket", "wanted")).alias("w")).scalar()
        all_buckets = groups.select(*by, F.inline(listed))
    both = there.join(all_buckets, [*by, "bucket"], "full")
    either = F.coalesce("bits", empty), F.coalesce("wanted", empty)
    rows = both.select(*by, "bucket", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), either[0].alias("bits")), F.struct(F.lit(1).alias("kind"), either[1].alias("bits")),
        F.struct(F.lit(2).alias("kind"), either[0].alias("bits")), F.struct(F.lit(2).alias("kind"), either[1].alias("bits")),
    )).alias("x")).select(*by, "bucket", "x.*")
    counted = rows.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    n = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    out = counted.groupBy(*by).agg(n(1).alias("expected"), n(0).alias("present"), (n(2) - n(0)).alias("missing"))
    return out.withColumn("status", F.when(F.col("missing") == 0, "ok").otherwise("gap"))


def present_without_start(
    instruments: DataFrame, bars: DataFrame, key: str = "stock_code", start: str = "ipo_date"
) -> DataFrame:
    """Instruments that cannot be checked: no listing date, yet they have bars."""
    return semi_present(instruments.filter(F.col(start).isNull()), bars, key)
