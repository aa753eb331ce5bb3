"""Row-order operators: previous close, numbering, calendar offsets, adjusted prices."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PRICES
from ..session import work_dir
from .joins import factor_asof


def pre_close(
    df: DataFrame,
    key: str,
    date: str,
    close: str = "close",
    seed: DataFrame | None = None,
    chunk: str | None = None,
    name: str = "pre_close",
) -> DataFrame:
    """Close of the previous row of the same key.

    ``seed`` (key, seed_close) supplies the value before a key's first row, which is what
    makes an incremental build equal a full one.

    Bars unique per (key, date) bound a window group by the number of civil days. For
    finer series, where one key can hold a large share of all rows, ``chunk`` ('day',
    'month', ...) cuts each key into windows of that length and carries the last close
    of a chunk into the next one through a table of one row per (key, chunk).
    """
    if chunk is None:
        w = Window.partitionBy(key).orderBy(date)
        out = df.withColumn(name, F.lag(close).over(w))
    else:
        out = _chunked_lag(df, key, date, close, chunk, name)
    if seed is None:
        return out
    return (
        out.join(seed.select(key, "seed_close"), key, "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("seed_close")))
        .drop("seed_close")
    )


def _chunked_lag(
    df: DataFrame, key: str, date: str, close: str, chunk: str, name: str
) -> DataFrame:
    cut = df.withColumn("__chunk", F.date_trunc(chunk, F.col(date)))
    inside = Window.partitionBy(key, "__chunk").orderBy(date)
    local = cut.withColumns(
        {name: F.lag(close).over(inside), "__first": F.row_number().over(inside) == 1}
    )
    last = cut.groupBy(key, "__chunk").agg(F.max_by(close, date).alias("__last"))
    across = Window.partitionBy(key).orderBy("__chunk")
    carry = last.select(key, "__chunk", F.lag("__last").over(across).alias("__carry"))
    return (
        local.join(carry, [key, "__chunk"], "left")
        .withColumn(name, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col(name)))
        .select(*df.columns, name)
    )


def in_days(bars: DataFrame, date: str, first: str | None, last: str | None) -> DataFrame:
    """Bars of an inclusive range of days; partitions by ``year`` are pruned, row groups skipped."""
    out = bars
    for day, least in ((first, True), (last, False)):
        if day is not None:
            at = F.lit(day).cast("date")
            out = out.filter(F.col(date) >= at if least else F.col(date) <= at)
            if "year" in bars.columns:
                year = int(day[:4])
                out = out.filter(F.col("year") >= year if least else F.col("year") <= year)
    return out


#: Days before a range that are searched for the bar before it.
LOOKBACK = 31


def last_before(
    bars: DataFrame, key: str, date: str, day: str, wanted: DataFrame, close: str = "close", lookback: int = LOOKBACK
) -> DataFrame:
    """(key, date, close) of the last bar before ``day`` of each key in ``wanted``, if there is one.

    Nearly all keys have one in the days just before. Older bars are read for the others
    only: two columns and their keys, and not at all if there are none.
    """
    day_before = lambda n: (datetime.date.fromisoformat(day) - datetime.timedelta(days=n)).isoformat()
    columns = bars.select(key, date, close, *(c for c in ("year",) if c in bars.columns))
    last = lambda df: df.groupBy(key).agg(F.max_by(F.struct(date, close), date).alias("b")).select(key, f"b.{date}", f"b.{close}")
    near = last(in_days(columns, date, day_before(lookback), day_before(1)).join(wanted.select(key), key, "left_semi"))
    rest = wanted.select(key).join(near.select(key), key, "left_anti")
    if rest.isEmpty():
        return near
    return near.unionByName(last(in_days(columns, date, None, day_before(lookback + 1)).join(rest, key, "left_semi")))


def change_pct(close: Column, pre: Column) -> Column:
    return F.when(pre > 0, (close - pre) / pre * 100)


def surrogate_id(
    df: DataFrame,
    order: str,
    start: Column | int = 0,
    bucket: Column | None = None,
    name: str = "id",
) -> DataFrame:
    """Consecutive numbers in the order of a unique column, continuing after ``start``.

    Numbering runs inside order-preserving buckets and each bucket is shifted by the size
    of all earlier ones, so no task sees the whole table. By default the buckets are ranges
    of the whole column, as even as a sample of it makes them; the ranged table is stored, so
    that all that follows sees the same ranges. A given ``bucket`` must not decrease as
    ``order`` increases. Only the table of bucket sizes is brought together.
    """
    if bucket is None:
        spark, path = df.sparkSession, work_dir(df.sparkSession, "numbered")
        ranged = df.repartitionByRange(order).withColumn("__bucket", F.spark_partition_id())
        ranged.write.parquet(path)
        cut = spark.read.schema(ranged.schema).parquet(path)
    else:
        cut = df.withColumn("__bucket", bucket)
    sizes = cut.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift")
    )
    local = F.row_number().over(Window.partitionBy("__bucket").orderBy(order))
    base = F.lit(start) if isinstance(start, int) else start
    return (
        cut.withColumn("__rn", local)
        .join(shifts, "__bucket")
        .select(
            (base + F.col("__shift") + F.col("__rn")).cast("bigint").alias(name), *df.columns
        )
    )


def calendar_index(calendar: DataFrame, date: str = "trade_date") -> DataFrame:
    """Every civil day of the calendar's span with the number of trading days up to it.

    The calendar has one row per trading day (some ten thousand in forty years), so its
    sorted array is small by construction.
    """
    days = calendar.agg(F.array_sort(F.collect_set(date)).alias("days"))
    spans = days.select(
        F.posexplode("days").alias("i", "day"), F.size("days").alias("size"), "days"
    ).select(
        (F.col("i") + 1).alias("rank"),
        "day",
        F.coalesce(F.date_sub(F.get("days", F.col("i") + 1), 1), F.col("day")).alias("until"),
    )
    return spans.select(F.explode(F.sequence("day", "until")).alias(date), "rank")


def trading_day_offset(
    days: DataFrame,
    calendar: DataFrame,
    day: str,
    latest: str,
    date: str = "trade_date",
    name: str = "offset",
) -> DataFrame:
    """Number of trading days in (day, latest], through two equi-joins on a rank table."""
    index = calendar_index(calendar, date)
    first = calendar.select(F.min(date)).scalar()
    last = calendar.select(F.max(date)).scalar()
    ranked = days.withColumns(
        {"__d": F.least(F.col(day), last), "__l": F.least(F.col(latest), last)}
    )
    for side in ("__d", "__l"):
        ranked = ranked.join(
            index.select(F.col(date).alias(side), F.col("rank").alias(f"{side}_rank")),
            side,
            "left",
        )
    zero = F.lit(0)
    upper = F.when(F.col("__l") < first, zero).otherwise(F.col("__l_rank"))
    lower = F.when(F.col("__d") < first, zero).otherwise(F.col("__d_rank"))
    return ranked.withColumn(name, F.greatest(upper - lower, zero).cast("int")).select(
        *days.columns, name
    )


def single_factor(
    pre: Column, dividend: Column, price: Column, rights: Column, bonus: Column
) -> Column:
    """Ex-right reference price over the previous close; NULL where undefined."""
    return F.when(
        pre > 0,
        F.try_divide(pre - dividend + price * rights, pre * (1 + bonus + rights)),
    )


def factor_steps(
    events: DataFrame, key: str = "stock_code", date: str = "trade_date", factor: str = "single_factor"
) -> DataFrame:
    """(key, from, to, factor_after, factor_upto): cumulative factors as intervals of days.

    From one event to the day before the next the products of the factors after a day, and of
    those up to it, stay what they are. The first interval of a key has no ``from``, the
    last no ``to``. An unknown factor counts as 1, several on one day multiply. There is one
    row per event and one more per key, so the table stays as small as the events', and it
    serves any range of bars without their history.
    """
    once = events.filter(F.col(date).isNotNull()).groupBy(key, date).agg(
        F.product(F.coalesce(F.col(factor), F.lit(1.0))).alias("__f")
    )
    starts = once.select(key, F.lit(None).cast("date").alias(date), F.lit(1.0).alias("__f")).distinct()
    w = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_first())  # one event per day
    later = w.rowsBetween(1, Window.unboundedFollowing)
    return once.unionByName(starts).select(
        key, F.col(date).alias("from"), F.date_sub(F.lead(date).over(w), 1).alias("to"),
        F.coalesce(F.product("__f").over(later), F.lit(1.0)).alias("factor_after"),
        F.product("__f").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("factor_upto"),
    )


def update_steps(steps: DataFrame, events: DataFrame, codes: DataFrame, key: str = "stock_code") -> DataFrame:
    """The step table after the events of some codes changed: only those are worked out anew."""
    listed = codes.select(F.col(codes.columns[0]).alias(key)).distinct()
    anew = factor_steps(events.join(listed, key, "left_semi"), key)
    return steps.join(listed, key, "left_anti").unionByName(anew)


def step_factor(
    bars: DataFrame, steps: DataFrame, first: str | None = None, last: str | None = None,
    key: str = "stock_code", date: str = "trade_date",
) -> DataFrame:
    """Bars with the factor_after and factor_upto of the step they lie in.

    With the days ``first`` and ``last`` of the range all bars are of, steps are cut to it
    and repeated for each of its years they reach into, and meet bars on key and year. Without, they
    meet on the key: for a few bars of each. Either is an equi-join, and a bar lies in
    exactly one of its key's steps; 1 stands for a key without events.
    """
    at, same = F.col(f"b.{date}"), F.col(f"b.{key}") == F.col(f"s.{key}")
    starts, ends = F.col("s.from").isNull() | (at >= F.col("s.from")), F.col("s.to").isNull() | (at <= F.col("s.to"))
    rows = bars
    if first is not None:
        lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
        steps = steps.filter((F.col("from").isNull() | (F.col("from") <= hi)) & (F.col("to").isNull() | (F.col("to") >= lo)))
        years = F.sequence(F.year(F.greatest("from", lo)), F.year(F.least("to", hi)))
        steps = steps.withColumn("__year", F.explode(years))
        rows = bars.withColumn("__year", F.year(date))
        same = same & (F.col("b.__year") == F.col("s.__year"))
    met = rows.alias("b").join(steps.alias("s"), same & starts & ends, "left")
    factors = [F.coalesce(F.col(f"s.{c}"), F.lit(1.0)).alias(c) for c in ("factor_after", "factor_upto")]
    return met.select(*[F.col(f"b.{c}") for c in bars.columns], *factors)


def adjust_forward(
    bars: DataFrame,
    factors: DataFrame,
    key: str = "stock_code",
    date: str = "trade_date",
    prices: Sequence[str] = tuple(PRICES),
    factor: str = "single_factor",
) -> DataFrame:
    """Prices times the product of all later factors: the latest bar stays as traded."""
    scaled = factor_asof(bars, factors, key, date, factor, after="adj", upto=None)
    return scaled.withColumns({c: F.col(c) * F.col("adj") for c in prices})


def adjust_backward(
    bars: DataFrame,
    factors: DataFrame,
    key: str = "stock_code",
    date: str = "trade_date",
    prices: Sequence[str] = tuple(PRICES),
    factor: str = "single_factor",
) -> DataFrame:
    """Prices over the product of all factors so far: the first bar stays as traded."""
    scaled = factor_asof(bars, factors, key, date, factor, after=None, upto="adj")
    scaled = scaled.withColumn("adj", F.try_divide(F.lit(1.0), F.col("adj")))
    return scaled.withColumns({c: F.col(c) * F.col("adj") for c in prices})
