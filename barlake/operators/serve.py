"""Read queries. Predicates are on stored types, so they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import code_in_list
from ..schemas import PRICES
from .windows import change_pct, factor_steps, in_days, last_before, step_factor


def _plain(code: str) -> str:
    return code[2:] if len(code) == 8 and code[:2] in ("sh", "sz") else code


def _day(text: str):
    return F.lit(text).cast("date")


def stock_list(df: DataFrame, date: str | None = None) -> DataFrame:
    """Instruments listed on a day (all without one), by code."""
    if date is not None:
        day = _day(date)
        df = df.filter(
            (F.col("ipo_date") <= day)
            & (F.col("delist_date").isNull() | (F.col("delist_date") > day))
        )
    return df.orderBy("stock_code")


def stock_info(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col("stock_code") == _plain(code))


def _adjusted(bars: DataFrame, steps: DataFrame, start: str, end: str, fq: str) -> DataFrame:
    """Bars of a range of days in adjusted terms, from these days and the bar before.

    The previous close is the adjusted close of the bar before, so events on days without a
    bar count as well. The very first bar keeps its own previous close, adjusted like its prices.
    """
    if fq not in ("qfq", "hfq"):
        raise ValueError(f"unknown adjustment {fq!r}")
    inside = in_days(bars, "trade_date", start, end)
    prices = [c for c in [*PRICES, "pre_close"] if c in bars.columns]
    factor = F.col("factor_after") if fq == "qfq" else F.try_divide(F.lit(1.0), F.col("factor_upto"))
    rows = step_factor(inside, steps, start, end)
    if "pre_close" in bars.columns:
        before = last_before(bars, "stock_code", "trade_date", start, inside.select("stock_code").distinct())
        rows = rows.unionByName(step_factor(before, steps), allowMissingColumns=True)
    out = rows.withColumns({c: F.col(c) * factor for c in prices})
    if "pre_close" in bars.columns:
        # a window group holds a code's bars of the range, and the one before
        last = F.lag("close").over(Window.partitionBy("stock_code").orderBy("trade_date"))
        out = out.withColumn("pre_close", F.coalesce(last, F.col("pre_close")))
        if "change_pct" in bars.columns:
            out = out.withColumn("change_pct", change_pct(F.col("close"), F.col("pre_close")))
    return out.filter(F.col("trade_date") >= _day(start)).select(*bars.columns)


def daily(
    df: DataFrame,
    code: str,
    start: str,
    end: str,
    fq: str = "bfq",
    factors: DataFrame | None = None,
    steps: DataFrame | None = None,
) -> DataFrame:
    """One instrument's bars in an inclusive date range, raw or adjusted."""
    return daily_batch(df, [code], start, end, fq, factors, steps)


def daily_batch(
    df: DataFrame,
    codes: Sequence[str] | DataFrame,
    start: str,
    end: str,
    fq: str = "bfq",
    factors: DataFrame | None = None,
    steps: DataFrame | None = None,
) -> DataFrame:
    """Bars of several instruments in an inclusive date range, by code and date.

    A factor applies to bars of other dates, so adjustment needs the codes' factors of all
    dates, as ``steps`` (the stored step table, see ``factor_steps``) or as the ``factors``
    they come from. Of the bars only the range is read, and the one before it for the
    first previous close.
    """
    wanted = codes if isinstance(codes, DataFrame) else [_plain(c) for c in codes]
    bars = code_in_list(df, "stock_code", wanted)
    if fq == "bfq":
        return in_days(bars, "trade_date", start, end).orderBy("stock_code", "trade_date")
    if steps is None:
        if factors is None:
            raise ValueError("adjusted prices need the factor table")
        steps = factor_steps(code_in_list(factors, "stock_code", wanted))
    else:
        steps = code_in_list(steps, "stock_code", wanted)
    return _adjusted(bars, steps, start, end, fq).orderBy("stock_code", "trade_date")


def minute(df: DataFrame, code: str, date: str) -> DataFrame:
    """One instrument's minute bars of a day; the year predicate prunes partitions."""
    out = df.filter(F.col("stock_code") == _plain(code))
    if "year" in df.columns:
        out = out.filter(F.col("year") == int(date[:4])).drop("year")
    kind = df.schema["datetime"].dataType
    day = _day(date)
    return out.filter(
        (F.col("datetime") >= day.cast(kind))
        & (F.col("datetime") < F.date_add(day, 1).cast(kind))
    ).orderBy("datetime")


def adj_factor(df: DataFrame, code: str, start: str, end: str) -> DataFrame:
    return df.filter(
        (F.col("stock_code") == _plain(code))
        & F.col("trade_date").between(_day(start), _day(end))
    ).orderBy("trade_date")


def finance(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col("stock_code") == _plain(code)).orderBy(F.desc("report_date"))


def latest_document(
    df: DataFrame,
    codes: Sequence[str] | None = None,
    key: str = "stock_code",
    date: str = "trade_date",
) -> DataFrame:
    """Newest document per code. Texts are fetched by an equi-join on (code, date).

    The newest date per code is found on the two key columns alone, so the aggregation
    never moves a text.
    """
    if codes is not None:
        df = code_in_list(df, key, [_plain(c) for c in codes])
    newest = df.groupBy(key).agg(F.max(date).alias(date))
    return df.join(newest, [key, date], "left_semi")


def recent_runs(df: DataFrame, limit: int = 50) -> DataFrame:
    return (
        df.select("plan_id", "action", "status", "started_at", "finished_at")
        .orderBy(F.desc("started_at"), "plan_id").limit(limit)
    )


def run_steps(df: DataFrame, plan_id: str) -> DataFrame:
    return (
        df.filter(F.col("plan_id") == plan_id)
        .select("step_name", "seq", "status", "elapsed_ms", "rows", "failed", "failed_codes")
        .orderBy("seq")
    )
