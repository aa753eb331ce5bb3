"""Typing and cleaning expressions.

ANSI mode stays on; every conversion of landed text is a ``try_*`` so one bad cell
becomes NULL and never fails a task. NaN is mapped to NULL on the way in, because Spark
sorts NaN above every number and it would slip through the quality gate.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "numeric", "int_to_date", "ymd_to_date", "datetime_to_date", "text_to_timestamp",
    "coerce_numeric", "fill_zero", "lots_to_shares", "clean_volume",
    "per_ten_to_per_share", "gate_passes", "quality_gate", "project_silver",
    "rename_keys", "date_prefix_filter", "code_in_list", "in_trading_session",
    "trading_session_filter", "industry_label", "pct_or_zero", "heat_tier",
]


def numeric(value: Column, text: bool = True) -> Column:
    """Number or NULL. Text such as ``1.5d`` is a Java literal, not a number here."""
    parsed = value.try_cast("double")
    if text:
        parsed = F.when(~value.rlike(r"[dDfF]\s*$"), parsed)
    return F.nanvl(parsed, F.lit(None).cast("double"))


def int_to_date(value: Column) -> Column:
    """YYYYMMDD number to date; all but eight digits and impossible dates are NULL."""
    number = value.try_cast("bigint")
    eight = number.between(10_000_000, 99_999_999)
    return F.when(eight, F.try_to_date(number.cast("string"), "yyyyMMdd"))


def ymd_to_date(year: Column, month: Column, day: Column) -> Column:
    """Three number columns to date, NULL when they name no real day."""
    y, m, d = (part.try_cast("int") for part in (year, month, day))
    text = F.format_string("%04d-%02d-%02d", y, m, d)
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), text.try_cast("date"))


def datetime_to_date(value: Column) -> Column:
    return F.substring(value.cast("string"), 1, 10).try_cast("date")


def text_to_timestamp(value: Column) -> Column:
    """Exchange-local wall clock, hence a timestamp without time zone."""
    return value.try_cast("timestamp_ntz")


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: numeric(F.col(c), isinstance(kinds[c], T.StringType)) for c in columns}
    )


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def lots_to_shares(volume: Column) -> Column:
    return volume * 100


def clean_volume(volume: Column) -> Column:
    """NULL and sub-unit noise become 0, the rest truncates to a whole number."""
    return F.coalesce(F.when(volume >= 1, volume).try_cast("bigint"), F.lit(0).cast("bigint"))


def per_ten_to_per_share(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c) / 10 for c in columns})


def gate_passes(close: Column, high: Column, low: Column) -> Column:
    """The bar quality rule as a never-NULL boolean."""
    return F.coalesce((close > 0) & (high >= low), F.lit(False))


def quality_gate(
    df: DataFrame,
    close: str = "close",
    high: str = "high",
    low: str = "low",
    observation: Observation | None = None,
    date: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split bars into (kept, rejected); with ``date``, undated bars are rejected too.

    With an ``observation`` the reject count is measured while the kept rows are being
    written (metric ``rejected``), so no second pass over the input is needed.
    """
    ok = gate_passes(F.col(close), F.col(high), F.col(low))
    if date is not None:
        ok = ok & F.col(date).isNotNull()
    seen = df
    if observation is not None:
        seen = df.observe(
            observation,
            F.count(F.lit(1)).alias("read"),
            F.count_if(~ok).alias("rejected"),
        )
    return seen.filter(ok), df.filter(~ok)


def project_silver(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Keep-list projection; lineage and redundant columns never leave the scan."""
    return df.select(*keep)


def rename_keys(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def date_prefix_filter(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one day.

    A half-open range on the stored type instead of a LIKE, so min/max statistics can
    skip Parquet row groups for date, timestamp and ISO text columns alike.
    """
    kind = df.schema[column].dataType
    start = F.lit(day).cast("date")
    c = F.col(column)
    if isinstance(kind, T.StringType):
        upper = F.date_add(start, 1).cast("string")
        return df.filter((c >= F.lit(day)) & (c < upper))
    return df.filter((c >= start.cast(kind)) & (c < F.date_add(start, 1).cast(kind)))


def code_in_list(df: DataFrame, code: str, codes: Iterable[str] | DataFrame) -> DataFrame:
    """Rows of the listed codes: a left semi join, for a list and a DataFrame alike.

    Spark chooses its strategy (broadcast or sort-merge) from the measured size. The range
    of a given list is a filter of its own, which reaches the Parquet scan; for a single
    code that is the code itself.
    """
    if not isinstance(codes, DataFrame):
        listed = sorted(set(codes))
        if not listed:
            return df.filter(F.lit(False))
        df = df.filter(F.col(code).between(listed[0], listed[-1]))
        codes = df.sparkSession.createDataFrame([(c,) for c in listed], "code string")
    wanted = codes.select(F.col(codes.columns[0]).alias(code)).distinct()
    return df.join(wanted, code, "left_semi").select(*df.columns)


# Session bounds in seconds of the day, five minutes wider than trading.
SESSIONS = [(9 * 3600 + 25 * 60, 11 * 3600 + 35 * 60), (12 * 3600 + 55 * 60, 15 * 3600 + 5 * 60)]


def in_trading_session(ts: Column) -> Column:
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)
    inside = F.lit(False)
    for start, end in SESSIONS:
        inside = inside | clock.between(start, end)
    return (F.weekday(ts) < 5) & inside


def trading_session_filter(df: DataFrame, ts: str) -> DataFrame:
    return df.filter(in_trading_session(F.col(ts)))


def industry_label(label: Column) -> Column:
    """Drop a three-character class code (alphanumeric, not all letters) from longer labels."""
    return F.regexp_replace(
        label, r"^(?=(?s:.){4})(?=\p{L}{0,2}\p{N})[\p{L}\p{N}]{3}", ""
    )


def pct_or_zero(value: Column) -> Column:
    return F.round(F.coalesce(value.try_cast("double"), F.lit(0.0)), 2)


def heat_tier(pct: Column) -> Column:
    """Tier of the absolute change; NULL counts as no change."""
    size = F.abs(F.coalesce(pct, F.lit(0.0)))
    # fixed values
    tier = F.when(size >= 8, 5).when(size >= 6, 4).when(size >= 4, 3).when(size >= 2, 2).otherwise(1)
    return tier.cast("int")
