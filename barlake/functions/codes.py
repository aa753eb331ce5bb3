"""Instrument codes: plain six digits versus exchange-prefixed, and universe filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "code_to_plain", "strip_exchange", "code_to_prefixed", "code_to_prefixed_lookup",
    "is_a_share", "is_index", "filter_a_share", "filter_index", "route_source",
]


def code_to_plain(code: Column) -> Column:
    """``sh600519`` -> ``600519``; anything but an eight-character prefixed code is kept."""
    return F.when(
        (F.length(code) == 8) & code.rlike("^s[hz]"), F.substring(code, 3, 6)
    ).otherwise(code)


def strip_exchange(code: Column) -> Column:
    """Drop a leading sh/sz whatever follows it."""
    return F.regexp_replace(code, "^s[hz]", "")


def code_to_prefixed(code: Column) -> Column:
    """Prefix six-digit A-share codes with their exchange; other values pass through."""
    board = F.when(code.rlike("^[0-9]{6}$"), F.substring(code, 1, 2))
    return (
        F.when(board.isin("00", "30"), F.concat(F.lit("sz"), code))
        .when(board.isin("60", "68"), F.concat(F.lit("sh"), code))
        .otherwise(code)
    )


def code_to_prefixed_lookup(code: Column) -> Column:
    """The wider rule used for lookups: 6 and 9 are Shanghai, all else Shenzhen."""
    return F.concat(F.when(code.rlike("^[69]"), "sh").otherwise("sz"), code)


def is_a_share(code: Column, market: Column) -> Column:
    board = F.substring(code, 1, 2)
    return ((market == "sz") & board.isin("00", "30")) | (
        (market == "sh") & board.isin("60", "68")
    )


def is_index(code: Column, market: Column) -> Column:
    return ((market == "sz") & code.startswith("399")) | (
        (market == "sh") & code.startswith("000")
    )


def filter_a_share(df: DataFrame, code: str = "code", market: str = "market") -> DataFrame:
    return df.filter(is_a_share(F.col(code), F.col(market)))


def filter_index(df: DataFrame, code: str = "code", market: str = "market") -> DataFrame:
    return df.filter(is_index(F.col(code), F.col(market)))


def route_source(df: DataFrame, code: str = "code", source: str = "source") -> DataFrame:
    """Which feed serves a code: plain digits the primary, sh/sz the secondary."""
    c = F.col(code)
    return df.withColumn(
        source,
        F.when(c.rlike("^[0-9]+$"), "primary").when(c.rlike("^s[hz]"), "secondary"),
    )
