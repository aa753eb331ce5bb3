"""Landed text to typed rows. Only built-in expressions, so parsing stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from ..schemas import KLINE_PAYLOAD, QUOTE_FIELDS


def _cell(i: int) -> Column:
    return F.get("cell", F.lit(i))


def parse_kline_json(
    df: DataFrame,
    code: str = "code",
    payload: str = "payload",
    ktype: str = "day",
    fq: str = "",
) -> DataFrame:
    """K-line responses to bars (date, prices, volume, amount, extra, stock_code).

    The series named adjustment + period is taken, else the first whose name ends in the
    period. The seventh cell is the amount, or an object that goes to ``extra``; an
    eighth cell may hold ``extra`` too. Responses with a non-zero code yield nothing.
    """
    body = F.from_json(F.col(payload), KLINE_PAYLOAD)
    series = F.try_element_at(F.col("__body.data"), F.col("stock_code"))
    ending = F.filter(
        F.map_entries("__series"), lambda e: e["key"].endswith(ktype) & e["value"].isNotNull()
    )
    chosen = F.coalesce(
        F.try_element_at(F.col("__series"), F.lit(f"{fq}{ktype}")),
        F.get(ending, F.lit(0))["value"],
    )
    rows = (
        df.select(F.col(code).alias("stock_code"), body.alias("__body"))
        .filter(F.col("__body.code") == 0)
        .select("stock_code", series.alias("__series"))
        .select("stock_code", F.explode(chosen).alias("cell"))
    )
    sixth, seventh = _cell(6), _cell(7)
    return rows.select(
        _cell(0).alias("date"),
        *[numeric(_cell(i)).alias(n)
          for i, n in ((1, "open"), (2, "close"), (3, "high"), (4, "low"), (5, "volume"))],
        F.when(~sixth.startswith("{"), numeric(sixth)).alias("amount"),
        F.when(seventh.startswith("{"), seventh)
        .otherwise(F.when(sixth.startswith("{"), sixth)).alias("extra"),
        "stock_code",
    )


def parse_quote_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """'~'-delimited quote lines to their named text columns; other columns are kept."""
    fields = F.split(F.trim(F.col(line)), "~")
    rest = [c for c in df.columns if c != line]
    return (
        df.filter(F.trim(F.col(line)) != "")
        .select(*rest, fields.alias("__f"))
        .select(*rest, *[F.get("__f", F.lit(i)).alias(n) for i, n in enumerate(QUOTE_FIELDS)])
    )


def parse_positional(
    df: DataFrame, n: int, line: str = "value", drop_blank: bool = True
) -> DataFrame:
    """'~'-delimited lines without names: columns c0 .. c(n-1)."""
    if drop_blank:
        df = df.filter(F.trim(F.col(line)) != "")
    rest = [c for c in df.columns if c != line]
    return df.select(*rest, F.split(F.trim(F.col(line)), "~").alias("__f")).select(
        *rest, *[F.get("__f", F.lit(i)).alias(f"c{i}") for i in range(n)]
    )


def parse_intraday(df: DataFrame, item: str = "item") -> DataFrame:
    """'time price volume amount' items, one per row; volume and amount stay cumulative."""
    rest = [c for c in df.columns if c != item]
    return (
        df.select(*rest, F.split(F.col(item), " ").alias("cell"))
        .filter(F.size("cell") >= 4)
        .select(
            *rest,
            _cell(0).alias("time"),
            *[numeric(_cell(i)).alias(n) for i, n in ((1, "price"), (2, "volume"), (3, "amount"))],
        )
    )


def parse_intraday_json(
    df: DataFrame, code: str = "code", payload: str = "payload"
) -> DataFrame:
    """Intraday responses {code, data: {code: {data: [item, ...]}}} to rows."""
    body = F.from_json(
        F.col(payload), "code int, data map<string, struct<data: array<string>>>"
    )
    items = (
        df.select(F.col(code).alias("stock_code"), body.alias("__body"))
        .filter(F.col("__body.code") == 0)
        .select(
            "stock_code",
            F.explode(
                F.try_element_at(F.col("__body.data"), F.col("stock_code"))["data"]
            ).alias("item"),
        )
    )
    return parse_intraday(items)
