"""Data-quality rules. Every rule yields rows of one schema, ``ISSUE``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ISSUE


def _issue(
    df: DataFrame,
    level: str,
    table: str,
    message: Column,
    raw: Column,
    code: Column | None = None,
    date: Column | None = None,
    column: str = "",
) -> DataFrame:
    values = {
        "level": F.lit(level),
        "table": F.lit(table),
        "stock_code": F.lit("") if code is None else code,
        "trade_date": F.lit(None) if date is None else date,
        "column": F.lit(column),
        "message": message,
        "raw_value": raw,
    }
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in ISSUE.fields])


def issues_table(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def rejects_rule(rejects: DataFrame, table: str) -> DataFrame:
    """One warning with the number of rows the quality gate turned away."""
    n = F.col("n")
    counted = rejects.agg(F.count(F.lit(1)).alias("n")).filter(n > 0)
    return _issue(
        counted, "warning", table, _text("quality gate rejected ", n, " rows"), n
    )


def null_rule(df: DataFrame, table: str, column: str, level: str = "warning") -> DataFrame:
    """One issue with the number of NULLs of a column."""
    n, total = F.col("n"), F.col("total")
    counted = df.agg(
        F.count_if(F.col(column).isNull()).alias("n"), F.count(F.lit(1)).alias("total")
    ).filter(n > 0)
    return _issue(
        counted, level, table, _text(column, " is null in ", n, " of ", total, " rows"),
        _text(n, "/", total), column=column,
    )


def duplicate_rule(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One error with the number of keys that repeat."""
    n = F.col("n")
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    counted = groups.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    return _issue(
        counted, "error", table, _text(n, " duplicate groups of ", ", ".join(keys)), n
    )


def dq_stock_map(df: DataFrame, table: str = "silver.stock_map") -> DataFrame:
    """Missing listing date and name per code, and the coverage as an error."""
    code, n, total = F.col("stock_code"), F.col("n"), F.col("total")
    no_ipo = df.filter(F.col("ipo_date").isNull())
    no_name = df.filter(F.col("stock_name").isNull() | (F.col("stock_name") == ""))
    coverage = df.agg(
        F.count_if(F.col("ipo_date").isNull()).alias("n"), F.count(F.lit(1)).alias("total")
    ).filter(n > 0)
    pct = F.format_number(F.round(100 - n * 100.0 / total, 1), 1)
    return issues_table(
        _issue(no_ipo, "warning", table, _text("ipo_date missing for ", code), F.lit("NULL"),
               code=code, column="ipo_date"),
        _issue(no_name, "warning", table, _text("stock_name missing for ", code), F.lit("NULL"),
               code=code, column="stock_name"),
        _issue(coverage, "error", table,
               _text("finance covers ", total - n, "/", total, " (", pct, "%)"),
               _text(n, "/", total), column="ipo_date"),
    )


def dq_daily(df: DataFrame, rejects: DataFrame, table: str = "silver.daily_kline") -> DataFrame:
    return issues_table(
        rejects_rule(rejects, table), null_rule(df, table, "pre_close", "info")
    )


def dq_adj_factor(df: DataFrame, table: str = "silver.adj_factor") -> DataFrame:
    """NULL factors as a count, implausible ones (<= 0 or > 1.5) one by one."""
    f = F.col("single_factor")
    odd = df.filter((f <= 0) | (f > 1.5))
    return issues_table(
        null_rule(df, table, "single_factor"),
        _issue(odd, "warning", table, _text("implausible factor ", F.format_string("%.6f", f)),
               F.format_string("%.6f", f), code=F.col("stock_code"),
               date=F.col("trade_date"), column="single_factor"),
    )


def dq_minute(df: DataFrame, rejects: DataFrame, table: str = "silver.minute_kline") -> DataFrame:
    return issues_table(
        rejects_rule(rejects, table),
        duplicate_rule(df, table, ["stock_code", "datetime"]),
    )


def dq_keyed(df: DataFrame, table: str, column: str, keys: Sequence[str]) -> DataFrame:
    """NULLs of one column (warning) and repeated keys (error)."""
    return issues_table(null_rule(df, table, column), duplicate_rule(df, table, keys))


def dq_finance(df: DataFrame, table: str = "silver.finance") -> DataFrame:
    return dq_keyed(df, table, "report_date", ["stock_code", "report_date"])


def dq_doc(df: DataFrame, table: str = "silver.doc", column: str = "html") -> DataFrame:
    return dq_keyed(df, table, column, ["stock_code", "trade_date"])


def build_status(issues: DataFrame, rows: Column | int) -> DataFrame:
    """ok without errors, partial with errors but rows, else fail."""
    written = F.lit(rows) if isinstance(rows, int) else rows
    return issues.agg(
        F.count_if(F.col("level") == "error").alias("errors"),
        F.count_if(F.col("level") == "warning").alias("warnings"),
        F.count_if(F.col("level") == "info").alias("infos"),
    ).withColumn(
        "status",
        F.when(F.col("errors") == 0, "ok").when(written > 0, "partial").otherwise("fail"),
    )
