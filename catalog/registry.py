"""One registered query per operator: a Spark function and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixtures import Tables, with_fixtures

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with its SQL if there is one."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def joined(column: str | Column, sep: str = ",") -> Column:
    """An array as text, so that both engines compare it alike."""
    c = F.col(column) if isinstance(column, str) else column
    return F.array_join(c.cast("array<string>"), sep)
