"""Set operations on rows and keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import distinct_keys


def union_aligned(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column one source lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_markets(markets: dict[str, DataFrame | None], tag: str = "market") -> DataFrame:
    """Per-exchange lists under one tag column; an absent exchange is skipped."""
    present = [df.withColumn(tag, F.lit(m)) for m, df in markets.items() if df is not None]
    return union_aligned(*present)


def union_keys(*frames: DataFrame, column: str) -> DataFrame:
    return distinct_keys(*frames, column=column).orderBy(column)


def except_keys(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(present.select(*keys), list(keys), "left_anti")
