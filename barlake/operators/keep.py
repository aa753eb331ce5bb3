"""One row per key without sorting groups.

``row_number`` sends every copy of a key to one task. The same choice as an aggregate
(``max_by`` / ``min_by`` over a struct of the row) is combined on the map side first, so
a key that holds a third of the input shrinks to one row per map task before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key_columns(df: DataFrame, keys: Sequence[str], pick: Column) -> DataFrame:
    kept = df.groupBy(*keys).agg(pick.alias("__kept"))
    return kept.select(
        *[F.col(c) if c in keys else F.col("__kept")[c].alias(c) for c in df.columns]
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return _key_columns(df, keys, F.max_by(payload, F.struct(*_named(order))))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the smallest ``order`` tuple per key."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    return _key_columns(df, keys, F.min_by(payload, F.struct(*_named(order))))


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen by the row's own values so that reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__kept"))
    return kept.select(
        *[F.col(c) if c in keys else F.col("__kept")[c].alias(c) for c in df.columns]
    )


def _named(order: Sequence[str | Column]) -> list[Column]:
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    return [c.alias(f"o{i}") for i, c in enumerate(columns)]


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; NULL equals NULL, as in a group."""
    known = other.select(*[F.col(k).alias(f"__known{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"__known{i}")) for i, k in enumerate(keys)]
    return df.join(known, same, "left_anti")
