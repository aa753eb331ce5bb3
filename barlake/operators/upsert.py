"""Table maintenance without MERGE: each function returns the next version of a table.

The joins are on full primary keys or on a code list; the batch is reduced to one row
per key by a map-side combined aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keep import keep_any, keep_first, keep_last, without_keys


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """The batch rows an insert that ignores conflicts would add."""
    once = keep_first(batch, keys, order) if order else keep_any(batch, keys)
    return without_keys(once, target, keys).select(*batch.columns)


def upsert_ignore(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Stored rows win; only unseen keys are added."""
    return target.unionByName(new_rows(target, batch, keys, order), allowMissingColumns=True)


def upsert_update(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Batch rows win, the last by ``order`` within the batch."""
    once = keep_last(batch, keys, order) if order else keep_any(batch, keys)
    kept = without_keys(target, once, keys).select(*target.columns)
    return kept.unionByName(once, allowMissingColumns=True)


def replace_keys(
    target: DataFrame, rebuilt: DataFrame, key: str, codes: DataFrame | Sequence[str]
) -> DataFrame:
    """Delete the rows of the codes, then add the rebuilt rows of those codes.

    Codes are a table, however they are given: a list becomes one first.
    """
    if not isinstance(codes, DataFrame):
        codes = target.sparkSession.createDataFrame([(c,) for c in codes], "code string")
    listed = codes.select(F.col(codes.columns[0]).alias(key)).distinct()
    kept = target.join(listed, key, "left_anti").select(*target.columns)
    return kept.unionByName(rebuilt.join(listed, key, "left_semi").select(*rebuilt.columns))


def replace_row(log: DataFrame, row: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-or-replace on a log table."""
    return upsert_update(log, row, keys)
