"""Connected components of a table of links, at once or link by link."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, staged_rows

#: Links that a task reduces to a forest at a time.
FOREST_LINKS = 1 << 20


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a")
        .select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest id, id) that connect what the given links connect."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        p, q = root[x], root[y]
        if (p == q).all():
            break
        low, high = np.minimum(p, q), np.maximum(p, q)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(ids)))
    return ids[root[child]], ids[child]


def _forests(links: DataFrame) -> DataFrame:
    """The links of each task as forests: never more rows than the task has ids."""

    def made(parts) -> pa.RecordBatch:
        pair = forest(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in pair], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]):
        parts, held = [], 0
        for batch in batches:
            parts.append([batch.column(c).to_numpy() for c in ("a", "b")])
            held += batch.num_rows
            if held >= FOREST_LINKS:
                out = made(parts)
                if out.num_rows * 2 <= held:  # so many links on few ids: go on with their forest
                    parts, held = [[out.column(c).to_numpy() for c in ("a", "b")]], out.num_rows
                else:
                    yield out
                    parts, held = [], 0
        if held:
            yield made(parts)

    return links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").mapInArrow(run, "a long, b long")


def _settled(edges: DataFrame) -> bool:
    """True if every edge leads from the smallest id of a component to another of its ids."""
    ends = edges.select(F.col("b").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("a", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return seen.filter("below > 1 or (below = 1 and above = 1)").isEmpty()


def stars(links: DataFrame, small: int = FOREST_LINKS) -> DataFrame:
    """Stored (a, b): the smallest id a reachable from every other id b in ``links``.

    Links are counted as they are stored. Up to ``small`` of them, 16 bytes each, are one
    task's forest. More are reduced to a forest in every task; then large and small stars
    alternate until every id has one link. Links of a node are reduced by partial aggregates
    and joins, never gathered, so a node may have any number of them; the number of rounds
    grows with the logarithm of the longest path. Every round is stored in the shared folder.
    Self-links, repeated links and links in both directions do no harm.
    """
    stored, n = staged_rows(links.select("a", "b"), "links")
    if n <= small:
        return staged(_forests(stored.coalesce(1)), "links")
    edges = staged(_forests(stored).distinct(), "links")
    while not _settled(edges):
        edges = staged(_small_star(_large_star(edges)), "links")
    return edges


def components(links: DataFrame, small: int = FOREST_LINKS) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``links`` (a, b)."""
    edges = stars(links, small)
    members = edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return members.union(edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())


def told(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between ids as links between their components."""
    of = lambda end: labels.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    both = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))


def contracted(labels: DataFrame | None, links: DataFrame, small: int = FOREST_LINKS) -> DataFrame:
    """Labels (id, component) of ids that aren't their component's smallest, after more links.

    ``links`` are between components, so only components that they name are worked on; their
    stars then relabel. None stands for no labels so far, when every id is its own component.
    """
    moved = stars(links, small).select(F.col("b").alias("component"), F.col("a").alias("to"))
    if labels is None:
        return moved.select(F.col("component").alias("id"), F.col("to").alias("component"))
    old = labels.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return staged(old.union(moved.select("component", "to")), "labels")
