"""Approximate nearest neighbours: a forest of random-projection trees and one queue for all of them."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_sample, per_batch, staged, table

TREES = 20
#: A node with no more sample vectors is a leaf.
LEAF = 64
#: The forest is fitted on about this many vectors; all vectors are indexed.
SAMPLE = 20_000
#: The search effort is set so that this share of true neighbours is found within the sample.
RECALL = 0.95
#: Vectors of a leaf that are compared at once.
BLOCK = 4096


@dataclass(frozen=True)
class Forest:
    """Trees over ``normals @ x < offsets``; a child below 0 is leaf ``-child - 1``."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: tuple[int, ...]
    leaves: int
    share: float

    def sides(self, x: np.ndarray) -> np.ndarray:
        return x @ self.normals.T - self.offsets if len(self.normals) else np.zeros((len(x), 0))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree; 256 vectors at a time meet all boundaries."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int32)
        for start in range(0, len(x), 256):
            side = self.sides(x[start : start + 256])
            for tree, root in enumerate(self.roots):
                at = np.full(len(side), root)
                while (inner := np.flatnonzero(at >= 0)).size:
                    node = at[inner]
                    at[inner] = np.where(side[inner, node] < 0, self.children[node, 0], self.children[node, 1])
                out[start : start + 256, tree] = -at - 1
        return out

    def visit(self, side: np.ndarray) -> Iterator[int]:
        """Leaves of all trees, nearest first: by the farthest boundary crossed on the way."""
        queue = [(0.0, root) for root in self.roots]
        heapq.heapify(queue)
        while queue:
            crossed, node = heapq.heappop(queue)
            while node >= 0:
                low = side[node] < 0
                near, far = self.children[node] if low else self.children[node][::-1]
                heapq.heappush(queue, (max(crossed, abs(side[node])), int(far)))
                node = int(near)
            yield -node - 1


def grow(x: np.ndarray, trees: int = TREES, leaf: int = LEAF, k: int = 10, recall: float = RECALL) -> Forest:
    """Fit a forest: nodes split at the median of a direction between two local means."""
    rng = np.random.default_rng(64)
    normals, offsets, children, leaves = [], [], [], 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            some = x[rng.choice(rows, min(len(rows), 256), replace=False)]
            a, b = some[0], some[1]
            for _ in range(3):
                nearer = ((some - a) ** 2).sum(axis=1) < ((some - b) ** 2).sum(axis=1)
                if nearer.all() or not nearer.any():
                    break
                a, b = some[nearer].mean(axis=0), some[~nearer].mean(axis=0)
            normal = (a - b) / max(np.linalg.norm(a - b), 1e-30)
            at = x[rows] @ normal
            cut = np.median(at)
            if (at < cut).any() and (at >= cut).any():
                node = len(normals)
                normals.append(normal)
                offsets.append(cut)
                children.append((0, 0))
                children[node] = (split(rows[at < cut]), split(rows[at >= cut]))
                return node
        leaves += 1
        return -leaves

    roots = tuple(split(np.arange(len(x))) for _ in range(trees)) if len(x) else ()
    shape = (len(normals), x.shape[1])
    forest = Forest(np.array(normals).reshape(shape), np.array(offsets), np.array(children).reshape(-1, 2), roots, leaves, 0.0)
    return Forest(**(vars(forest) | {"share": _effort(forest, x, k, recall)}))


def _effort(forest: Forest, x: np.ndarray, k: int, recall: float, queries: int = 200) -> float:
    """Rows to visit (repeats counted) as a share of all rows, so that ``recall`` of the k nearest are met."""
    if len(x) <= k + 1:
        return float(max(len(forest.roots), 1))
    member = forest.leaf_of(x)
    sizes = np.bincount(member.ravel(), minlength=forest.leaves)
    met = []
    for q in range(0, len(x), max(1, len(x) // queries)):
        away = ((x - x[q]) ** 2).sum(axis=1)
        away[q] = np.inf
        near = set(np.argpartition(away, k)[:k].tolist())
        homes = {}
        for i in near:
            for leaf in member[i]:
                homes.setdefault(int(leaf), []).append(i)
        rows = 0
        for leaf in forest.visit(forest.sides(x[q : q + 1])[0]):
            rows += sizes[leaf]
            for i in homes.get(leaf, ()):
                if i in near:
                    near.discard(i)
                    met.append(rows)
            if not near:
                break
    return float(np.quantile(met, recall)) / len(x)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows with an id and a finite vector that isn't zero.

    The embedding is normalised to array<double>, which floats convert to exactly. Vectors of
    another length than most (the smaller length, if two are as frequent) take no part.
    """
    e = F.col("embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), e.cast("array<double>").alias("embedding"))
    rows = rows.filter("vec_id is not null and embedding is not null").filter(
        F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows if usual is None else rows.filter(F.size("embedding") == usual["n"])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(node, embedding, ids): equal vectors once, with the k + 1 smallest of their ids in order.

    No more of equal vectors can be among the k nearest of any query. The rank filter is
    applied before the shuffle, so a vector that a third of all rows share stays small.
    """
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    first = rows.select("vec_id", "embedding").withColumn("r", rank).filter(F.col("r") <= k + 1)
    nodes = first.groupBy("embedding").agg(F.array_sort(F.array_distinct(F.collect_list("vec_id"))).alias("ids"))
    return nodes.select(F.monotonically_increasing_id().alias("node"), "embedding", "ids")


def _placed(nodes: DataFrame, forest: Forest) -> DataFrame:
    """(leaf, node, embedding, first) of every vector in every tree."""

    def run(batch: pa.RecordBatch):
        x = _matrix(batch.column("embedding"))
        leaves = forest.leaf_of(x)
        for tree in range(leaves.shape[1]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves[:, tree]), *(batch.column(c) for c in ("node", "embedding", "first"))],
                ["leaf", "node", "embedding", "first"],
            )

    return nodes.select("node", "embedding", F.element_at("ids", 1).alias("first")).mapInArrow(
        per_batch(run), "leaf int, node long, embedding array<double>, first long"
    )


def _sought(queries: DataFrame, forest: Forest, sizes: np.ndarray, rows: int) -> DataFrame:
    """(leaf, node, embedding): the leaves each query visits until it has met enough rows."""
    budget = forest.share * rows

    def run(batch: pa.RecordBatch):
        x = _matrix(batch.column("embedding"))
        leaf, row = [], []
        for i in range(len(x)):
            met = 0
            for at in forest.visit(forest.sides(x[i : i + 1])[0]):
                if sizes[at]:
                    leaf.append(at)
                    row.append(i)
                    met += sizes[at]
                if met >= budget:
                    break
        for start in range(0, len(leaf), 4096):
            take = pa.array(row[start : start + 4096], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[start : start + 4096], pa.int32()), batch.column("node").take(take), batch.column("embedding").take(take)],
                ["leaf", "node", "embedding"],
            )

    return queries.select("node", "embedding").mapInArrow(per_batch(run), "leaf int, node long, embedding array<double>")


def _nearest(k: int):
    """Over rows sorted by (leaf, block, kind): each query's k + 1 nearest vectors of a block.

    A block's vectors come first and are held, BLOCK of them or so; queries stream by.
    """

    def compare(held: list, queries: np.ndarray, ids: np.ndarray):
        vectors, nodes, first = (np.concatenate(x) for x in zip(*held))
        step = max(1, 4_000_000 // max(vectors.size, 1))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            away = np.sqrt(((part[:, None, :] - vectors[None, :, :]) ** 2).sum(axis=2))
            for i, row in enumerate(away):
                kept = np.arange(len(row))
                if len(row) > k + 1:
                    kept = np.flatnonzero(row <= np.partition(row, k)[k])
                kept = kept[np.lexsort((first[kept], row[kept]))[: k + 1]]
                yield ids[at + i], nodes[kept], row[kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.stack([batch.column(c).to_numpy() for c in ("leaf", "block", "kind")], axis=1).astype(np.int64)
            edges = np.flatnonzero(np.any(code[1:] != code[:-1], axis=1)) + 1
            x, node, first = _matrix(batch.column("embedding")), batch.column("node").to_numpy(), batch.column("first").to_numpy()
            found = []
            for start, stop in zip([0, *edges], [*edges, len(code)]):
                here, kind = tuple(code[start][:2]), code[start][2]
                if here != key:
                    key, held = here, []
                if kind == 0:
                    held.append((x[start:stop], node[start:stop], first[start:stop]))
                elif held:
                    found += compare(held, x[start:stop], node[start:stop])
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([q for q, _, _ in found], [len(n) for _, n, _ in found])),
                    pa.array(np.concatenate([n for _, n, _ in found])), pa.array(np.concatenate([d for _, _, d in found])),
                ], ["query", "node", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 10, trees: int = TREES, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest rows of each query row.

    Nearness is the Euclidean distance in double precision on the original vectors; ties go
    to the smaller vec_id. Candidates are all rows but those with the query's vec_id; fewer
    than k are all returned.

    The forest and the search effort are fitted on about ``sample`` vectors; every vector
    is put in a leaf of each tree. A query takes leaves of all trees from one queue until
    the rows met reach the fitted share, and their vectors are compared exactly. Equal
    vectors are one entry of the index and one search, with as many ids as can be returned.
    Large leaves are compared in blocks, so no task holds a whole one.

    Rows with a null id, or a vector that is null, zero, of unusual length, or with a null or
    non-finite component, take no part. Repeated rows count once. Empty tables give an empty
    result; other columns are ignored.
    """
    rows = staged(usable(vectors), "nn-rows")
    nodes = staged(distinct_vectors(rows, k), "nn-nodes")
    total = nodes.count()
    drawn = hash_sample(nodes.select("node", "embedding"), F.col("embedding"), sample).toArrow().sort_by("node")
    x = _matrix(drawn.column("embedding").combine_chunks()) if total else np.zeros((0, 1))
    forest = grow(x, trees=trees, k=k, recall=recall)
    placed = staged(_placed(nodes, forest), "nn-index")
    filled = staged(placed.groupBy("leaf").agg(F.count("*").alias("n")), "nn-leaves")  # as many rows as leaves
    sizes = np.zeros(max(forest.leaves, 1), dtype=np.int64)
    for r in filled.collect():
        sizes[r["leaf"]] = r["n"]
    asking = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    asked = staged(asking.join(nodes.select("node", "embedding"), "embedding").select("query_id", F.col("node").alias("query")), "nn-queries")
    queries = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
    cut = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), cut).cast("int").alias("block")
    held = placed.join(filled, "leaf").select("leaf", own, F.lit(0).alias("kind"), "node", "embedding", "first")
    every = F.explode(F.sequence(F.lit(0), cut - 1)).alias("block")
    sought = _sought(queries, forest, sizes, total).join(filled, "leaf").select("leaf", every, F.lit(1).alias("kind"), "node", "embedding")
    sought = sought.withColumn("first", F.lit(0).cast("long"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lined = held.unionByName(sought).repartition(parts, "leaf", "block").sortWithinPartitions("leaf", "block", "kind")
    near = lined.mapInArrow(_nearest(k), "query long, node long, score double").distinct()
    ids = nodes.select("node", "ids")
    by_query = Window.partitionBy("query").orderBy("score", F.element_at("ids", 1))
    best = near.join(ids, "node").withColumn("r", F.row_number().over(by_query)).filter(F.col("r") <= k + 1)
    hits = asked.join(best.select("query", "score", F.explode("ids").alias("vec_id")), "query").filter("vec_id <> query_id").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all vectors for every vector whose id is divisible by 100."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
