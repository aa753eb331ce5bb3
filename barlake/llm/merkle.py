"""Merkle manifest of a dataset: a persistent tree that copies the path of each tampered leaf.

Leaves are the rows' digests. Every ``FANOUT`` consecutive nodes of a source become one node,
until one is left (the source's subroot); subroots become the root in the same way. Nodes are
held in aligned blocks of ``BLOCK`` positions, one row each, so a block is worked on without
its neighbours and a source of any size is many rows.

A tampered leaf makes a version of the tree. It shares every node with the first version but
for the leaf's ancestors, which are copied: first those inside the leaf's block, then, by the
siblings that blocks further up hand down, those of the upper blocks, up to the root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

FANOUT = 16
#: Two levels of the tree.
BLOCK = FANOUT * FANOUT
#: Columns of a row that its leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row is tampered with in the query where this divides the CRC-32 of its doc_id.
TAMPER = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SIBLINGS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts put together; inner digests count as their hex text."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: ``-`` for a null, else the UTF-8 byte count, ``:`` and the value."""
    spelled = []
    for field in fields:
        text = field.cast("string")
        spelled.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*spelled)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos (from 0) and n: their place in their ``tree`` and its number of leaves.

    Rows are cut into ranges of (tree, order) and numbered inside each; ranges are shifted by
    what lies before them. A tree of any size is many ranges, and so are equal rows, which
    are told apart by where they were read. Only counts by tree and range are brought together.
    """
    ranged = rows.withColumn("__id", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "__id")
    ranged = staged(ranged.withColumn("part", F.spark_partition_id()), "merkle-ranges")
    sizes = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("k"))
    own = Window.partitionBy("tree")
    before = F.sum("k").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("tree", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("k").over(own).alias("n"))
    local = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order, "__id"))
    numbered = ranged.withColumn("local", local).join(shifts, ["tree", "part"])
    return numbered.withColumn("pos", F.col("before") + F.col("local") - 1).drop("local", "before", "part", "__id")


def _parents(nodes: Column) -> Column:
    """The digests above an array of digests: of each FANOUT in a row, the last run maybe fewer."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * FANOUT + 1, F.lit(FANOUT)), "")))


def _blocks(nodes: DataFrame) -> DataFrame:
    """A row per block of (tree, pos, n, node): its members by position and its own levels.

    ``node`` is a struct whose field ``digest`` counts in the tree. level0 has the members' digests, level1
    and level2 what lies above them in the block, as far as the tree reaches.
    """
    held = nodes.groupBy("tree", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("members")  # BLOCK at most
    )
    levels = held.withColumn("level0", F.transform("members", lambda m: m["node"]["digest"]))
    none = F.array().cast("array<string>")
    levels = levels.withColumn("level1", F.when(F.col("n") > 1, _parents(F.col("level0"))).otherwise(none))
    return levels.withColumn("level2", F.when(F.col("n") > FANOUT, _parents(F.col("level1"))).otherwise(none))


def _siblings(level: Column, at: Column) -> Column:
    """What stands left and right of the node at place ``at`` in its run."""
    first = at - at % FANOUT
    after = F.greatest(F.least(first + FANOUT, F.size(level)) - at - 1, F.lit(0))
    return F.struct(
        F.array_join(F.slice(level, first + 1, at % FANOUT), "").alias("left"),
        F.array_join(F.slice(level, at + 2, after), "").alias("right"),
    )


def _inner_path(i: Column) -> Column:
    """Siblings on the way from member ``i`` of a block to the block's top."""
    none = F.array().cast(_SIBLINGS)
    one = F.when(F.col("n") > 1, F.array(_siblings(F.col("level0"), i))).otherwise(none)
    two = F.when(F.col("n") > FANOUT, F.array(_siblings(F.col("level1"), F.floor(i / FANOUT).cast("int")))).otherwise(none)
    return F.concat(one, two)


@dataclass(frozen=True)
class Tree:
    """Stored blocks of every storey, lowest first, and the top (tree, digest) of every tree."""

    storeys: list[DataFrame]
    tops: DataFrame


def grow(nodes: DataFrame) -> Tree:
    """The trees over (tree, pos, n, node). Storeys are added until every tree has one node."""
    storeys = []
    while True:
        storey = staged(_blocks(nodes), "merkle-blocks")
        storeys.append(storey)
        top = F.when(F.col("n") == 1, F.col("level0")[0]).when(F.col("n") <= FANOUT, F.col("level1")[0]).otherwise(F.col("level2")[0])
        tops = storey.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.struct(top.alias("digest")).alias("node"))
        if storey.filter(F.col("n") > BLOCK).isEmpty():
            return Tree(storeys, tops.select("tree", F.col("node.digest").alias("digest")))
        nodes = tops


def block_paths(tree: Tree, above: DataFrame) -> DataFrame:
    """(tree, block, path): all siblings on the way from the top of a lowest block to the root.

    ``above`` (tree, path) leads from the top of each tree on. Paths are handed down from
    storey to storey; they have one row per block, never one per leaf.
    """
    paths = above.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for storey in reversed(tree.storeys[1:]):
        down = storey.join(paths, ["tree", "block"])
        own = F.transform("members", lambda m, i: F.struct(m["pos"].alias("block"), F.concat(_inner_path(i), F.col("path")).alias("path")))
        paths = down.select("tree", F.inline(own))
    return paths


def copied(start: Column, path: Column) -> Column:
    """The digests of a version's own nodes, from its leaf to its root.

    Each is the copy of an ancestor, made of the copy below and of siblings shared with the
    first version.
    """
    step = lambda made, s: F.concat(made, F.array(digest(s["left"], F.element_at(made, -1), s["right"])))
    return F.aggregate(path, F.array(start), step)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, tree, pos, n, leaf, subroot, root, proof_sha256, version and verified of every row.

    ``tampered`` (over the columns of ``docs``) says which rows to tamper with: their text's
    A-Z are lower-cased. version holds the digests from the row's leaf to the root as they
    are after that, and verified whether its root is still the dataset's.

    A null field counts as ``-``, so null and empty texts differ. Rows of a source stand in the order
    of doc_id, null first, and rows that share one in that of their leaves; equal rows have
    one leaf each and equal values all the way. A row without doc_id or text is a leaf like any
    other. The null source comes first, before the empty name. Other columns are ignored, and
    an empty table gives an empty result.
    """
    fields = [F.col(c) for c in FIELDS]
    lower = F.translate("text", _UPPER, _LOWER)
    spoiled = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),  # the null source sorts first
        leaf(fields).alias("leaf"),
        F.when(spoiled & (lower != F.col("text")), leaf([lower if c == "text" else F.col(c) for c in FIELDS])).alias("changed"),
    )
    leaves = placed(staged(rows, "merkle-leaves"), ["doc_id", "leaf"])  # texts are read once
    sources = grow(leaves.select("tree", "pos", "n", F.struct(F.col("leaf").alias("digest"), "doc_id", "changed").alias("node")))

    subroots = placed(sources.tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), ["source"])
    world = grow(subroots.select("tree", "pos", "n", F.struct("digest", "source").alias("node")))
    over = block_paths(world, world.tops.select("tree", F.array().cast(_SIBLINGS).alias("path")))
    lowest = world.storeys[0].join(over, ["tree", "block"])
    own = F.transform("members", lambda m, i: F.struct(
        m["node"]["source"].alias("tree"), m["node"]["digest"].alias("subroot"), F.concat(_inner_path(i), F.col("path")).alias("path")
    ))
    root = world.tops.select(F.col("tree").alias("world"), F.col("digest").alias("root"))
    above = lowest.select(F.col("tree").alias("world"), F.inline(own)).join(root, "world").drop("world")
    above = staged(above, "merkle-subroots")

    paths = block_paths(sources, above)
    filled = sources.storeys[0].join(paths, ["tree", "block"]).join(above.select("tree", "subroot", "root"), "tree")
    upper = F.transform("path", lambda s: F.concat(s["left"], s["right"]))

    def member(m: Column, i: Column) -> Column:
        inner = _inner_path(i)
        hashes = F.concat(F.transform(inner, lambda s: F.concat(s["left"], s["right"])), upper)
        return F.struct(
            m["node"]["doc_id"].alias("doc_id"), m["pos"].alias("pos"), m["node"]["digest"].alias("leaf"),
            digest(F.array_join(hashes, "")).alias("proof_sha256"),
            copied(F.coalesce(m["node"]["changed"], m["node"]["digest"]), F.concat(inner, F.col("path"))).alias("version"),
        )

    out = filled.select("tree", "n", "subroot", "root", F.inline(F.transform("members", member)))
    return out.withColumn("verified", F.element_at("version", -1) == F.col("root"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proofs and the check of every document, a fifth of them tampered with."""
    made = manifest(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0)
    return made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", F.element_at("version", -1).alias("folded_root"), "verified")


OP13_SQL = r"""
WITH RECURSIVE spelled AS (
  SELECT row_number() OVER () AS id, doc_id, source, text, concat(
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    list_reduce(list_prepend(4294967295::BIGINT, flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
      LAMBDA crc, step: CASE WHEN step >= 0 THEN xor(crc, step) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END) AS crc
  FROM documents),
leaves AS (
  SELECT id, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed FROM spelled),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT source, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT source, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1
  GROUP BY source, level, n, pos // 16),
subroots AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
             FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, n, pos // 16),
height AS (SELECT source, max(level) AS h FROM nodes GROUP BY source),
steps AS (
  SELECT p.id, x.level, string_agg(x.digest, '' ORDER BY x.pos) FILTER (WHERE x.pos < p.pos // (16 ** x.level)::BIGINT) AS l,
         string_agg(x.digest, '' ORDER BY x.pos) FILTER (WHERE x.pos > p.pos // (16 ** x.level)::BIGINT) AS r
  FROM placed p JOIN nodes x ON x.source IS NOT DISTINCT FROM p.source AND x.n > 1 AND x.pos // 16 = p.pos // (16 ** (x.level + 1))::BIGINT
  GROUP BY p.id, x.level
  UNION ALL
  SELECT p.id, h.h + x.level, string_agg(x.digest, '' ORDER BY x.pos) FILTER (WHERE x.pos < s.pos // (16 ** x.level)::BIGINT),
         string_agg(x.digest, '' ORDER BY x.pos) FILTER (WHERE x.pos > s.pos // (16 ** x.level)::BIGINT)
  FROM placed p JOIN height h ON h.source IS NOT DISTINCT FROM p.source JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  JOIN tops x ON x.n > 1 AND x.pos // 16 = s.pos // (16 ** (x.level + 1))::BIGINT
  GROUP BY p.id, h.h, x.level),
fold AS (
  SELECT id, 0 AS level, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.id, f.level + 1, sha256(concat(s.l, f.digest, s.r)) FROM fold f JOIN steps s ON s.id = f.id AND s.level = f.level),
proofs AS (SELECT id, sha256(string_agg(concat(l, r), '' ORDER BY level)) AS proof FROM steps GROUP BY id),
folded AS (SELECT id, max_by(digest, level) AS digest FROM fold GROUP BY id)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, coalesce(proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
       f.digest = t.digest AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
JOIN folded f ON f.id = p.id LEFT JOIN proofs ON proofs.id = p.id
"""
