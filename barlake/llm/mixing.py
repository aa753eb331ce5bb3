"""Mixing sources to target weights by thresholds on a hash of each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, staged, table

#: No document is taken more often than this.
MAX_REPEATS = 3
#: Weights of the sources in order of their names, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: Each level of refinement reads this many more bits of the hash.
LEVEL_BITS = 12
HASH_BITS = 60


def word_count(text: str) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = MAX_REPEATS
) -> DataFrame:
    """(source, source_size, target) from (source, size): ``share`` of all words by weight.

    A target stops at ``repeats`` times its source's size and the excess goes to the others
    by weight, until none is above. That is a common level times the weight, cut at the
    source's limit; the level follows from running sums over the sources in order of
    limit / weight. One row per source is all that is ever ordered as a whole.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * repeats
    per = per.withColumn("weight", w.cast("long")).withColumn("limit", limit)
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = per.select(
        "source", "source_size", "weight", "limit",
        (F.sum("source_size").over(whole) * F.lit(float(share))).alias("total"),
        F.coalesce(F.sum("limit").over(upto), F.lit(0)).alias("full"),
        F.sum("weight").over(rest).alias("open"),
    )
    # What a unit of weight gets were exactly the sources before this one cut at their limits.
    # It rises while they have to be cut and falls afterwards, so its maximum is the level.
    offer = (F.col("total") - F.col("full")) / F.col("open")
    target = F.least(F.col("limit").cast("double"), F.max(offer).over(whole) * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame, bits: int = LEVEL_BITS) -> DataFrame:
    """Per (source, budget) the hash below which the documents' sizes come nearest the amount.

    ``sized`` has source, size and a hash ``h`` in [0, 2**60); ``budgets`` has source, budget
    (a name) and amount. Sizes are summed by source and leading hash bits, a running sum
    finds the bucket in which the amount is reached, and only documents of that bucket are
    summed again by the next bits, until all bits are used. Budgets of one source are
    nested: a larger amount has a higher threshold over the same hash. A source without
    a boundary bucket (the amount covers all of it) gets 2**60.

    At the last level the bucket is one hash value: one document, or rows that repeat it. As
    many of them are taken as bring the sum nearest the amount: all or none by the
    threshold; else the hash is the ``edge``, and ``take`` rows are taken of it. Each level shuffles one row per
    source, map task and bucket.
    """
    zero = F.lit(0).cast("long")
    open_ = staged(
        budgets.select("source", "budget", F.col("amount").cast("double"), zero.alias("prefix"), zero.alias("below")),
        "mix-budgets",
    )
    for used in range(bits, HASH_BITS + 1, bits):
        shift = HASH_BITS - used
        bucket = F.shiftright("h", shift)
        parent = F.shiftright("h", shift + bits)
        rows = sized.select(F.col("source").alias("s"), "size", bucket.alias("bucket"), parent.alias("parent"))
        names = ["source", "budget", "amount", "prefix", "below"]
        met = rows.join(
            open_.select(*names), F.col("s").eqNullSafe(F.col("source")) & (F.col("parent") == F.col("prefix"))
        ).groupBy(*names, "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        # a budget that meets no documents has this row alone
        none = open_.select(*names, F.lit(None).cast("long").alias("bucket"), zero.alias("words"), zero.alias("rows"))
        upto = Window.partitionBy("source", "budget").orderBy("bucket")
        found = met.unionByName(none).withColumn("reach", F.col("below") + F.sum("words").over(upto))
        reached = F.col("bucket").isNotNull() & (F.col("reach") >= F.col("amount"))
        # the first bucket whose running sum reaches the amount, or one past the last bucket
        boundary = found.groupBy("source", "budget", "amount", "prefix").agg(
            F.min(F.when(reached, F.struct("bucket", (F.col("reach") - F.col("words")).alias("below"), "words", "rows"))).alias("at"),
            F.max("reach").alias("all"),
        )
        past = (F.col("prefix") + 1) * (1 << bits)
        open_ = staged(
            boundary.select(
                "source", "budget", "amount",
                F.coalesce(F.col("at.bucket"), past).alias("prefix"),
                F.coalesce(F.col("at.below"), F.col("all")).alias("below"),
                F.coalesce(F.col("at.words"), F.lit(0)).alias("words"), F.coalesce(F.col("at.rows"), F.lit(0)).alias("rows"),
            ),
            "mix-level",
        )
    share = (F.col("amount") - F.col("below")) / F.col("words") * F.col("rows")
    take = F.when(F.col("words") > 0, F.least(F.greatest(F.ceil(share - 0.5), F.lit(0)), F.col("rows"))).otherwise(F.lit(0))
    some = (F.col("take") > 0) & (F.col("take") < F.col("rows"))
    return open_.withColumn("take", take).select(
        "source", "budget",
        (F.col("prefix") + ((F.col("take") == F.col("rows")) & (F.col("rows") > 0)).cast("long")).alias("threshold"),
        F.when(some, F.col("prefix")).alias("edge"), F.when(some, F.col("take")).alias("take"),
    )


def hashed(docs: DataFrame) -> Column:
    """60 bits that depend on a document alone."""
    return F.shiftrightunsigned(F.xxhash64(docs["doc_id"], docs["text"]), 64 - HASH_BITS)


def source_cuts(sized: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Per source (as ``of``): its size and target, whole rounds, and the threshold of one more.

    Stored, so that Spark knows how small it is and sends it to the documents.
    """
    targets = staged(source_targets(sized, weights, share, repeats), "mix-targets")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("rounds", rounds.cast("long"))
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    found = thresholds(sized, plan.select("source", F.lit(0).alias("budget"), rest.alias("amount")))
    cuts = plan.alias("p").join(found.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        F.col("p.source").alias("of"), F.col("source_size").alias("of_size"), F.col("target").alias("of_target"),
        "rounds", "threshold", "edge", "take",
    )
    return staged(cuts, "mix-cuts")


def decided(rows: DataFrame, cuts: DataFrame, repeats: int) -> DataFrame:
    """``rows`` (with in_source and h) with their source's cuts and ``copies``.

    A row's copies follow from its own hash and the few numbers of its source, so rows are decided
    where they lie. Only where some of several rows with one hash are to be taken are these numbered: in
    each task, after those of the tasks before. Equal rows can't be told apart, so which are
    taken makes no difference.
    """
    met = rows.join(cuts, F.col("in_source").eqNullSafe(F.col("of")))
    more = lambda yes: F.col("rounds") + (yes & (F.col("rounds") < repeats)).cast("long")
    plain = met.withColumn("copies", more(F.col("h") < F.col("threshold")))
    if cuts.filter("edge is not null").isEmpty():
        return plain
    at_edge = F.coalesce(F.col("h") == F.col("edge"), F.lit(False))
    names = plain.columns
    key = F.coalesce(F.concat(F.lit("="), "of"), F.lit(""))
    edge = met.filter(at_edge).withColumns({"__s": key, "part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    edge = staged(edge, "mix-edge")
    # a source has one edge, so a group is at most what one task had read
    sizes = edge.groupBy("__s", "part").agg(F.count("*").alias("k"))
    upto = Window.partitionBy("__s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__s", "part", F.coalesce(F.sum("k").over(upto), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("__s", "part").orderBy("__id"))
    numbered = edge.withColumn("own", own).join(before, ["__s", "part"])
    numbered = numbered.withColumn("copies", more(F.col("before") + F.col("own") <= F.col("take")))
    return plain.filter(~at_edge).unionByName(numbered.select(*names))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = MAX_REPEATS
) -> DataFrame:
    """How often each document is taken, so that sources meet their targets.

    Returns doc_id, source, size (words), source_size, target, copies (0 to ``repeats``) and
    taken (size * copies). Whole rounds go to every document of a source; the rest of the
    target goes to the documents whose hash lies under the source's threshold. No document
    is ever sorted, and the same table gives the same mix on every run.

    Null text has size 0. Null sources are one source, the last. Null doc_ids are hashed by
    text alone. Rows equal in doc_id and text share the hash; at the threshold as many of
    them are taken as the target asks for. An empty table gives an empty result; other columns are ignored.
    """
    sized = staged(docs.select("doc_id", "source", word_count("text").alias("size"), hashed(docs).alias("h")), "mix-sizes")
    cuts = source_cuts(sized, weights, share, repeats)
    rows = decided(sized.withColumn("in_source", F.col("source")), cuts, repeats)
    return rows.select(
        "doc_id", "source", "size", F.col("of_size").alias("source_size"), F.col("of_target").alias("target"),
        "copies", (F.col("size") * F.col("copies")).alias("taken"),
    )


def taken_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, repeats: int = MAX_REPEATS
) -> DataFrame:
    """Every document as often as the mix takes it, with all its columns.

    Texts are filtered where they lie (``decided``).
    """
    sized = staged(docs.select("source", word_count("text").alias("size"), hashed(docs).alias("h")), "mix-sizes")
    cuts = source_cuts(sized, weights, share, repeats).select("of", "rounds", "threshold", "edge", "take")
    names = docs.columns
    row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs["source"].alias("in_source"), hashed(docs).alias("h"))
    kept = decided(row, cuts, repeats).select("row", F.col("copies").cast("int").alias("n"))
    repeated = kept.filter("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in names])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of all sources by weights 5, 2, 1."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
