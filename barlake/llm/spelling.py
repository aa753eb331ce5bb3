"""Spelling variants: words one edit apart, found by asymmetric q-chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, staged_rows, table

#: Fixed values of the query: letters of a word, and the rule that plants misspellings.
LETTERS = r"A-Za-zÀ-ÿ"
PLANT = 199

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form has at least so many times its occurrences.
FORM_RATIO = 5
#: A chunk that brings more pairs of words together than this is split further first.
PAIRS = 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, plant: int | None = PLANT) -> DataFrame:
    """(word, n): the words of whole texts with at least that many code points and occurrences.

    Words are maximal runs of ``LETTERS``, A-Z lower-cased. With ``plant``, a run loses a code
    point where that number divides the CRC-32 of ``<doc_id>:<run>`` (a null doc_id is
    empty). Shorter runs can't become words and aren't looked at. Counts are summed in each
    task before they are shuffled.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{least_length},}}"), 0)
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    found = found.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if plant is not None:
        found = found.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "word")))
        at = (F.col("h") % F.length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        found = found.select(F.when(F.col("h") % plant == 0, less).otherwise(F.col("word")).alias("word"))
    counted = found.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice, by either half of what its key doesn't cover yet.

    A row stands for a word in one of its roles: ``chunked`` words of ``size`` code points are
    cut into two disjoint chunks, the others show the grams at the same places, counted from
    the start for the first chunk and from the end for the second. ``pre`` and ``suf`` are the
    code points at either end that the key says are equal.
    """
    q = F.floor((F.col("size") - F.col("pre") - F.col("suf")) / 2).cast("int")
    first = F.struct(
        F.xxhash64("key", F.lit(0), F.substring("word", F.col("pre") + 1, q)).alias("key"),
        (F.col("pre") + q).alias("pre"), F.col("suf"),
    )
    second = F.struct(
        F.xxhash64("key", F.lit(1), F.substring("word", F.length("word") - F.col("suf") - q + 1, q)).alias("key"),
        F.col("pre"), (F.col("suf") + q).alias("suf"),
    )
    cut = rows.withColumn("half", F.explode(F.array(first, second)))
    return cut.select("half.key", "chunked", "word", "n", "size", "half.pre", "half.suf")


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, n_a, b, n_b), both ways: words of (word, n) that differ by one inserted, deleted or replaced code point.

    The shorter of two near words (either, if equally long) is cut into two disjoint chunks.
    One edit leaves one of them whole: the first at its place, or the second shifted by the
    difference in length, which is one at most. So the longer word shows it among its positional grams,
    and the pair meets under that chunk; edits are then counted.

    A chunk shared by many words isn't joined: there, what the chunk doesn't cover must
    differ by one edit in turn, so it is cut into chunks itself, until few words meet or the
    rest is a single code point. No group is compared all with all, and none is dropped.
    """
    chunked = words.select(F.lit(True).alias("chunked"), "word", "n", F.length("word").alias("size"))
    gram = words.select(F.lit(False).alias("chunked"), "word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size"))
    start = chunked.union(gram)
    rows = start.select(F.xxhash64("size").alias("key"), "chunked", "word", "n", "size", F.lit(0).alias("pre"), F.lit(0).alias("suf"))
    found = []
    while True:
        rows = staged(_halves(rows), "spelling-chunks")
        met = rows.groupBy("key").agg(
            F.count_if("chunked").alias("x"), F.count_if(~F.col("chunked")).alias("y"), F.min("word").alias("lo"), F.max("word").alias("hi")
        ).filter((F.col("x") > 0) & (F.col("y") > 0) & (F.col("lo") != F.col("hi")))
        hot = (F.col("x") * F.col("y") > pairs) & (F.col("size") - F.col("pre") - F.col("suf") > 1)
        marked, _ = staged_rows(rows.join(met.select("key", "x", "y"), "key").withColumn("hot", hot), "spelling-met")
        cold = marked.filter("not hot")
        side = lambda role, c: cold.filter(role).select("key", F.col("word").alias(c), F.col("n").alias(f"n_{c}"))  # noqa: E731,B023
        close = side("chunked", "a").join(side("not chunked", "b"), "key").filter("a <> b")
        found.append(close.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b"))
        rows, left = staged_rows(marked.filter("hot").drop("x", "y", "hot"), "spelling-hot")
        if not left:
            break
    one_way = reduce(DataFrame.union, found)
    return one_way.union(one_way.select("b", "n_b", "a", "n_a")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: where its chain of forms ends.

    A form is more frequent than its word, so chains end; each round doubles the steps.
    """
    links = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved, n = staged_rows(links.join(further, "root").select("word", F.col("next").alias("root")), "spelling-moved")
        if not n:
            return links
        links = staged(links.join(moved.select("word"), "word", "left_anti").unionByName(moved), "spelling-roots")


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of (word, n), words being distinct.

    A word's form is its near word with the most occurrences (of several, the first in the
    order of code points) if it has ``ratio`` times the word's own, else null; form_n counts
    it. The root ends the chain of forms and is the word itself without one. An empty table
    gives an empty result.
    """
    words = staged(words, "spelling-words")
    near = near_pairs(words)
    best = near.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min_by(F.struct(F.col("b").alias("form"), F.col("n_b").alias("form_n")), F.struct(-F.col("n_b"), "b")).alias("top"),
    )
    fits: Column = F.col("top.form_n") >= ratio * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("top.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("top.form_n")).alias("form_n"),
    )
    judged = staged(judged, "spelling-forms")
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with its form, its root and its near words' number."""
    return variants(vocabulary(table(spark, sf_dir, "documents")))


OP12_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
hashed AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[b, -1, -1, -1, -1, -1, -1, -1, -1] FOR b IN
           flatten([CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END
                    FOR c IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])])),
         LAMBDA crc, step: CASE WHEN step >= 0 THEN xor(crc, step) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END), 4294967295) AS h
  FROM runs),
planted AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM planted WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n FROM less x JOIN less y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM less x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM less x JOIN words y ON x.rest = y.word),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n FROM pairs GROUP BY a),
judged AS (
  SELECT word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM words LEFT JOIN best ON a = word),
chain(word, last, step) AS (
  SELECT word, word, 0 FROM judged
  UNION ALL SELECT c.word, j.form, step + 1 FROM chain c JOIN judged j ON j.word = c.last WHERE j.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN (SELECT word, max_by(last, step) AS root FROM chain GROUP BY word) USING (word)
"""
