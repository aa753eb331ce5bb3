"""URL filters: fixed rules, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (verdict, host, path): hosts stand for themselves and all subdomains, paths are prefixes.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
NGRAM = (3, 4)
#: Size of the hashed feature vector.
FEATURES = 1 << 12
#: The regression is fitted on about this many labelled URLs at most.
TRAINING_ROWS = 20_000


def split_url(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule over the columns host and path, else null.

    The rules are few and part of the query, so they are one CASE, longest first. Of two
    rules of equal length the earlier one wins.
    """
    name = verdict = None
    for action, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name = F.when(fits, host + path) if name is None else name.when(fits, host + path)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _gram(text: Column, n: int, mark: str):
    return lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n)))


def ngrams(sizes: Sequence[int] = NGRAM) -> Column:
    """Character n-grams of ^host/path$, host and path told apart by a prefix."""
    parts = []
    for mark, column in (("h", F.col("host")), ("p", F.col("path"))):
        text = F.concat(F.lit("^"), column, F.lit("$"))
        for n in sizes:
            last = F.greatest(F.length(text) - n + 1, F.lit(1))
            parts.append(F.transform(F.sequence(F.lit(1), last), _gram(text, n, mark)))
    return F.concat(*parts)


def buckets(features: int) -> Column:
    """The distinct hash buckets of a URL's n-grams."""
    return F.array_distinct(F.transform(ngrams(), lambda gram: F.pmod(F.hash(gram), F.lit(features))))


@dataclass(frozen=True)
class Regression:
    """Weights of the hash buckets, as plain numbers: nothing of it holds on to a session."""

    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """Probability of block for the columns host and path, as a JVM expression."""
        # one literal: the list is spelled as text, which Spark turns into an array while it plans
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        known = lambda total, bucket: total + F.get(weights, bucket)
        margin = F.aggregate(buckets(len(self.weights)), F.lit(self.intercept), known)
        return 1 / (1 + F.exp(-margin))


def fit(labelled: DataFrame, features: int = FEATURES, rows: int = TRAINING_ROWS) -> Regression | None:
    """A regression from (host, path, label 0/1); None if the whole table has not two labels.

    About ``rows`` labelled URLs are used. Of each label those with the smallest hashes are
    taken: half of ``rows``, or what the rarer label leaves of them; the rarer one is taken whole
    if it has no more. Weights restore the labels' shares. What is learned doesn't depend on
    the order of the table.
    """
    known = labelled.filter(F.col("label").isNotNull())
    # one row per label
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    span, left, cut, weight = 1 << 30, rows, F.lit(0), F.lit(1.0)
    for k, (label, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        take = min(n, max(left // (len(counts) - k), 1))
        left -= take
        cut = F.when(F.col("label") == label, span * take // n).otherwise(cut)
        weight = F.when(F.col("label") == label, n / take).otherwise(weight)
    sample = known.filter(F.pmod(F.xxhash64(F.concat_ws("/", "host", "path")), F.lit(span)) < cut)
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(features)], inputCol="buckets", outputCol="features")
    counted = vectors.transform(sample.select(
        buckets(features).cast("array<string>").alias("buckets"), F.col("label").cast("double").alias("label"), weight.alias("weight")
    )).select("features", "label", "weight").persist()
    try:
        model = LogisticRegression(maxIter=25, regParam=1e-3, tol=1e-6, weightCol="weight").fit(counted)
    finally:
        counted.unpersist()
    return Regression(tuple(float(x) for x in model.coefficients), float(model.intercept))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None,
    features: int = FEATURES,
) -> DataFrame:
    """page_id, host, path, rule, verdict and score (probability of block) of every url.

    The rule's verdict holds where one fits. All other urls are judged by the regression,
    fitted on ``labelled`` (url, label: 1 for block, 0 for allow; a small table). Without
    one, the urls of ``pages`` that a rule judges are the labelled table.

    A null url or one without ``://`` has an empty host and path. With labels of one kind
    only in the whole labelled table, that kind is the method's verdict; without labels it is allow, and the score is
    null. Repeated rows are judged alike; other columns are ignored.
    """
    host, path = split_url("url")
    rule, verdict = matching_rule(rules)
    parts = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "ruled": verdict})
    if labelled is None:
        known = parts.filter("ruled is not null").select("host", "path", (F.col("ruled") == "block").cast("int").alias("label"))
    else:
        known = labelled.select(host.alias("host"), path.alias("path"), "label")
    model = fit(known.distinct(), features)
    if model is None:
        only = known.agg(F.max("label")).first()[0]
        scored = parts.withColumns({"score": F.lit(None).cast("double"), "guess": F.lit("block" if only else "allow")})
    else:
        scored = parts.withColumn("score", model.score()).withColumn(
            "guess", F.when(F.col("score") > 0.5, "block").otherwise("allow")
        )
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", "guess").alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rule or regression."""
    return judge(table(spark, sf_dir, "pages"))
