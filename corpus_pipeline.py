"""The corpus pipeline: documents through stages that each apply one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm.bpe import encode
from barlake.llm.common import ship, staged, table
from barlake.llm.langid import accepted, fit
from barlake.llm.mixing import taken_documents
from barlake.llm.near_dup import without_near_duplicates
from barlake.llm.secrets import redact


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a learned language; the rest goes.

    Texts without a letter go, and so do texts far from all languages. The languages are
    learned from the labelled documents; without any, all texts are kept.
    """
    ship(spark)
    model = fit(docs)
    return docs if model is None else accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    The one with the smallest doc_id stays, once if its doc_id is repeated. Rows without a
    doc_id and documents without words (null, empty or blank text) all stay. An empty table gives an
    empty result.
    """
    ship(spark)
    return without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts.

    Null and empty texts stay as they are, and so does every text without a find; n_chars
    follows a masked text. Repeated rows are masked alike; rows are never dropped.
    """
    ship(spark)
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: each document as often as the mix takes it, 0 to 3 times.

    Documents without words (null or empty text) count nothing and are taken like the others of
    their hash. Null sources are one source, the last. Of repeated rows as many are taken as
    the target asks for. An empty table gives an empty result.
    """
    return taken_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, beside its columns other than the text.

    ``decodes`` says that the ids decode to exactly the text's bytes. A null text encodes as
    empty, without ids; repeated rows are encoded alike and all stay.
    """
    ship(spark)
    return encode(docs, keep=[c for c in docs.columns if c != "text"], with_offsets=False, with_check=True)


STAGES = [
    ("language", language), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("tokens", tokens),
]
#: Language vectors, hash thresholds and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage kept is stored and is the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
