import base64
import random
import string
import zlib

import numpy as np
import pyarrow as pa

from barlake.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_the_whole_table(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = langid.op9_langid(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.96
    assert not any(r.rejected for r in out)


def test_predictions_ignore_everything_but_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    other = docs.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "1 as score", "'x' as lang_pred")
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    b = {r.doc_id - 7: (r.lang_pred, r.score) for r in langid.identify(other, model).collect()}
    assert a == b


def test_odd_texts(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(train)
    texts = [None, "", "123 !? 😀", "é", "漢字" * 100, "the and of " * 200_000, "x" * 3_000_000, "der und die nicht"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "le"), (0, None)], "doc_id long, text string")
    out = langid.identify(docs, model).collect()
    assert len(out) == len(texts) + 2
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in range(3)] == ["und"] * 3 and all(by[i].rejected and by[i].score == 0 for i in range(3))
    assert all(by[i].lang_pred in model.languages for i in range(3, 8)) and by[None].held_out is False
    assert by[4].rejected and by[5].lang_pred == "en" and not by[5].rejected and not by[3].rejected


def test_no_training_rows_and_empty_table(spark, made):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert langid.fit(docs) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    at = made("documents", [], "doc_id long, text string, lang string")
    assert langid.op9_langid(spark, at).collect() == []


def test_long_text_is_counted_whole():
    text = "wörter und mehr wörter " * 100_000
    (_, _, long, letters), = langid.ngram_counts(pa.array([text]))
    (_, _, one, n), = langid.ngram_counts(pa.array([text[:23]]))
    assert letters[0] == 100_000 * n[0]
    np.testing.assert_allclose(long[0], one[0] * 100_000, rtol=0.2)


def test_accepted_keeps_rows_and_columns(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    docs = spark.createDataFrame([(1, "the and of that", "q", 1), (2, "42", "q", 1), (3, None, None, 2)], "doc_id long, text string, lang_pred string, score int")
    assert [tuple(r) for r in langid.accepted(docs, model).collect()] == [(1, "the and of that", "q", 1)]


def test_noise_and_unlearned_languages_are_rejected(spark):
    rng = random.Random(4)
    finnish = "Tämä on pitkä suomenkielinen teksti, jossa kerrotaan maan historiasta ja sen kansan elämästä pohjoisessa. "
    polish = "To jest długi tekst w języku polskim, który opowiada o historii kraju i jego mieszkańcach. "
    noise = "".join(rng.choice(string.ascii_lowercase + " ") for _ in range(2000))
    texts = [noise, noise.title(), base64.b64encode(rng.randbytes(1500)).decode(), finnish * 20, polish * 20]
    texts += [t[:35] for t in texts]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts += ["".join(rng.sample(r.text, len(r.text))) for r in docs.filter("n_chars > 1000").limit(40).collect()]
    out = langid.identify(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), langid.fit(docs)).collect()
    assert all(r.rejected for r in out if r.doc_id < 10)
    assert sum(r.rejected for r in out) >= 0.95 * len(texts)


def test_little_of_the_training_documents_reaches_the_driver(spark, monkeypatch):
    """Counts are mostly zeros: some 16 KB a document, if they came as they are."""
    got, plain = [], type(spark.range(0)).toArrow

    def kept(df):
        got.append(plain(df))
        return got[-1]

    monkeypatch.setattr(type(spark.range(0)), "toArrow", kept)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert langid.fit(docs) is not None
    assert got[0].num_rows > 300 and got[0].nbytes < got[0].num_rows * langid.FEATURES  # a quarter of the plain size
