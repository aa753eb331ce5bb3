"""Language ID: the nearest of several TF-IDF centroids per language, with rejection by distance."""

from __future__ import annotations

import functools
import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, per_batch, table, utf8

#: Size of the hashed n-gram vector (a power of two).
FEATURES = 1 << 12
#: The classifier is fitted on about this many labelled documents, equally many per language.
TRAINING_DOCS = 2_000
CENTROIDS = 3
#: Cosines grow with length, so cuts are fitted for texts of 8, 16, ... 1024 letters and
#: interpolated between. Texts with fewer than the least have too few n-grams for a distance to
#: mean anything; they are never rejected.
LENGTHS = tuple(8 << i for i in range(8))
#: A cut lies so far from what unlike text reaches, all but its highest hundredth, to what a
#: language's own text reaches, all but its lowest hundredth. Where they overlap it is the latter.
REJECT_SHARE = 0.25
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1


@functools.lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Per code point: its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        char = chr(c)
        if char.isalpha():
            low = char.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _slices(raw: np.ndarray) -> Iterator[np.ndarray]:
    """One long text in slices; cut at a space or line end, where no n-gram crosses, if there is one."""
    start = 0
    while len(raw) - start > BLOCK_BYTES:
        part = raw[start : start + BLOCK_BYTES]
        spaces = np.flatnonzero((part == 32) | (part == 10))
        cuts = spaces if len(spaces) else np.flatnonzero((part & 0xC0) != 0x80)
        stop = start + max(int(cuts[-1]), 1)
        yield raw[start:stop]
        start = stop
    yield raw[start:]


def _count(raw: np.ndarray, at: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts of hashed 1- to 3-grams of letters, number of letters) per text of a block."""
    docs = len(at) - 1
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    of = np.repeat(np.arange(docs), np.diff(lead[at]))
    text = np.zeros(len(points) + docs + 2, dtype=np.uint32)  # a 0 before each text
    owner = np.full(len(text), docs, dtype=np.int64)
    where = np.arange(len(points)) + of + 1
    text[where] = _folded()[points]
    owner[where] = of
    owner[lead[at[:-1]] + np.arange(docs)] = np.arange(docs)
    a, b, c, of = text[:-2], text[1:-1], text[2:], owner[:-2]
    bits = np.uint32(32 - int(features).bit_length() + 1)

    def hashed(x, salt):
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(salt)
        return ((x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)) >> bits

    one = a * np.uint32(0x9E3779B1)
    two = one + b * np.uint32(0x85EBCA77)
    three = two + c * np.uint32(0xC2B2AE3D)
    counts = np.zeros(docs * features)
    for keep, grams in ((a > 0, hashed(one, 1)), ((a | b) > 0, hashed(two, 2)), (b > 0, hashed(three, 3))):
        keep = keep & (of < docs)
        counts += np.bincount(of[keep] * features + grams[keep], minlength=docs * features)
    letters = np.bincount(of[(a > 0) & (of < docs)], minlength=docs)
    return counts.reshape(docs, features).astype(np.float32), letters


def ngram_counts(column: pa.Array, features: int = FEATURES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, counts, letters) over blocks of a text column; whole texts of any length."""
    raw, at = utf8(column)
    for start, stop in blocks(at, rows=256):
        if stop == start + 1 and at[stop] - at[start] > BLOCK_BYTES:
            counts, letters = np.zeros((1, features), np.float32), np.zeros(1, np.int64)
            for part in _slices(raw[at[start] : at[stop]]):
                c, n = _count(part, np.array([0, len(part)]), features)
                counts, letters = counts + c, letters + n
        else:
            counts, letters = _count(raw[at[start] : at[stop]], at[start : stop + 1] - at[start], features)
        yield start, stop, counts, letters


@dataclass(frozen=True)
class Centroids:
    """A fitted classifier: its size is languages x centroids x features, whatever the corpus."""

    idf: np.ndarray
    vectors: np.ndarray
    of: np.ndarray
    languages: tuple[str, ...]
    reject: np.ndarray  # languages x LENGTHS

    def cut(self, language: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The cosine under which a text of so many letters is none of its nearest language."""
        at = np.clip(np.log2(np.maximum(letters, 1) / LENGTHS[0]), 0, len(LENGTHS) - 1)
        low = np.minimum(at.astype(np.int64), len(LENGTHS) - 2)
        a, b = self.reject[language, low], self.reject[language, low + 1]
        return np.where(letters < LENGTHS[0], 0.0, a + (b - a) * (at - low))

    def by_language(self, counts: np.ndarray) -> np.ndarray:
        """The cosine of each row of counts with its nearest centroid of each language."""
        near = weighted(counts, self.idf) @ self.vectors.T
        return np.stack([near[:, self.of == i].max(axis=1) for i in range(len(self.languages))], axis=1)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, cosine with its nearest centroid) of each row of counts."""
        near = weighted(counts, self.idf) @ self.vectors.T
        best = near.argmax(axis=1)
        return self.of[best], np.clip(near[np.arange(len(best)), best], 0.0, 1.0)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors: log(1 + count) x idf."""
    out = np.log1p(counts) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts are far apart and don't depend on chance."""
    centers = [x.mean(axis=0)]
    for _ in range(1, min(k, len(x))):
        centers.append(x[(x @ np.array(centers).T).max(axis=1).argmin()])
    c = np.array(centers)
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near = (x @ c.T).argmax(axis=1)
        c = np.array([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def held_out() -> Column:
    """Whether a document is kept from training; never for a null doc_id, which isn't trained on either."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def _pieces(text: str, seed: int) -> Iterator[tuple[int, str, str]]:
    """(place in LENGTHS, beginning of a text with so many letters, the same with its letters shuffled)."""
    letters = list(itertools.islice((i for i, c in enumerate(text) if c.isalpha()), LENGTHS[-1]))
    rng = np.random.default_rng(seed % 2**32)
    for k, n in enumerate(LENGTHS):
        if n > len(letters):
            return
        piece = text[: letters[n - 1] + 1]
        other = list(piece)
        for i, j in zip(letters[:n], rng.permutation(n)):
            other[i] = piece[letters[j]]
        yield k, piece, "".join(other)


def _cuts(sample: DataFrame, model: Centroids) -> np.ndarray:
    """Cuts of each language and length: between its own texts and unlike ones of that length.

    Unlike a language are the sample's texts of other languages, and texts of its nearest
    language whose letters were shuffled. A length that no text of the language has takes the
    cut of the length below.
    """

    def run(batch: pa.RecordBatch):
        columns = [batch.column(c).to_pylist() for c in ("lang", "__h", "text")]
        made = [(lang, k, *pair) for lang, h, text in zip(*columns) for k, *pair in _pieces(text, h)]
        for shuffled in (False, True):
            texts = pa.array([m[2 + shuffled] for m in made], pa.string())
            for start, stop, counts, _ in ngram_counts(texts):
                part = made[start:stop]
                yield pa.RecordBatch.from_arrays([
                    pa.array([m[0] for m in part], pa.string()), pa.array([m[1] for m in part], pa.int32()),
                    pa.array([shuffled] * len(part)), pa.array(list(model.by_language(counts).astype(np.float64)), pa.list_(pa.float64())),
                ], ["lang", "k", "shuffled", "near"])

    got = sample.mapInArrow(per_batch(run), "lang string, k int, shuffled boolean, near array<double>").toArrow()
    cuts = np.zeros((len(model.languages), len(LENGTHS)))
    if not len(got):
        return cuts
    near = got.column("near").combine_chunks().flatten().to_numpy().reshape(len(got), -1)
    lang, k, shuffled = (np.array(got.column(c).to_pylist()) for c in ("lang", "k", "shuffled"))
    for i, name in enumerate(model.languages):
        for j in range(len(LENGTHS)):
            own = near[(lang == name) & (k == j) & ~shuffled, i]
            unlike = near[(k == j) & np.where(shuffled, near.argmax(axis=1) == i, lang != name), i]
            low = np.quantile(own, 0.01) if len(own) else 0.0
            high = np.quantile(unlike, 0.99) if len(unlike) else 0.0
            cuts[i, j] = min(low, high + REJECT_SHARE * (low - high)) if len(own) else cuts[i, max(j - 1, 0)]
    return cuts


def fit(docs: DataFrame, training: Column | None = None, size: int = TRAINING_DOCS, k: int = CENTROIDS) -> Centroids | None:
    """Fit on text and lang of the ``training`` rows (default: not held out); None without any.

    Per language, the documents with the smallest hashes of doc_id are taken, about ``size``
    over all languages together; that bounds what the driver holds. Counts come to it compressed
    and are unpacked language by language. The cut follows from the number of documents per
    language, so only the texts taken are read into Python. They are read a second time to fit the cuts of rejection.
    """
    rows = docs.filter(~held_out() & F.col("doc_id").isNotNull() if training is None else training)
    rows = rows.filter("lang is not null and text is not null")
    # one row per language, and with it the share of its documents that is taken
    known = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not known:
        return None
    span, each = 1 << 30, max(size // len(known), 1)
    cuts = F.create_map(*[F.lit(x) for name, n in known.items() for x in (name, min(span * each // n, span))])
    rows = rows.withColumn("__h", F.xxhash64("doc_id"))
    sample = rows.filter(F.pmod("__h", F.lit(span)) < cuts[F.col("lang")]).select("lang", "__h", "text")

    def run(batch: pa.RecordBatch):
        for start, stop, counts, letters in ngram_counts(batch.column("text")):
            kept = np.flatnonzero(letters)
            yield pa.RecordBatch.from_arrays([
                batch.column("lang").slice(start, stop - start).take(pa.array(kept)),
                batch.column("__h").slice(start, stop - start).take(pa.array(kept)),
                pa.array([zlib.compress(counts[i].astype("<u4").tobytes(), 1) for i in kept], pa.binary()),
            ], ["lang", "h", "counts"])

    taken = sample.mapInArrow(per_batch(run), "lang string, h long, counts binary").toArrow()
    if not len(taken):
        return None
    by_language: dict[str, list[tuple[int, bytes]]] = {}
    for lang, h, packed in zip(*(taken.column(c).to_pylist() for c in ("lang", "h", "counts"))):
        by_language.setdefault(lang, []).append((h, packed))
    n, seen = len(taken), np.zeros(FEATURES, dtype=np.int64)
    del taken
    for rows in by_language.values():
        same = Counter(h for h, _ in rows)  # rows of one hash go by their counts
        rows.sort(key=lambda r: (r[0], zlib.decompress(r[1]) if same[r[0]] > 1 else b""))
        for _, packed in rows:
            seen += np.frombuffer(zlib.decompress(packed), "<u4") > 0
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    names, vectors, of = sorted(by_language), [], []
    for i, name in enumerate(names):  # one language's vectors are unpacked at a time
        x = np.empty((len(by_language[name]), FEATURES), dtype=np.float32)
        for row, (_, packed) in zip(x, by_language.pop(name)):
            row[:] = np.frombuffer(zlib.decompress(packed), "<u4")
        c = _clusters(weighted(x, idf), k)
        vectors.append(c)
        of += [i] * len(c)
    model = Centroids(idf, np.concatenate(vectors).astype(np.float32), np.array(of), tuple(names), np.zeros((len(names), len(LENGTHS))))
    return replace(model, reject=_cuts(sample, model))


def predictions(column: pa.Array, model: Centroids | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text of a column."""
    lang, score = [UNKNOWN] * len(column), np.zeros(len(column))
    rejected = np.ones(len(column), dtype=bool)
    if model is None:
        return lang, score, rejected
    for start, _, counts, letters in ngram_counts(column):
        best, cosine = model.predict(counts)
        far = cosine < model.cut(best, letters)
        for i in np.flatnonzero(letters):
            lang[start + i], score[start + i] = model.languages[best[i]], cosine[i]
            rejected[start + i] = far[i]
    return lang, score, rejected


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine, 0 to 1) and rejected of every whole text.

    A null text or one without a letter is ``und`` with score 0, and rejected. Any other text
    gets the language of the nearest centroid; it is rejected if it is far from all. Without
    training rows every text is ``und``. Rows are judged on their own, so repeated rows get
    equal results; lang, source and other columns play no part in a prediction.
    """

    def run(batch: pa.RecordBatch):
        lang, score, rejected = predictions(batch.column("text"), model)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
            ["doc_id", "held_out", "lang_pred", "score", "rejected"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        per_batch(run), f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def accepted(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that identification doesn't reject."""

    def run(batch: pa.RecordBatch):
        _, _, rejected = predictions(batch.column("text"), model)
        yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(per_batch(run), docs.schema)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
