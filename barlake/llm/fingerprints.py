"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, mixed, table

#: Levels of phrases that every text has; a phrase of one level has about three of the level below.
LEVELS = 3
#: Longer texts have more: levels are added while the last one has more phrases than this.
MORE_PHRASES = 512
#: Names per phrase of one level as against the next in the mean of levels that likeness is.
GROWTH = 3
#: Rounds of coin tossing after which labels are below 6.
TOSSES = 4
_WEIGHTS = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _shifted(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x[:1], x[:-1]))


def _tossed(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing: where a label differs from the one before, and its bit there.

    The lowest differing bit's place l and value b give 2 l + b. Neighbours that differed
    still differ, and b-bit labels become labels below 2 b. A text's first label is compared with
    its own complement in the lowest bit.
    """
    before = np.where(first, labels ^ labels.dtype.type(1), _shifted(labels))
    apart = labels ^ before
    one = labels.dtype.type(1)
    place = np.bitwise_count((apart & (~apart + one)) - one)
    return (2 * place + ((labels >> place.astype(labels.dtype)) & one)).astype(np.uint8)


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the phrases of texts that lie one after the other.

    ``first`` marks where a text begins. Runs of one name become one symbol, so neighbours
    differ; coin tossing reduces symbols to labels below 6; a phrase begins at each local
    maximum. All of it depends on a few neighbours only, so equal substrings are cut alike
    wherever they stand, but for a phrase or two at their ends. A phrase's name is a hash of
    its symbols in order.
    """
    run = np.flatnonzero(first | (names != _shifted(names)))
    length = np.diff(np.append(run, len(names))).astype(np.uint64)
    symbols, first = names[run], first[run]
    symbols = _symbols(symbols, length)
    start = _starts(symbols, first)
    return _named(symbols, start), first[start]


def _symbols(names: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A symbol for each run of one name."""
    return np.where(length > 1, mixed(names + length * np.uint64(0x9E3779B97F4A7C15)), names)


def _starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin: at each text's first symbol and at local maxima of the tossed labels."""
    labels = symbols
    for _ in range(TOSSES):
        labels = _tossed(labels, first)
    last = np.append(first[1:], True)
    rises = ~first & (labels > _shifted(labels))
    falls = ~last & (labels > np.append(labels[1:], labels[-1:]))
    return np.flatnonzero(first | (rises & falls))


def _named(symbols: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The names of the phrases that begin at ``start`` and cover the symbols from there on."""
    size = np.diff(np.append(start, len(symbols)))
    inside = np.arange(len(symbols) - start[0]) - np.repeat(start - start[0], size)
    sums = np.add.reduceat(symbols[start[0] :] * _WEIGHTS[inside % len(_WEIGHTS)], start - start[0])
    return mixed(sums + size.astype(np.uint64))


#: Symbols before a place that its label and those of its neighbours depend on, and one more.
CONTEXT = TOSSES + 3


class _Level:
    """``parse`` of one long text that comes piece by piece; cut at phrase borders only.

    Held are a run and a phrase that may go on, and the few symbols before it that coin tossing looks
    back on. So a phrase is the same wherever pieces end.
    """

    def __init__(self):
        self.name, self.length = None, 0  # the run that may go on
        self.symbols, self.open, self.begun = np.zeros(0, np.uint64), 0, False

    def feed(self, names: np.ndarray, end: bool) -> np.ndarray:
        """Names of the phrases that are whole now."""
        if len(names):
            run = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
            length = np.diff(np.append(run, len(names))).astype(np.uint64)
            runs = names[run]
            if self.name is not None and self.name == runs[0]:
                length[0] += np.uint64(self.length)
            elif self.name is not None:
                runs, length = np.append(self.name, runs), np.append(np.uint64(self.length), length)
        elif self.name is not None:
            runs, length = np.array([self.name]), np.array([self.length], np.uint64)
        else:
            return np.zeros(0, np.uint64)
        if not end:
            self.name, self.length = runs[-1], int(length[-1])
            runs, length = runs[:-1], length[:-1]
        symbols = np.concatenate((self.symbols, _symbols(runs, length)))
        if not len(symbols):
            return symbols
        first = np.zeros(len(symbols), dtype=bool)
        first[0] = True
        start = _starts(symbols, first)
        start = start[start > self.open]  # which is the text's first symbol, or a border found before
        if not end:
            start = start[start < len(symbols) - 1]
        borders = np.append(self.open, start)
        stop = len(symbols) if end else int(borders[-1])
        whole = borders if end else borders[:-1]
        out = _named(symbols[:stop], whole) if len(whole) and stop > whole[0] else np.zeros(0, np.uint64)
        cut = max(stop - CONTEXT, 0)
        self.symbols, self.open, self.begun = symbols[cut:], stop - cut, True
        return out


#: Per level the sorted, distinct names of a text's phrases (32 bits).
Sketch = tuple[np.ndarray, ...]


def sketches(texts: list[str]) -> list[Sketch]:
    """All phrase names of each text by level; LEVELS empty ones for an empty text.

    Texts are parsed a block at a time, a longer one by itself, piece by piece.
    """
    none = np.zeros(0, np.uint32)
    out: list[Sketch] = [(none,) * LEVELS] * len(texts)
    part: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) > BLOCK_BYTES:
            out[i] = _long(text)
        elif text:
            if size + len(text) > BLOCK_BYTES:
                _block(texts, part, out)
                part, size = [], 0
            part.append(i)
            size += len(text)
    if part:
        _block(texts, part, out)
    return out


def _characters(text: str) -> np.ndarray:
    names = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    return mixed(names + np.uint64(1))


def _block(texts: list[str], part: list[int], out: list[Sketch]) -> None:
    names = _characters("".join([texts[i] for i in part]))
    first = np.zeros(len(names), dtype=bool)
    first[np.concatenate(([0], np.cumsum([len(texts[i]) for i in part])[:-1])).astype(np.int64)] = True
    found: list[list[np.ndarray]] = [[] for _ in part]
    open_ = np.ones(len(part), dtype=bool)
    while open_.any():
        names, first = parse(names, first)
        # one sort for all texts of the block: the text's place above its names
        keys = np.unique(((np.cumsum(first) - 1).astype(np.uint64) << np.uint64(32)) | (names >> np.uint64(32)))
        edges = np.searchsorted(keys, np.arange(len(part) + 1, dtype=np.uint64) << np.uint64(32))
        short = keys.astype(np.uint32)
        phrases = np.diff(np.append(np.flatnonzero(first), len(names)))
        for k in np.flatnonzero(open_):
            found[k].append(short[edges[k] : edges[k + 1]])
            open_[k] = len(found[k]) < LEVELS or phrases[k] > MORE_PHRASES
    for i, levels in zip(part, found):
        out[i] = tuple(levels)


def _long(text: str) -> Sketch:
    """A text of more than a block, level after level; only names of 32 bits are held of all of it."""
    pieces: Iterable[np.ndarray] = (_characters(text[at : at + BLOCK_BYTES]) for at in range(0, len(text), BLOCK_BYTES))
    found = []
    while True:
        level, made = _Level(), []
        for piece in pieces:
            made.append(level.feed(piece, False))
        made.append(level.feed(np.zeros(0, np.uint64), True))
        found.append(np.unique(np.concatenate([(m >> np.uint64(32)).astype(np.uint32) for m in made])))
        if len(found) >= LEVELS and sum(map(len, made)) <= MORE_PHRASES:
            return tuple(found)
        pieces = made


def written(sketch: Sketch) -> str:
    """The fingerprint: all names of each level, in order, in base64; levels end with a dot.

    Empty for an empty text.
    """
    if not len(sketch[0]):
        return ""
    return "".join(base64.b64encode(level.astype(">u4").tobytes()).decode() + "." for level in sketch)


def read(fingerprint: str) -> Sketch:
    """The names that a fingerprint holds, by level."""
    levels = fingerprint.split(".")[:-1] or [""] * LEVELS
    return tuple(np.frombuffer(base64.b64decode(level), dtype=">u4").astype(np.uint32) for level in levels)


def common(a: Sketch, b: Sketch) -> list[int]:
    """How many phrase names two texts share, per level."""
    out = []
    for x, y in zip(a, b):
        both = np.concatenate((x, y))
        both.sort()
        out.append(int(np.count_nonzero(both[1:] == both[:-1])))
    return out


def likeness(a: Sketch, b: Sketch, shared: list[int] | None = None) -> float:
    """The share of common names among all (Jaccard) per level, in the mean; 1 for two empty texts.

    Levels that both texts have are compared.

    A level counts GROWTH times as much as the one below, as its phrases are so much longer:
    long common passages count most, and short texts without a common long phrase are still
    told apart by the short ones.
    """
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    shared = common(a, b) if shared is None else shared
    shares = [n / (len(x) + len(y) - n) for x, y, n in zip(a, b, shared)]
    return sum(s * GROWTH**i for i, s in enumerate(shares)) / sum(GROWTH**i for i in range(len(shares)))


def _bucket(borders: list[int]) -> Column:
    """How many borders are not above doc_id; a null id is below all."""

    @F.pandas_udf("int")
    def count(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(borders, np.int64), ids.to_numpy(), side="right").astype(np.int32))

    return count(F.coalesce("doc_id", F.lit(-(2**63))))  # without nulls ids stay integers on their way


def _destinations(docs: DataFrame, parts: int) -> DataFrame:
    """(bucket, role, doc_id, text): documents in buckets of successive doc_ids.

    Bucket borders are ids near the quantiles of doc_id. The documents on a border are the last of the upper bucket's order, where they are only looked at (role 1), and the
    first of the lower one, where they get their result. The documents with the largest id are
    looked at once more at the end of the lowest bucket (role 2), where the order closes.
    """
    shares = [i / parts for i in range(1, parts)]
    known = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("q") if shares else F.lit(None).alias("q"), F.max("doc_id").alias("m")).first()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # quantiles may be no ids at all; the smallest id of each bucket they make is one
    firsts = docs.groupBy(_bucket(sorted(set(known["q"] or ()))).alias("b")).agg(F.min("doc_id").alias("id")).collect()
    borders = sorted({r["id"] for r in firsts if r["id"] is not None and r["b"] > 0})
    if not borders:
        return rows.select(F.lit(0).alias("bucket"), F.lit(0).alias("role"), "doc_id", "text")
    own = rows.withColumn("b", _bucket(borders))
    at_border = F.coalesce(F.get(F.array(*map(F.lit, borders)), F.col("b") - 1) == F.col("doc_id"), F.lit(False))
    place = lambda bucket, role: F.struct(bucket.cast("int").alias("bucket"), F.lit(role).alias("role"))
    stays = F.when(at_border, F.array(place(F.col("b"), 1), place(F.col("b") - 1, 0))).otherwise(F.array(place(F.col("b"), 0)))
    closes = F.when(F.col("doc_id") == known["m"], F.array(place(F.lit(0), 2))).otherwise(F.array())
    return own.select("doc_id", "text", F.explode(F.concat(stays, closes)).alias("to")).select("to.bucket", "to.role", "doc_id", "text")


class _Order:
    """Documents of a bucket in order: each result needs the document after it."""

    def __init__(self):
        self.items, self.size, self.known, self.first = [], 0, None, None

    def add(self, bucket, role, doc_id, text):
        """Results that are due once this document is known."""
        last = self.items[-1] if self.items else None
        if last and last[:4] == [bucket, role, doc_id, text]:
            last[4] += 1  # a repeated row shares the result
            return ()
        self.items.append([bucket, role, doc_id, text, 1])
        if self.first is None:
            self.first = text
        self.size += len(text)
        return self.due() if self.size >= BLOCK_BYTES else ()

    def due(self):
        """Results of all documents but the last, which waits for its next."""
        pairs = [(a, b) for a, b in zip(self.items, self.items[1:]) if a[0] == b[0] and a[1] == 0]
        own = sketches([i[3] for i in self.items] if self.known is None else [i[3] for i in self.items[1:]])
        own = own if self.known is None else [self.known, *own]
        sketch = {id(i): s for i, s in zip(self.items, own)}
        edits = [edited(a[3], b[3]) for a, b in pairs]
        for (a, b), text, new in zip(pairs, edits, sketches(edits)):
            yield from self.result(a, text, sketch[id(a)], new, sketch[id(b)])
        self.items, self.size, self.known = self.items[-1:], len(self.items[-1][3]), own[-1]

    def result(self, item, text, own, new, after):
        near, far = common(own, new), common(own, after)
        row = (
            item[2], len(item[3]), hashlib.sha256(text.encode("utf-8")).hexdigest(), written(own), written(new),
            likeness(own, new, near), likeness(own, after, far), near, far, own, new,
        )
        for _ in range(item[4]):
            yield row

    def finish(self):
        """The order closes in one bucket alone: its last document's next is its first."""
        if not self.items:
            return
        yield from self.due()
        last = self.items[0]
        if last[0] == 0 and last[1] == 0:
            text = edited(last[3], self.first)
            own, new, after = sketches([last[3], text, self.first])
            yield from self.result(last, text, own, new, after)
        self.items = []


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of the next, or all of it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_RESULT = [
    ("doc_id", None), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("common_edited", pa.list_(pa.int64())), ("common_next", pa.list_(pa.int64())),
    ("phrases", pa.list_(pa.list_(pa.int32()))), ("edited_phrases", pa.list_(pa.list_(pa.int32()))),
]


def fingerprint_edits(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of its edit by the next document, and their likeness.

    ``phrases`` and ``edited_phrases`` are all distinct phrase names by level, as signed integers
    of 32 bits; ``common_edited`` and ``common_next`` count the names shared, per level. The
    fingerprint strings spell the same names (``read``), and likeness is what they say.

    Next is in descending doc_id; after the last comes the first. Documents of one doc_id
    follow each other by text, a null doc_id comes after all others, and rows equal in both
    count once in the order and get equal results. Null text is empty: its fingerprint is
    the empty string, alike (1) to another empty one and unlike (0) any other. A single
    document is its own next. An empty table gives an empty result; other columns are ignored.

    Texts are shuffled once, into ``parts`` buckets of successive ids (4 per shuffle
    partition by default), sorted there, and read as a stream: a task holds about a block of
    text, however long a bucket is.
    """
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _destinations(docs.select(F.col("doc_id").cast("long"), "text"), parts or 4 * shuffles)
    lined = placed.repartition(shuffles, "bucket").sortWithinPartitions("bucket", F.col("role") == 2, F.col("doc_id").desc_nulls_last(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, bucket_now = _Order(), None
        for batch in batches:
            columns = [batch.column(c) for c in ("bucket", "role", "doc_id", "text")]
            for row in zip(*columns):
                bucket, role, doc_id, text = (v.as_py() for v in row)
                if bucket != bucket_now:
                    yield from _rows(order.finish())
                    order, bucket_now = _Order(), bucket
                yield from _rows(order.add(bucket, role, doc_id, text))
        yield from _rows(order.finish())

    return lined.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
        "common_edited array<long>, common_next array<long>, phrases array<array<int>>, edited_phrases array<array<int>>",
    )


def _nested(found: tuple[Sketch, ...]) -> pa.Array:
    """Sketches as lists of lists, without a Python object per name."""
    levels = [level for sketch in found for level in sketch]
    inner = np.cumsum([0, *map(len, levels)]).astype(np.int32)
    outer = np.cumsum([0, *map(len, found)]).astype(np.int32)
    names = pa.array(np.concatenate(levels).view(np.int32))
    return pa.ListArray.from_arrays(pa.array(outer), pa.ListArray.from_arrays(pa.array(inner), names))


def _rows(found: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of results; each holds about a block of names, or one document's."""
    part, size = [], 0
    for row in found:
        part.append(row)
        size += sum(map(len, row[-2])) + sum(map(len, row[-1]))
        if size >= BLOCK_BYTES:
            yield _batch(part)
            part, size = [], 0
    if part:
        yield _batch(part)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64() if k is None else k for _, k in _RESULT]
    columns = [_nested(c) if k == _RESULT[-1][1] else pa.array(c, k) for c, k in zip(zip(*found), kinds)]
    return pa.RecordBatch.from_arrays(columns, [n for n, _ in _RESULT])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and all phrases of every whole text; null text is empty."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for at in range(0, len(texts), 256):
                part = sketches(texts.slice(at, 256).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), pa.array([written(s) for s in part], pa.string()), _nested(tuple(part))],
                    ["doc_id", "fingerprint", "phrases"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string, phrases array<array<int>>")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edit's, and how alike they and the next document's are."""
    return fingerprint_edits(table(spark, sf_dir, "documents")).drop("phrases", "edited_phrases")
