"""Packing token sequences: best fit into a bounded number of open windows per partition."""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import parts, vocabulary_path
from .common import BATCH_ROWS, blocks, staged, table, utf8

VOCABULARY = "byte_bpe_50k.json"
#: Ends every document.
END = 1
WINDOW = 2048
#: Windows a task keeps open.
OPEN = 16
#: What so many tasks leave over is merged by one.
MERGED = 64

#: White space and the text up to the next white space: no token crosses from one such piece
#: to the next. U+001C to U+001F aren't white space to the tokenizer.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: Pieces up to this length are remembered, so many of them at most.
KNOWN_CHARS, KNOWN_PIECES = 32, 1 << 19
#: Bytes of text whose words are told apart at once: the more, the fewer words are looked up again.
BLOCK_BYTES = 1 << 22
#: Pieces that are encoded in one go.
RUN = 256

_SPACES = "".join(chr(c) for c in [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
#: A space after white space.
_UNEVEN = f"[{_SPACES}] "
_LAST = np.array([END], dtype="<u4")


def _kind(piece: str) -> int:
    """1 if a piece must be encoded alone, and 2 more if it is too long to be remembered."""
    return (piece[0] not in " \n\t" or piece[-1] in _SPACES) + 2 * (len(piece) > KNOWN_CHARS)


class _Known:
    """Ids of pieces, one after the other, and the places of the pieces there.

    Place 0 is the end of a text, place 1 the empty piece.
    """

    def __init__(self):
        self.places: dict[str | None, int] = {None: 0, "": 1}
        self.ids, self.starts, self.counts = _LAST, np.array([0, 1]), np.array([1, 0])

    def add(self, pieces: Sequence[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The places that the pieces, new ones, get."""
        n = len(self.counts)
        self.places.update(zip(pieces, range(n, n + len(pieces))))
        self.starts = np.concatenate((self.starts, np.cumsum(counts) - counts + len(self.ids)))
        self.counts = np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, ids))
        return np.arange(n, n + len(pieces))

    def drop(self, pieces: Sequence[str]) -> None:
        """Forget pieces, those that were added last."""
        for p in pieces:
            del self.places[p]
        n = len(self.counts) - len(pieces)
        if pieces:
            self.ids = self.ids[: self.starts[n]].copy()
            self.starts, self.counts = self.starts[:n].copy(), self.counts[:n].copy()

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at ``places``, one piece after the other, and the number of each piece's ids."""
        counts = self.counts[places]
        ends = np.cumsum(counts)
        shift = self.starts[places] - (ends - counts)
        return self.ids[np.repeat(shift, counts) + np.arange(ends[-1] if len(ends) else 0)], counts


class Encoder:
    """The tokenizers library, asked once for each piece as long as it is remembered.

    Pieces that were asked for lately are in ``new``, those before them in ``old``; each holds
    KNOWN_PIECES at most, beside those of one block of texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        # a character of a byte-level token is a byte
        self.lengths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)
        self.new, self.old = _Known(), _Known()

    def encoded(self, sorts: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, sorted by ``_kind``, and the number of each piece's ids.

        Pieces that begin with white space and end with text are encoded many in one go: no
        token crosses from one to the next, so the byte counts of all pieces cut the ids.
        """
        texts = []
        for kind, part in enumerate(sorts):
            texts += part if kind % 2 else ["".join(part[i : i + RUN]) for i in range(0, len(part), RUN)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in found])
        sizes = pc.binary_length(pa.array([p for part in sorts for p in part], pa.large_string())).to_numpy()
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes)) + 1
        return ids, np.diff(cuts, prepend=0)

    def texts(self, pieces: Sequence[str], order: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
        """Ids of texts whose pieces are ``pieces``, none twice, new ones encoded.

        ``order`` makes of the places of ``pieces`` those of all texts' pieces, with place 0
        after each text. No long pieces are kept, and of the others the generation that is
        full as the old one.
        """
        known, old, n = self.new, self.old, len(pieces)
        at = np.fromiter(map(known.places.get, pieces, itertools.repeat(-1)), np.int64, n)
        lost = np.flatnonzero(at < 0)
        missing = [pieces[i] for i in lost.tolist()]
        before = np.fromiter(map(old.places.get, missing, itertools.repeat(-1)), np.int64, len(missing))
        again = before >= 0
        if again.any():
            at[lost[again]] = known.add(list(itertools.compress(missing, again)), *old.of(before[again]))
            lost, missing = lost[~again], list(itertools.compress(missing, ~again))
        kind = np.fromiter(map(_kind, missing), np.int64, len(missing))
        # those that are kept first, and of each sort those that are encoded many in one go
        turn = np.argsort(kind, kind="stable")
        cuts, turn = np.searchsorted(kind[turn], [0, 1, 2, 3, 4]).tolist(), turn.tolist()
        sorts = [[missing[i] for i in turn[start:stop]] for start, stop in zip(cuts, cuts[1:])]
        if missing:
            at[lost[turn]] = known.add([p for part in sorts for p in part], *self.encoded(sorts))
        places = order(at)
        ids, counts = known.of(places)
        stops = np.cumsum(counts)[places == 0].tolist()
        known.drop([p for part in sorts[2:] for p in part])
        if len(known.places) > KNOWN_PIECES:
            self.new, self.old = _Known(), known
        return [ids[start:stop].copy() for start, stop in zip([0, *stops], stops)]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, cut into pieces one by one."""
        cut = [p for t in texts for p in (*(p for part in parts(t) for p in _PIECE.findall(part)), None)]
        at = {p: i for i, p in enumerate(dict.fromkeys(cut))}
        return self.texts(list(at), lambda places: places[[at[p] for p in cut]])

    def encode_spaced(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts in which no space follows white space: their words, with the space
        before them, are the pieces. Words are told apart and put together by column."""
        lists = pc.split_pattern(texts, " ")
        at, words = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
        first = at[:-1]
        heads = words.take(pa.array(first)).dictionary_encode()
        later = np.ones(len(words), dtype=bool)
        later[first] = False
        spaced = words.filter(pa.array(later)).dictionary_encode()
        names = lambda coded: coded.dictionary.to_numpy(zero_copy_only=False).tolist()

        def order(places: np.ndarray) -> np.ndarray:
            n, out = len(spaced.dictionary), np.zeros(len(words) + len(texts), dtype=np.int64)
            where = np.arange(len(words)) + np.repeat(np.arange(len(texts)), np.diff(at))
            out[where[later]] = places[:n][spaced.indices.to_numpy()]
            out[where[first]] = places[n:][heads.indices.to_numpy()]
            return out

        return self.texts([*(" " + w for w in names(spaced)), *names(heads)], order)

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for rows, encode in ((~uneven, self.encode_spaced), (uneven, lambda part: self.encode(part.to_pylist()))):
            places = np.flatnonzero(rows)
            if len(places):
                for k, ids in zip(places, encode(texts.take(pa.array(places)))):
                    out[k] = ids
        return out


_encoder = functools.lru_cache(maxsize=2)(Encoder)


def token_ids(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Token ids of each text as the tokenizers library encodes it, with END after them."""
    return _encoder(path).encode_column(texts)


class Packer:
    """Windows of one task. ``put`` and ``flush`` yield closed sequences, as lists of pieces.

    A piece is (row, start, ids): ``row`` tells its document and ``start`` its place there.
    """

    def __init__(self, size: int = WINDOW, most: int = OPEN):
        self.size, self.most = size, most
        self.open: list[list] = []  # [tokens that still fit, pieces]

    def put(self, row, start: int, ids: np.ndarray) -> Iterator[list]:
        """Place a document, or a piece of one, where it leaves the smallest gap.

        What fills whole windows is cut off first. Where no open window has room and no
        more may be opened, the fullest is filled up with the head of the rest and closed.
        """
        while len(ids) >= self.size:
            yield [(row, start, ids[: self.size])]
            start, ids = start + self.size, ids[self.size :]
        if not len(ids):
            return
        best = min((w for w in self.open if w[0] >= len(ids)), key=lambda w: w[0], default=None)
        if best is None and len(self.open) == self.most:
            fullest = min(self.open, key=lambda w: w[0])
            room = fullest[0]
            self.open.remove(fullest)
            yield [*fullest[1], (row, start, ids[:room])]
            start, ids = start + room, ids[room:]
            best = min((w for w in self.open if w[0] >= len(ids)), key=lambda w: w[0], default=None)
        if best is None:
            best = [self.size, []]
            self.open.append(best)
        best[1].append((row, start, ids))
        best[0] -= len(ids)
        if best[0] == 0:
            self.open.remove(best)
            yield best[1]

    def merge(self) -> Iterator[list]:
        """Put the open windows together, fullest first; one, not full, may stay open."""
        windows, self.open = sorted(self.open, key=lambda w: w[0]), []
        room, held = self.size, []
        for row, start, ids in (p for w in windows for p in w[1]):
            while len(ids):
                taken = ids[:room]
                held.append((row, start, taken))
                room, start, ids = room - len(taken), start + len(taken), ids[len(taken) :]
                if not room:
                    yield held
                    room, held = self.size, []
        if held:
            self.open = [[room, held]]

    def close(self) -> Iterator[list]:
        """The last window cut into sequences of powers of two, which need no padding."""
        pieces = [p for w in self.open for p in w[1]]
        left = sum(len(p[2]) for p in pieces)
        self.open = []
        while left:
            room = want = 1 << (left.bit_length() - 1)
            out = []
            while room:
                row, start, ids = pieces.pop(0)
                out.append((row, start, ids[:room]))
                if len(ids) > room:
                    pieces.insert(0, (row, start + room, ids[room:]))
                room -= min(room, len(ids))
            yield out
            left -= want


_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, part long"


class _Rows:
    """Pieces as columns: of closed sequences, and of windows that are left over (sequence_id null)."""

    def __init__(self, first_sequence: int, part: int, with_ids: bool):
        self.sequence, self.part, self.with_ids, self.rows = first_sequence, part, with_ids, []

    def closed(self, sequences: Iterable[list]) -> None:
        for pieces in sequences:
            offset = 0
            for (doc, total), start, ids in pieces:
                raw = ids.tobytes()
                self.rows.append((doc, start, len(ids), zlib.crc32(raw), total, self.sequence, offset, raw if self.with_ids else None, None))
                offset += len(ids)
            self.sequence += 1

    def left(self, windows: list[list]) -> None:
        for (doc, total), start, ids in (p for w in windows for p in w[1]):
            self.rows.append((doc, start, len(ids), None, total, None, None, ids.tobytes(), self.part))

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 9
        self.rows = []
        kinds = [kind, *[pa.int64()] * 6, pa.binary(), pa.int64()]
        names = ["doc_id", *(f.split()[0] for f in _FIELDS.split(", "))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _first_round(docs: DataFrame, kind: str, path: str | None, size: int, most: int, with_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        vocabulary, part = path or vocabulary_path(VOCABULARY), TaskContext.get().partitionId()
        packer, rows, doc_kind = Packer(size, most), _Rows(part << 32, part, with_ids), None

        def packed(batch: pa.RecordBatch):
            texts = batch.column("text").fill_null("")
            _, at = utf8(texts)
            for start, stop in blocks(at, BLOCK_BYTES, BATCH_ROWS):
                docs_here = batch.column("doc_id").slice(start, stop - start).to_pylist()
                for doc, ids in zip(docs_here, token_ids(texts.slice(start, stop - start), vocabulary)):
                    rows.closed(packer.put((doc, len(ids)), 0, ids))
                yield rows.batch(doc_kind)

        for batch in batches:
            if batch.num_rows:
                doc_kind = batch.schema.field("doc_id").type
                yield from packed(batch)
        if doc_kind is not None:
            rows.closed(packer.merge())
            rows.left(packer.open)
            yield rows.batch(doc_kind)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_FIELDS}")


def _merge_round(left: DataFrame, kind: str, round_: int, last: bool, size: int, with_ids: bool) -> DataFrame:
    """What groups of tasks left over, merged; the last round cuts its rest into powers of two."""

    def run(batches: Iterator[pa.RecordBatch]):
        group, packer, rows, doc_kind = None, None, None, None

        def ended():
            rows.closed(packer.merge())
            if last:
                rows.closed(packer.close())
            rows.left(packer.open)
            return rows.batch(doc_kind)

        for batch in batches:
            if not batch.num_rows:
                continue
            doc_kind = batch.schema.field("doc_id").type
            for r in batch.to_pylist():
                if r["group"] != group:
                    if packer is not None:
                        yield ended()
                    group, packer = r["group"], Packer(size)
                    rows = _Rows((round_ << 56) | (group << 32), group, with_ids)
                packer.open.append([size - r["length"], [((r["doc_id"], r["doc_tokens"]), r["start"], np.frombuffer(r["ids"], dtype="<u4"))]])
        if packer is not None:
            yield ended()

    grouped = left.select("doc_id", "start", "length", "doc_tokens", "ids", "part", F.floor(F.col("part") / MERGED).alias("group"))
    order = ["group", "part", "doc_id", "start", "length", "doc_tokens", "ids"]
    return grouped.repartition("group").sortWithinPartitions(*order).mapInArrow(run, f"doc_id {kind}, {_FIELDS}")


def pack(docs: DataFrame, path: str | None = None, size: int = WINDOW, most: int = OPEN, with_ids: bool = True) -> DataFrame:
    """The pieces of all sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its whole text's token ids and END (a null or empty text is END alone).
    Each task keeps ``most`` windows of ``size`` tokens open and puts a document where it
    leaves the smallest gap; where none has room, the fullest is filled up with the
    document's head. So a sequence is full, and a document is cut only if it is longer than a
    window or closes one. What tasks leave over, less than one window each, is merged by groups of tasks,
    again and again; the very last rest is cut into sequences of powers of two tokens.
    There is no padding at all.

    Every row is a document of its own, rows that share a doc_id or have none included. An
    empty table has no sequences; other columns are ignored. ``ids`` (little-endian, 32
    bits) is null without ``with_ids``. Pieces are stored before they are returned, so
    numbers of sequences stay what they are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    made = staged(_first_round(docs, kind, path, size, most, with_ids), "packed")
    out, round_ = made.filter("sequence_id is not null").select(columns), 1
    left = made.filter("sequence_id is null")
    while True:
        tasks = left.agg(F.max("part")).first()[0]
        if tasks is None:
            return out
        made = staged(_merge_round(left, kind, round_, tasks < MERGED, size, with_ids), "packed-rest")
        out = out.union(made.filter("sequence_id is not null").select(columns))
        left, round_ = made.filter("sequence_id is null"), round_ + 1


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")
