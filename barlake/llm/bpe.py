"""Byte-level BPE: encoding with character offsets, decoding, and the round trip's digests."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, per_batch, table, utf8

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Longer texts are encoded in parts of about this many characters, cut where no token can cross.
PART_CHARS = 1 << 15
#: A match can't cross from a character that isn't white space to a space or line end.
_CUT = re.compile(r"[^\s][ \n]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[bytes, ...]:
    """The bytes of each id: its token's characters, turned back by the reversed byte table."""
    byte_of = {character: byte for byte, character in enumerate(byte_characters())}
    vocabulary = tokenizer(path).get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[character] for character in token)
    return tuple(out)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str | None = None):
    """A tokenizer of the tokenizers library that yields the ids of a rank file.

    Merging by rank may join any two tokens whose concatenation is a token, so every split
    of a token into two tokens becomes a merge, in the order of ranks; a match that is a
    token as a whole is taken as it is. ``pattern`` None is the library's own pattern for
    byte-level vocabularies, which is the public one of the rank files.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, char = read_ranks(path), byte_characters()
    names = {token: "".join(char[b] for b in token) for token in ranks}
    merges = [
        (names[token[:i]], names[token[i:]])
        for token, _ in sorted(ranks.items(), key=lambda item: item[1])
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    model = models.BPE(vocab={names[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    out = Tokenizer(model)
    if pattern is None:
        out.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    else:
        out.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
    return out


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text where encoding the parts equals encoding the whole."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


def encode_texts(texts: Sequence[str], path: str) -> list[np.ndarray]:
    """Token ids of each text."""
    cut = [list(parts(t)) for t in texts]
    found = tokenizer(path).encode_batch_fast([p for ps in cut for p in ps], add_special_tokens=False)
    out, at = [], 0
    for ps in cut:
        ids = [np.array(e.ids, dtype=np.uint32) for e in found[at : at + len(ps)]]
        out.append(ids[0] if len(ids) == 1 else np.concatenate(ids))
        at += len(ps)
    return out


def decode_bytes(ids: Sequence[int], path: str) -> bytes:
    """The bytes that token ids stand for; a character split over tokens is whole again."""
    known = token_bytes(path)
    return b"".join([known[i] for i in ids])


@functools.lru_cache(maxsize=4)
def token_lengths(path: str) -> np.ndarray:
    return np.array([len(t) for t in token_bytes(path)], dtype=np.int64)


def offsets(text: str, ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last, in code points.

    A token that begins or ends inside a character counts that character as its own, so
    tokens that share a split character overlap in it.
    """
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    lead = np.append((raw & 0xC0) != 0x80, True)
    before = np.concatenate(([0], np.cumsum(lead[:-1])))
    stop = np.cumsum(token_lengths(path)[ids])
    start = stop - token_lengths(path)[ids]
    return before[start] - ~lead[start], before[stop]


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[str]]]:
    """The texts of a batch in blocks of bounded size; null is empty."""
    values = batch.column(column).fill_null("")
    _, at = utf8(values)
    for start, stop in blocks(at):
        yield start, stop, values.slice(start, stop - start).to_pylist()


def encode(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), with_offsets: bool = True, path: str | None = None, with_check: bool = False
) -> DataFrame:
    """``keep`` columns, token_ids and n_tokens of every whole text, and each token's characters.

    token_ids, token_starts and token_ends are arrays of int (offsets in code points, end
    exclusive). ``with_check`` adds decodes: whether the ids decode to exactly the text's
    bytes. Null text encodes as empty: no tokens. Rows are encoded on their own, so
    repeated rows give equal ids; columns not in ``keep`` are ignored, and a kept column
    named like a result is dropped in its favour.
    """
    added = "n_tokens long, token_ids array<int>"
    if with_offsets:
        added += ", token_starts array<int>, token_ends array<int>"
    if with_check:
        added += ", decodes boolean"
    made = {part.split()[0] for part in added.split(", ")}
    keep = [c for c in keep if c not in made]
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), added])

    def run(batch: pa.RecordBatch):
        vocabulary = path or vocabulary_path()
        for start, stop, texts in _texts(batch, "__text"):
            ids = encode_texts(texts, vocabulary)
            columns = [batch.column(c).slice(start, stop - start) for c in keep]
            columns += [pa.array([len(x) for x in ids], pa.int64()), _lists(ids)]
            if with_offsets:
                spans = [offsets(t, x, vocabulary) for t, x in zip(texts, ids)]
                columns += [_lists([s for s, _ in spans]), _lists([e for _, e in spans])]
            if with_check:
                columns.append(pa.array([decode_bytes(x.tolist(), vocabulary) == t.encode("utf-8") for t, x in zip(texts, ids)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, [*keep, *(part.split()[0] for part in added.split(", "))])

    return rows.mapInArrow(per_batch(run), schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, raw (the bytes) and text of every row of (doc_id, token_ids).

    Null ids decode as empty. The bytes are exact for any slice of a text's tokens; in the
    text, a character cut at the slice's edge is U+FFFD. An id outside the vocabulary, or a
    null one, is an error.
    """

    def run(batch: pa.RecordBatch):
        vocabulary = path or vocabulary_path()
        raw = [decode_bytes(x or (), vocabulary) for x in batch.column("token_ids").to_pylist()]
        texts = [x.decode("utf-8", errors="replace") for x in raw]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(raw, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "raw", "text"]
        )

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "token_ids").mapInArrow(per_batch(run), f"doc_id {kind}, raw binary, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the decoded bytes.

    Encodes and decodes a block of texts in one pass, so ids never travel back to Spark.
    Null and empty texts have no tokens and the digest of nothing.
    """

    def run(batch: pa.RecordBatch):
        vocabulary = path or vocabulary_path()
        for start, stop, texts in _texts(batch, "text"):
            ids = encode_texts(texts, vocabulary)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(start, stop - start),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(decode_bytes(x.tolist(), vocabulary)).hexdigest() for x in ids], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        per_batch(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes they decode to."""
    return round_trip(table(spark, sf_dir, "documents"))
