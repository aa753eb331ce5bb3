"""Secret scans: fixed patterns, and random strings found by how badly a vocabulary compresses them."""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from .bpe import read_ranks, vocabulary_path
from .common import per_batch, table

#: Fixed patterns, in the order their spans are listed; letters of ASSIGN in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: One of these is in every text that ASSIGN matches.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 6

#: Strings without spaces that may be or hold random ones, and their pieces.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
PIECE = re.compile(r"[A-Za-z0-9]+")
#: Known forms that look random but are no secrets: digests, UUIDs, short hex numbers, time stamps, plain numbers.
_FORM = (
    r"[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|(?:0[xX])?[0-9a-fA-F]{1,16}|[0-9]{8}T[0-9]{6}Z?"
)
KNOWN = re.compile(rf"(?:{_FORM}|[0-9+/_=-]+)")
KNOWN_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{_FORM})(?![A-Za-z0-9])")
#: Known names of any length, told by what they begin or end with: digests in base64 behind their
#: algorithm, book numbers, dated file names, ordinals and names of character sets.
KNOWN_NAME = re.compile(
    r"(?<![A-Za-z0-9])(?:[sS][hH][aA](?:1|224|256|384|512)[-_=/][A-Za-z0-9+/]{27,86}={0,2}"
    r"|ISBN[_=-]?(?:97[89]-?)?[0-9](?:-?[0-9]){8}-?[0-9X]|(?:19|20)[0-9]{6}[_-][0-9]{4,6}|[0-9]+(?:st|nd|rd|th)"
    r"|(?:ISO|iso)[-_]8859[-_][0-9]{1,2}|(?:UTF|utf)[-_]?(?:8|16|32)(?:LE|BE|le|be)?|(?:CP|cp)[0-9]{3,5}|[wW]indows-[0-9]{3,4})(?![A-Za-z0-9])"
)
_MIXED = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")
#: Least length of a random piece with letters and digits, with letters of both cases mixed, with
#: letters of one case, and of a stretch of several pieces. Clean words of these kinds and
#: lengths have RATIO characters per token or more in the given tables.
LEAST_DIGITS, LEAST_MIXED, LEAST_LETTERS, LEAST_JOINED = 12, 16, 20, 20
#: A stretch of pieces has so many characters per separator at least; names and dates have fewer.
JOINED_CHARS = 7
#: Characters per token under which a string counts as random.
RATIO = 2.0
KINDS = ("assign", "access", "hex", "random")
MASK = "[SECRET]"


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, ends exclusive."""
    out = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    # maximal runs of 24 or more are the runs of one or more that are long enough
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def _varied(word: str) -> bool:
    return any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def _least(piece: str) -> int:
    if _varied(piece):
        return LEAST_DIGITS
    if piece.isdigit():
        return len(piece) + 1
    return LEAST_MIXED if _MIXED.search(piece) else LEAST_LETTERS


def _stretches(weights: list[int]) -> list[tuple[int, int]]:
    """All maximal stretches (from, to) of the largest sums of weights, Ruzzo and Tompa's way."""
    kept: list[tuple[int, int, int, int, int]] = []  # from, to, sum before, sum after, the last one kept that began lower
    total = 0
    for i, w in enumerate(weights):
        before, total = total, total + w
        if w <= 0:
            continue
        start, k = i, len(kept) - 1
        while True:
            while k >= 0 and kept[k][2] >= before:
                k = kept[k][4]
            if k < 0 or kept[k][3] >= total:
                kept.append((start, i + 1, before, total, k))
                break
            start, _, before, _, link = kept[k]
            del kept[k:]
            k = link
    return [x[:2] for x in kept]


def _random_parts(word: str, path: str, ratio: float) -> list[tuple[int, int]]:
    """(start, end) of what is random in a string: all of it, pieces, and stretches of pieces."""
    encode = _encoding(path).encode_ordinary
    if KNOWN.fullmatch(word):
        return []
    known = [m.span() for m in KNOWN_PART.finditer(word) if m.end() - m.start() > LEAST_DIGITS]
    names = [m.span() for m in KNOWN_NAME.finditer(word)]
    known = sorted(names + [(a, b) for a, b in known if not any(a < y and x < b for x, y in names)])
    if len(word) >= LEAST_JOINED and _varied(word) and not known and len(word) < ratio * len(encode(word)):
        return [(0, len(word))]
    out, at = [], 0
    for stop, following in [*known, (len(word), len(word))]:
        pieces = [m.span() for m in PIECE.finditer(word, at, stop)]
        at = following
        if not any(b - a >= _least(word[a:b]) for a, b in pieces) and (not pieces or pieces[-1][1] - pieces[0][0] < LEAST_JOINED):
            continue
        weights = [ratio * len(encode(word[a:b])) - (b - a) for a, b in pieces]
        found = [(a, b) for (a, b), w in zip(pieces, weights) if w > 0 and b - a >= _least(word[a:b]) and not KNOWN.fullmatch(word[a:b])]
        for i, j in _stretches(weights):
            a, b = pieces[i][0], pieces[j - 1][1]
            part = word[a:b]
            if j - i > 1 and b - a >= max(LEAST_JOINED, JOINED_CHARS * (j - i - 1)) and (_varied(part) or _MIXED.search(part)):
                if len(part) < ratio * len(encode(part)):
                    found = [f for f in found if f[1] <= a or f[0] >= b] + [(a, b)]
        for a, b in sorted(found):
            while b < len(word) and word[b] == "=" and word[b:].strip("=") == "":
                b += 1
            out.append((a, b))
    return out


def random_spans(text: str, taken: Sequence[tuple[str, int, int]], path: str, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """Spans of strings with few characters per token, in what base spans leave.

    A string is judged as a whole, by pieces between separators, and by the stretches of
    pieces that are hardest to compress, so words beside a key don't hide it. Invented or
    foreign words are nearly as hard to compress as keys without digits, which therefore
    have to be longer. Digests, UUIDs, numbers and known names are left out.
    """
    out, covered, k = [], sorted((s, e) for _, s, e in taken), 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        free, at = [], start
        for i in itertools.count(k):
            if i == len(covered) or covered[i][0] >= end:
                break
            free.append((at, covered[i][0]))
            at = max(at, covered[i][1])
        for a, b in [*free, (at, end)]:
            if b - a >= LEAST_DIGITS:
                out += [("random", a + i, a + j) for i, j in _random_parts(text[a:b], path, ratio)]
    return out


def listed(spans: Sequence[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def find(text: str, path: str, ratio: float = RATIO) -> tuple[list, list]:
    base = base_spans(text)
    return base, base + random_spans(text, base, path, ratio)


def scan(docs: DataFrame, ratio: float = RATIO, path: str | None = None) -> DataFrame:
    """doc_id, counts of the fixed patterns, a digest of their spans, and all spans of every text.

    Spans are in code points. Null text counts as empty: no spans, and the digest of an
    empty string. Each row is scanned on its own; other columns are ignored.
    """

    def run(batch: pa.RecordBatch):
        vocabulary = path or vocabulary_path()
        counts, digests, spans = [], [], []
        for value in batch.column("text"):
            base, every = find(value.as_py() or "", vocabulary, ratio)
            counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS[:3]])
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            spans.append(listed(every))
        columns = [batch.column("doc_id"), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3))]
        columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        per_batch(run),
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def masked(text: str, spans: Sequence[tuple[str, int, int]], mask: str = MASK) -> str:
    """The text with each stretch of spans, overlapping ones together, replaced by the mask."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda x: (x[1], x[2])):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, ratio: float = RATIO, path: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, secrets in text masked and n_chars counted anew.

    Rows without a secret are returned as they are, null texts included.
    """

    def run(batch: pa.RecordBatch):
        vocabulary = path or vocabulary_path()
        texts, sizes = batch.column("text"), None
        found = {}
        for i, value in enumerate(texts):
            text = value.as_py()
            spans = find(text, vocabulary, ratio)[1] if text else ()
            if spans:
                found[i] = masked(text, spans)
        if found:
            where = pa.array([i in found for i in range(batch.num_rows)])
            texts = pa.compute.replace_with_mask(texts, where, pa.array(list(found.values()), texts.type))
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", texts)
            if "n_chars" in batch.schema.names:
                sizes = batch.column("n_chars")
                counts = pa.array([len(t) for t in found.values()], sizes.type)
                batch = batch.set_column(batch.schema.get_field_index("n_chars"), "n_chars", pa.compute.replace_with_mask(sizes, where, counts))
        yield batch

    return docs.mapInArrow(per_batch(run), docs.schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: spans of the fixed patterns and of random strings."""
    return scan(table(spark, sf_dir, "documents"))
