"""Packed pieces against whole encodings, and sequences against what a window allows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barlake.llm import packing

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True


def reference(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def check(rows, out, size=2048):
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    pieces = out.collect()
    whole = {t: reference(t) for t in {t for _, t in rows}}
    # pieces tile every row's document: rows that look alike have as many pieces of each kind as rows
    docs, seen = defaultdict(list), defaultdict(list)
    for i, t in rows:
        docs[i].append(whole[t])
    for p in pieces:
        assert p.length > 0
        seen[p.doc_id].append(p)
    assert set(docs) == set(seen)
    for i, ids in docs.items():
        for total in {len(x) for x in ids}:
            covered = Counter(k for p in seen[i] if p.doc_tokens == total for k in range(p.start, p.start + p.length))
            assert covered == Counter(k for x in ids if len(x) == total for k in range(total))
            for p in seen[i]:
                if p.doc_tokens == total:
                    assert p.ids_crc32 in {crc(x[p.start : p.start + p.length]) for x in ids if len(x) == total}
        assert {p.doc_tokens for p in seen[i]} == {len(x) for x in ids}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    short = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size and at & (at - 1) == 0
        short += at < size
    assert short <= size.bit_length()  # one rest, cut into different powers of two
    return pieces


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    pieces = check(rows, packing.op11_packing(spark, SF))
    cut = Counter(p.doc_id for p in pieces if p.doc_tokens <= 2048)
    assert sum(n > 1 for n in cut.values()) < len(rows) * 0.5


def test_many_tasks_merge_in_rounds(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["red", "blue", "Greenish", "a,b"], k=rng.randrange(60)))) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(150)
    out = packing.pack(docs, size=64, most=3, with_ids=True)
    for p in out.collect():
        assert crc(np.frombuffer(p.ids, dtype="<u4")) == p.ids_crc32 and len(p.ids) == 4 * p.length
    check(rows, out.drop("ids"), 64)


def test_odd_rows(spark, made):
    rows = [
        (1, None), (2, ""), (None, "a b"), (None, "a b"), (3, " \t\n"), (4, "word " * 400_000), (5, "x" * 300_000), (7, "é ü \x1c!\x1fz"), (7, "twice"),
        (7, "twice"), (8, "<|endoftext|> it's"), *[(9, "equal rows")] * 500,
    ]
    at = made("documents", [(*r, 1, 2, "x") for r in rows], "doc_id long, text string, start int, part int, ids string")
    check(rows, packing.op11_packing(spark, at))


def test_empty_table(spark, made):
    at = made("documents", [], "doc_id long, text string")
    assert packing.op11_packing(spark, at).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("ab1'sé!  \x1c\x1f\x85　​") + [" ", "  ", "\n", "\t", "\r\n", "'ll", "<|endoftext|>"]), max_size=40).map("".join))
def test_pieces_encode_like_whole_texts(text):
    (ids,) = packing.token_ids(pa.array([text]), PATH)
    assert ids.tolist() == reference(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["to", " to", " be", " or", "\n not", "\tbe", " é", " ü\x1c", "  x", "　字", " " * 3, "\xa0", "z" * 40]), max_size=15).map("".join), max_size=8), st.integers(0, 3))
def test_remembered_pieces_encode_like_whole_texts(texts, most):
    encoder, packing.KNOWN_PIECES = packing._encoder(PATH), most
    try:
        for _ in range(3):
            assert [x.tolist() for x in encoder.encode(texts)] == [reference(t) for t in texts]
            assert [x.tolist() for x in encoder.encode_column(pa.array(texts, pa.string()).slice(0))] == [reference(t) for t in texts]
            assert [x.tolist() for x in encoder.encode_column(pa.array(texts, pa.string()).slice(1))] == [reference(t) for t in texts[1:]]
    finally:
        packing.KNOWN_PIECES = 1 << 19


@given(st.lists(st.integers(1, 200), max_size=60), st.integers(1, 5))
def test_windows_stay_bounded_and_lose_nothing(sizes, most):
    packer, closed = packing.Packer(32, most), []
    for k, n in enumerate(sizes):
        for pieces in packer.put(k, 0, np.arange(n)):
            assert sum(len(p[2]) for p in pieces) == 32
            closed.append(pieces)
        assert len(packer.open) <= most and all(0 < w[0] < 32 for w in packer.open)
    closed += [*packer.merge(), *packer.close()]
    assert not packer.open
    got = Counter((row, int(x)) for pieces in closed for row, start, ids in pieces for x in ids)
    assert got == Counter((k, x) for k, n in enumerate(sizes) for x in range(n))
    assert all(start == ids[0] for pieces in closed for _, start, ids in pieces)


def test_best_fit():
    packer = packing.Packer(10, 2)
    put = lambda row, n: list(packer.put(row, 0, np.arange(n)))
    assert put("a", 6) == [] and put("b", 7) == []
    (closed,) = put("c", 3)  # fits both; the smaller gap is b's
    assert [p[0] for p in closed] == ["b", "c"]
    put("d", 9)
    (closed,) = put("e", 8)  # fits neither: d, the fullest, gets its head
    assert [(p[0], p[1], len(p[2])) for p in closed] == [("d", 0, 9), ("e", 0, 1)]
    assert sorted(w[0] for w in packer.open) == [3, 4]


def test_ids_of_remembered_pieces_lie_in_one_array():
    encoder = packing.Encoder(PATH)
    texts = ["to be or not to be", "be " + "z" * 99, "", "to\n be or", " "]
    for _ in range(2):
        for column in (texts, texts[::-1]):
            assert [x.tolist() for x in encoder.encode_column(pa.array(column))] == [reference(t) for t in column]
    known = encoder.new
    # a long piece leaves neither a place nor ids behind
    assert max(len(p) for p in known.places if p) <= packing.KNOWN_CHARS
    assert len(known.ids) == known.counts.sum() and len(known.places) == len(known.counts)
    for piece, place in known.places.items():
        ids, _ = known.of(np.array([place]))
        assert ids.tolist() == (reference(piece)[:-1] if piece is not None else [packing.END])
