"""Encoding against the tiktoken library, exact round trips, offsets, and section counts."""

import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.llm import bpe, token_counts

SF = "/root/testdata/sf0.001"
PATH = bpe.vocabulary_path()
ENC = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
ODD = [
    None, "", " ", "\n\n  \t x", "don't we'll I'VE", "漢字 かな 😀👍🏽", "é́​﻿", "<|endoftext|>", "a" * 3000,
    "-" * 777 + "=" * 65, "\x85\xa0\x1c", ("lorem ipsum 123 " * 9000) + "fin", "x" * 70000 + " y " * 20000,
]


def expected(text):
    ids = ENC.encode_ordinary(text or "")
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = bpe.op3_bpe(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        assert tuple(r)[1:] == expected(texts[r.doc_id])


def test_odd_texts_repeats_and_extra_columns(spark, made):
    rows = [*enumerate(ODD), (3, ODD[4]), (None, ODD[5]), (3, ODD[4])]
    at = made("documents", [(*r, 7, "x") for r in rows], "doc_id long, text string, n_tokens int, ids_sha256 string")
    out = sorted((tuple(r) for r in bpe.op3_bpe(spark, at).collect()), key=repr)
    assert out == sorted(((i, *expected(t)) for i, t in rows), key=repr)


def test_empty_table(spark, made):
    at = made("documents", [], "doc_id long, text string")
    assert bpe.op3_bpe(spark, at).collect() == [] and token_counts.op6_token_counts(spark, at).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n'-aeinst1é")), max_size=80))
def test_any_text(text):
    ids = bpe.encode_texts([text], PATH)[0].tolist()
    assert ids == ENC.encode_ordinary(text) and bpe.decode_bytes(ids, PATH).decode() == text


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab' \n\t1é-"), max_size=60), st.integers(1, 9))
def test_parts_never_cut_a_token(text, size):
    cut = list(bpe.parts(text, size))
    assert "".join(cut) == text
    assert [i for p in cut for i in ENC.encode_ordinary(p)] == ENC.encode_ordinary(text)


def test_encode_offsets_and_decode(spark):
    texts = ["naïve 😀 café\n", "", None, "漢"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = bpe.encode(docs)
    for r in out.collect():
        text = texts[r.doc_id] or ""
        assert r.n_tokens == len(r.token_ids) == len(r.token_starts) == len(r.token_ends)
        at = 0
        for i, s, e in zip(r.token_ids, r.token_starts, r.token_ends):
            piece = bpe.token_bytes(PATH)[i]
            whole = text[s:e].encode()
            assert piece in whole and len(text[:s].encode()) <= at < at + len(piece) <= len(text[:e].encode())
            at += len(piece)
    back = {r.doc_id: r for r in bpe.decode(out).collect()}
    assert all(back[i].text == (t or "") and back[i].raw == (t or "").encode() for i, t in enumerate(texts))
    half = spark.createDataFrame([(0, bpe.encode_texts(["漢"], PATH)[0].tolist()[:1])], "doc_id long, token_ids array<int>")
    assert bpe.decode(half).first().text.startswith("�")


def test_kept_columns_named_like_results(spark):
    docs = spark.createDataFrame([(1, "a b", 9, "s")], "doc_id long, text string, n_tokens int, source string")
    out = bpe.encode(docs, keep=docs.columns, with_offsets=False)
    assert out.columns == ["doc_id", "text", "source", "n_tokens", "token_ids"] and out.first().n_tokens == 2


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts_against_brute_force(spark, rule):
    texts = ["one line", "a\nb\n\n\n c d\n", "", None, "x\n", "\n\n", "é\n漢 😀\nz", " \n \n  \n q"]
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id long, text string")
    got = {}
    for r in token_counts.section_tokens(docs, rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.section_start, r.section_end, r.n_tokens))
    for i, text in enumerate(texts):
        text = text or ""
        bounds, at = [], 0
        for part in text.splitlines(keepends=True) or [""]:
            bounds.append((at, at + len(part)))
            at += len(part)
        ids = bpe.encode_texts([text], PATH)[0]
        counts = [0] * len(bounds)
        for s, e in zip(*bpe.offsets(text, ids, PATH)):
            held = [max(0, min(e, b) - max(s, a)) for a, b in bounds]
            touched = [k for k, n in enumerate(held) if n]
            counts[touched[0] if rule == "start" else touched[-1] if rule == "end" else held.index(max(held))] += 1
        want = [(k, a, b, n) for k, ((a, b), n) in enumerate(zip(bounds, counts))]
        assert sorted(got[i]) == sorted(want * (2 if i == 0 else 1)), text


def test_sections_add_up_on_the_whole_table(spark):
    total = {r.doc_id: r.n_tokens for r in bpe.op3_bpe(spark, SF).collect()}
    summed = token_counts.op6_token_counts(spark, SF).groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in summed} == total
