"""Variants against all pairs of words worked out in Python."""

import random
import re
import zlib
from collections import Counter

import oracle
import pytest

from barlake.llm import spelling

SF = "/root/testdata/sf0.001"


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def judged(n):
    out, form = [], {}
    near_to = {w: [x for x in n if near(w, x)] for w in n}
    for w, others in near_to.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near_to[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_query_matches_sql(spark):
    assert oracle.compare(spelling.op12_spelling(spark, SF), oracle.connect(SF), spelling.OP12_SQL) is None


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(spelling.op12_spelling(spark, SF)) == judged(words(rows))


@pytest.mark.parametrize("pairs", [1, 30, 1024])
def test_families_that_share_chunks(spark, pairs):
    """Words with one half in common, dense neighbourhoods and chains; small limits split chunks again and again."""
    rng = random.Random(pairs)
    found = {}
    add = lambda w: found.setdefault(w, rng.choice([5, 6, 26, 130, 131, 700]))
    for _ in range(150):
        add("prefix" + "".join(rng.choices("abé", k=rng.randrange(4, 7))))
        add("".join(rng.choices("xy", k=rng.randrange(6, 9))))
    for w in list(found)[:80]:
        i = rng.randrange(len(w))
        add(w[:i] + rng.choice("abxyÿ") + w[i:])
        add(w[:i] + w[i + 1 :] + "q")
    n = {w: k for w, k in found.items() if len(w) >= 6}
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    pair = sorted((r.a, r.b) for r in spelling.near_pairs(df, pairs).collect())
    assert pair == sorted((a, b) for a in n for b in n if near(a, b))
    assert got(spelling.variants(df)) == judged(n)


def test_chains_of_forms(spark):
    n = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzz": 7}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    out = got(spelling.variants(df))
    assert out == judged(n) and {r[2] for r in out} == {"abbbbb", "zzzzzz"}


def test_odd_rows(spark, made):
    long = "m" * 30_000
    rows = [(1, None), (2, ""), (None, "Straße " * 6), (3, "ÀÉÎõü× " * 5 + "ÀÉÎõü÷ " * 40), (4, "café-society " * 9), (5, f"{long} {long}x " * 5),
            (6, "word" * 200_000), *[(7, "Repeated repeatd repeated")] * 20, (8, "short words only\n" * 9), (9, "K" * 6 + " ")]
    at = made("documents", [(*r, 1, "x", 3) for r in rows], "doc_id long, text string, n int, word string, key int")
    assert got(spelling.op12_spelling(spark, at)) == judged(words(rows))


def test_empty_table(spark, made):
    at = made("documents", [], "doc_id long, text string")
    assert spelling.op12_spelling(spark, at).collect() == []


def test_planted_letters_are_lost(spark):
    rows = [(i, "vocabulary " * 3) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.word: r.n for r in spelling.vocabulary(docs, least_count=1).collect()}
    everything = {r.word: r.n for r in spelling.vocabulary(docs, least_count=1, plant=None).collect()}
    assert everything == {"vocabulary": 1800} and sum(kept.values()) == 1800 and len(kept) > 1
