import hashlib

import numpy as np

from barlake.llm import fingerprints as fp

SF = "/root/testdata/sf0.001"


def following(rows):
    """Each distinct (doc_id, text) and the text after it in descending doc_id."""
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    return {row: order[(k + 1) % len(order)][1] for k, row in enumerate(order)}


def check(rows, out):
    after = following(rows)
    want = []
    for i, text in rows:
        text = text or ""
        nxt = after[(i, text)]
        edit = text[: len(text) - len(text) // 3] + nxt[: len(text) // 3]
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), text, edit, nxt))
    got = {}
    for r in out:
        got.setdefault((r.doc_id, r.n_chars, r.edited_sha256), []).append(r)
    assert len(out) == len(rows)
    texts = sorted({t for w in want for t in w[3:]})
    sketch = dict(zip(texts, fp.sketches(texts)))
    for i, n, sha, text, edit, nxt in want:
        r = got[(i, n, sha)].pop()
        assert r.fingerprint == fp.written(sketch[text]) and r.edited_fingerprint == fp.written(sketch[edit])
        assert r.near_edited == fp.likeness(sketch[text], sketch[edit]) and r.near_next == fp.likeness(sketch[text], sketch[nxt])


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = fp.op4_fingerprints(spark, SF).collect()
    check(rows, out)
    long = [r for r in out if r.n_chars > 600]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_odd_rows(spark, made):
    rows = [
        (5, "abc " * 50), (5, "abc " * 50), (5, "zz"), (9, None), (8, ""), (3, "é漢😀" * 40), (-4, "x" * 5000), (None, "tail one"),
        (None, None), (7, "the quick brown fox " * 3000), (100, "top"), (100, "also top"), (2**62 + 1, "far"), (2**62 + 2, "farther"), (2**62 + 3, "no"),
    ]
    at = made("documents", [(*r, 1, "s") for r in rows], "doc_id long, text string, bucket int, role string")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for parts in (1, 2, 3, 7, 50):
        check(rows, fp.fingerprint_edits(docs, parts).collect())


def test_one_row_none_and_only_nulls(spark, made):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    check([(1, "abcdef")], fp.fingerprint_edits(one).collect())
    nulls = spark.createDataFrame([(None, "a b c"), (None, "d e f")], "doc_id long, text string")
    check([(None, "a b c"), (None, "d e f")], fp.fingerprint_edits(nulls).collect())
    at = made("documents", [], "doc_id long, text string")
    assert fp.op4_fingerprints(spark, at).collect() == []


def test_equal_substrings_share_phrases_at_any_offset():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefghij klmnop"), 20_000))
    for shift in (1, 2, 3, 17, 1000):
        a, b = fp.sketches([text, "q" * shift + "some other start " + text])
        assert fp.likeness(a, b) > 0.9
    assert fp.likeness(*fp.sketches([text[:9000], text[9000:18000]])) < 0.1


def test_coin_tossing_keeps_neighbours_apart():
    x = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    first = np.zeros(5000, bool)
    first[0] = True
    for _ in range(fp.TOSSES):
        x = fp._tossed(x, first)
        assert (x[2:] != x[1:-1]).all()
    assert x.max() < 6


def test_likeness_follows_the_share_kept():
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefghij klmnop"), 30_000))
    values = [fp.likeness(*fp.sketches([text, text[:keep]])) for keep in (30_000, 20_000, 10_000)]
    assert values[0] == 1 and abs(values[1] - 2 / 3) < 0.25 and abs(values[2] - 1 / 3) < 0.25


def test_fingerprints_of_a_table(spark):
    docs = spark.createDataFrame([(1, "same text"), (2, "same text"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert got[1] == got[2] != "" and got[3] == "" and fp.written(fp.read(got[1])) == got[1]


def test_all_names_of_all_levels_are_returned_and_compared(spark):
    rng = np.random.default_rng(8)
    make = lambda n: "".join(rng.choice(list("abcdefghij klmnop"), n))
    passage = make(3000)
    texts = [make(300_000) + passage + make(300_000), make(200_000) + passage + make(400_000), "a short text of few phrases", None]
    rows = [(10 - i, t) for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sketch = {i: fp.sketches([t or ""])[0] for i, t in rows}
    for i, _ in rows:
        assert [np.array(x, np.int32).view(np.uint32).tolist() for x in out[i].phrases] == [x.tolist() for x in sketch[i]]
    assert [len(x) for x in sketch[10]][2] > 10_000 and out[10].common_next[2] > 60 and out[10].near_next > 0
    assert [x.tolist() for x in fp.read(out[10].fingerprint)] == [x.tolist() for x in sketch[10]] and out[8].common_edited[0] > 0 and out[8].near_edited > 0
    assert out[7].phrases == [[], [], []]


def plain(text):
    """The parse, symbol by symbol: the names of each level in order."""
    mix = lambda x: int(fp.mixed(np.array([x % 2**64], np.uint64))[0])
    names, levels = [mix(ord(c) + 1) for c in text], []
    while True:
        symbols = []
        for k, n in enumerate(names):
            if k and n == names[k - 1]:
                symbols[-1][1] += 1
            else:
                symbols.append([n, 1])
        symbols = [mix(n + k * 0x9E3779B97F4A7C15) if k > 1 else n for n, k in symbols]
        labels = symbols
        for _ in range(fp.TOSSES):
            tossed = []
            for k, x in enumerate(labels):
                apart = x ^ (labels[k - 1] if k else x ^ 1)
                place = (apart & -apart).bit_length() - 1
                tossed.append(2 * place + (x >> place & 1))
            labels = tossed
        start = [0] + [k for k in range(1, len(labels) - 1) if labels[k - 1] < labels[k] > labels[k + 1]]
        names = []
        for a, b in zip(start, [*start[1:], len(symbols)]):
            names.append(mix(sum(symbols[k] * int(fp._WEIGHTS[(k - a) % 64]) for k in range(a, b)) + b - a))
        levels.append(names)
        if len(levels) >= fp.LEVELS and len(names) <= fp.MORE_PHRASES:
            return levels


def test_parse_by_hand(monkeypatch):
    """Names of short and long texts, whole and piece by piece, against a plain parse."""
    monkeypatch.setattr(fp, "MORE_PHRASES", 5)
    rng = np.random.default_rng(4)
    texts = ["a", "ab", "aaaa", "abab" * 9, "x" * 700 + "yz" + "x" * 900, "".join(rng.choice(list("ab c"), 3000)), "".join(rng.choice(list("abcdefgh é漢"), 2500)), "q" * 300 + "".join(rng.choice(list("abc"), 900))]
    want = [[sorted({n >> 32 for n in level}) for level in plain(t)] for t in texts]
    for block in (1 << 18, 1000, 64, 7, 1):
        monkeypatch.setattr(fp, "BLOCK_BYTES", block)
        assert [[level.tolist() for level in sketch] for sketch in fp.sketches(texts)] == want, block


def test_a_shift_costs_a_long_text_no_more_than_a_short_one():
    rng = np.random.default_rng(6)
    lost = []
    for n in (200_000, 2_000_000):
        text = "".join(rng.choice(list("abcdefghij klmnop"), n))
        a, b = fp.sketches([text, "".join(rng.choice(list("abcdef"), 1000)) + text])
        lost.append([len(np.setdiff1d(x, y)) for x, y in zip(a, b)])
    assert all(x <= 6 for x in lost[0]) and all(x <= 6 for x in lost[1]), lost
    assert len(lost[1]) > len(lost[0]) > fp.LEVELS


def test_likeness_is_that_of_the_fingerprints(spark):
    rows = [(i, f"text number {i} with some words " * (i + 1)) for i in range(30)] + [(40, None), (41, "")]
    out = {r.doc_id: r for r in fp.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(out, reverse=True)
    for i, following in zip(order, [*order[1:], order[0]]):
        r = out[i]
        assert r.near_edited == fp.likeness(fp.read(r.fingerprint), fp.read(r.edited_fingerprint))
        assert r.near_next == fp.likeness(fp.read(r.fingerprint), fp.read(out[following].fingerprint))
