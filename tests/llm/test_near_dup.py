"""Near-dedup against all pairs worked out in Python."""

import itertools
import random
import re

import numpy as np
import oracle
import pyarrow as pa
import pytest

from barlake.llm import near_dup
from barlake.llm.components import components, contracted, told

SF = "/root/testdata/sf0.001"


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def brute(rows, k=2):
    """doc_id -> component over all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return {i: root(i) for i in parent}


def check(rows, out, k=2):
    want = brute(rows, k)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=repr)
    expected = [(i, len(shingles(t, k)), want.get(i), i == want.get(i)) for i, t in rows]
    assert got == sorted(expected, key=repr)


def test_query_matches_sql(spark):
    assert oracle.compare(near_dup.op1_near_dup(spark, SF), oracle.connect(SF), near_dup.OP1_SQL) is None


def test_odd_rows(spark, made):
    rows = [
        (5, "one"), (3, "ONE"), (8, "one two"), (9, None), (10, ""), (11, " \t\n"), (12, "one  TWO\n"), (None, "one two"), (20, "é É"), (21, "é é"),
        (30, "a b " * 4000), (31, "b a " * 3999 + "b"), (40, "x" * 2_500_000 + " y"), (41, "x" * 2_500_000 + " y"), (42, "w " * 1_500_000), (5, "one"),
    ]
    at = made("documents", [(*r, 1, "x") for r in rows], "doc_id long, text string, id int, cls string")
    out = near_dup.op1_near_dup(spark, at).collect()
    assert len(out) == len(rows)
    check(rows, out)


def test_empty_table(spark, made):
    at = made("documents", [], "doc_id long, text string")
    assert near_dup.op1_near_dup(spark, at).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_broad_families_of_near_copies(spark, seed):
    """Families whose members are often not linked to each other, chains, hot passages, copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows, ids = [], iter(rng.sample(range(10_000), 2_000))
    for size, edits in ((150, 14), (40, 5), (12, 9)):
        base = [word() for _ in range(110)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(len(own))] = word()
            rows.append((next(ids), " ".join(own)))
    chain = [word() for _ in range(80)]
    for _ in range(25):  # each is near the one before only
        chain = chain[4:] + [word() for _ in range(4)]
        rows.append((next(ids), " ".join(chain)))
    passage = " ".join(word() for _ in range(30))
    rows += [(next(ids), passage + " " + " ".join(word() for _ in range(rng.randrange(3, 30)))) for _ in range(120)]
    rows += [(next(ids), rows[0][1]) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, near_dup.near_duplicates(docs, near_dup.TWO_WORDS).collect())
    check(rows, near_dup.near_duplicates(docs).collect(), k=5)


def executed(plan):
    """The nodes of a plan that has run."""
    yield plan
    if plan.nodeName() == "AdaptiveSparkPlan":
        inner = [plan.executedPlan()]
    elif plan.nodeName().endswith("QueryStage"):
        inner = [plan.plan()]
    else:
        inner = [plan.children().apply(i) for i in range(plan.children().size())]
    for child in inner:
        yield from executed(child)


def test_an_id_meets_a_centre_once(spark, monkeypatch):
    """However many keys of near copies draw the same centre, a round makes one row of the two."""
    rng, rounds, close = random.Random(3), [], near_dup._close
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    base, rows = [word() for _ in range(110)], []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(14)):
            own[rng.randrange(len(own))] = word()
        rows.append((i, " ".join(own)))

    def kept(pairs, *more):
        rounds.append(pairs)
        return close(pairs, *more)

    monkeypatch.setattr(near_dup, "_close", kept)
    check(rows, near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dup.TWO_WORDS).collect())
    rounds = [pairs for pairs in rounds if "ca" in pairs.columns]
    assert rounds
    for pairs in rounds:
        distinct = len(pairs.collect())
        made = [n.metrics().apply("numOutputRows").value() for n in executed(pairs._jdf.queryExecution().executedPlan()) if n.nodeName() == "Generate"]
        assert len(made) == 1 and distinct <= made[0] <= 2 * distinct  # two centres that meet are met from both sides


def test_a_star_round_shuffles_little(spark, monkeypatch):
    """Each shuffle is as many tasks as there are partitions, and the driver keeps something of every task.

    Open rows bring their centres along, an id is grouped once, and what is shuffled again is its centres' signatures.
    """
    rounds, close = [], near_dup._close

    def kept(pairs, *more):
        out = close(pairs, *more)
        rounds.append((out.distinct() if "ca" in pairs.columns else out, "ca" in pairs.columns))
        return out

    monkeypatch.setattr(near_dup, "_close", kept)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(110)]
    rows = [(i, " ".join(f"{w}x{i}" if j in own else w for j, w in enumerate(base))) for i in range(150) for own in [rng.sample(range(110), i % 14)]]
    check(rows, near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dup.TWO_WORDS).collect())
    assert {star for _, star in rounds} == {False, True}
    at = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(at)
    spark.conf.set(at, -1)
    try:
        for out, star in rounds:
            plan = out.select("*")._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") <= 4 + star, plan
    finally:
        spark.conf.set(at, before)


def test_rows_that_share_a_doc_id_are_one_document(spark):
    a, b = "p q r s t u v w", "k l m n o h i j"
    rows = [(4, a), (9, b), (9, a), (7, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(docs, near_dup.TWO_WORDS).collect()} == {4}


def test_pairs_within_the_guarantee_share_a_key():
    scheme, rng = near_dup.TWO_WORDS, np.random.default_rng(5)
    base = rng.integers(0, 65536, scheme.values).astype(np.uint16)
    for _ in range(300):
        other = base.copy()
        other[rng.choice(scheme.values, scheme.guaranteed, replace=False)] ^= 1
        assert np.isin(*near_dup.keys(np.stack([base, other]), scheme)).any()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    scheme = near_dup.Scheme(chunks=80)
    shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = near_dup.signatures([np.concatenate((shared, a)), np.concatenate((shared, b))], scheme)
    assert abs((x == y).mean() - 0.8) < 0.07


def test_shingle_sets_don_t_depend_on_blocks():
    texts = ["Some WORDS here and there", None, "", "x", "tail of the block"] * 400
    by = {}
    for start, stop, sets in near_dup.shingle_sets(pa.array(texts), 2):
        for t, s in zip(texts[start:stop], sets):
            by.setdefault(t, []).append(s.tolist())
            assert len(s) == len(shingles(t, 2))
    assert all(len(v) == 400 and all(x == v[0] for x in v) for v in by.values())


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, j) for j in range(200, 400)] + [(5, 5), (9, 8), (8, 9), (9, 8)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {j: 7 for j in [7, *range(200, 400)]} | {8: 8, 9: 8}
    assert got == want


def test_components_of_many_links_are_found_by_all_tasks(spark):
    """The same components where the links are too many for one task."""
    links = [(i, i + 1) for i in range(100, 160)] + [(7, j) for j in range(200, 400)] + [(5, 5), (9, 8), (8, 9), (9, 8)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    want = {(i, 100) for i in range(100, 161)} | {(j, 7) for j in [7, *range(200, 400)]} | {(8, 8), (9, 8)}
    assert {tuple(r) for r in components(df, small=3).collect()} == want


@pytest.mark.parametrize("small", [2, 10_000])
def test_labels_after_more_links(spark, small):
    rng = random.Random(small)
    parent, labels = {i: i for i in range(200)}, None
    for _ in range(4):
        more = [(rng.randrange(200), rng.randrange(200)) for _ in range(40)]
        for a, b in more:
            x, y = sorted((parent[a], parent[b]))
            parent = {i: x if p == y else p for i, p in parent.items()}
        df = spark.createDataFrame(more, "a long, b long")
        labels = contracted(labels, df if labels is None else told(df, labels), small)
        assert {(r.id, r.component) for r in labels.collect()} == {(i, p) for i, p in parent.items() if i != p}


def test_one_document_of_each_group_stays(spark):
    text = "the same eight words stand here twice over"
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (None, text, "c"), (8, "other text altogether", "d"), (9, None, "e"), (10, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = near_dup.without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([rows[1], rows[3], rows[4], rows[5], rows[6]], key=repr)


def test_keys_without_open_members_are_not_compared(spark, monkeypatch):
    """What isn't needed isn't planned: each plan of a comparison costs the driver memory."""
    monkeypatch.setattr(near_dup, "_compared", None)
    rows = [(1, "a b c d e"), (2, "A b c d e"), (3, "v w x y z"), (4, None)]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dup.TWO_WORDS)
    check(rows, out.collect())
