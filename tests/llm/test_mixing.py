"""Mixing against the rule worked out by hand in Python."""

import pytest

from barlake.llm import mixing

SF = "/root/testdata/sf0.001"


def targets(sizes, weights=(5, 2, 1), share=1.0, repeats=3):
    """Cut at the limit and reshare until nothing is above."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, out, free = share * sum(sizes.values()), {}, list(names)
    while free:
        unit = (total - sum(out.values())) / sum(weight[n] for n in free)
        above = [n for n in free if unit * weight[n] > repeats * sizes[n] + 1e-9]
        if not above:
            out |= {n: unit * weight[n] for n in free}
            break
        out |= {n: repeats * sizes[n] for n in above}
        free = [n for n in free if n not in above]
    return out


def size_of(text):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, out):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    expected, taken, largest = targets(sizes), {}, {}
    for r in out:
        assert r.target == pytest.approx(expected[r.source])
        assert r.source_size == sizes[r.source] and 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for source, words in taken.items():
        assert abs(words - expected[source]) <= largest[source] / 2 + 1e-6, source


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    out = mixing.op10_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    check(rows, out)
    again = mixing.op10_mixing(spark, SF).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)


def test_hot_small_null_and_empty_sources(spark, made):
    rows = [(i, "w " * (i % 7 + 1), "big") for i in range(300)]
    rows += [(1000 + i, "a b c", "small") for i in range(4)]
    rows += [(2000, None, "void"), (2001, "", "void"), (3000, "x y", None), (3001, None, None), (None, "p q r", "big")]
    at = made("documents", rows, "doc_id long, text string, source string")
    out = mixing.op10_mixing(spark, at).collect()
    assert len(out) == len(rows)
    check(rows, out)
    assert {r.taken for r in out if r.source == "void"} == {0}


def test_repeated_rows_share_a_decision_and_extra_columns_do_no_harm(spark, made):
    rows = [(i // 2, "a b c d", "s", i, 1, 2.0) for i in range(40)]
    at = made("documents", rows, "doc_id long, text string, source string, size int, h int, target double")
    copies = {}
    for r in mixing.op10_mixing(spark, at).collect():
        copies.setdefault(r.doc_id, set()).add(r.taken)
    assert all(len(v) == 1 for v in copies.values())


def test_empty_table(spark, made):
    at = made("documents", [], "doc_id long, text string, source string")
    assert mixing.op10_mixing(spark, at).collect() == []


def test_larger_budgets_contain_smaller_ones(spark):
    rows = [("s", 1 + i % 5, (i * 2654435761 * 97) % (1 << 60)) for i in range(2000)]
    sized = spark.createDataFrame(rows, "source string, size long, h long")
    amounts = {"a": 100.0, "b": 1500.5, "c": 5999.0, "all": 6000.0, "none": 0.0}
    budgets = spark.createDataFrame([("s", k, v) for k, v in amounts.items()], "source string, budget string, amount double")
    cut = {r.budget: r.threshold for r in mixing.thresholds(sized, budgets).collect()}
    assert cut["none"] <= cut["a"] < cut["b"] < cut["c"] <= cut["all"]
    for name, amount in amounts.items():
        got = sum(s for _, s, h in rows if h < cut[name])
        assert abs(got - amount) <= 2.5


def test_taken_documents_keep_all_columns(spark, made):
    rows = [(i, "a b " * (i % 3 + 1), f"s{i % 2}", "x", i) for i in range(60)]
    at = made("documents", rows, "doc_id long, text string, source string, row string, copy int")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    out = mixing.taken_documents(docs)
    assert out.columns == docs.columns
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_repeated_rows_are_taken_one_by_one(spark, made):
    """Sources of equal rows come as near their targets as a single row allows."""
    rows = [(1, "a b c d", "copies")] * 400 + [(2, "e f", "few")] * 7 + [(i, "w x y", "plain") for i in range(10, 400)]
    at = made("documents", rows, "doc_id long, text string, source string")
    out = mixing.op10_mixing(spark, at).collect()
    assert len(out) == len(rows)
    check(rows, out)
    docs = spark.read.parquet(f"{at}/documents.parquet").repartition(5)
    kept = mixing.taken_documents(docs).groupBy("source").count().collect()
    want = {}
    for r in out:
        want[r.source] = want.get(r.source, 0) + r.copies
    assert {r["source"]: r["count"] for r in kept} == want


def test_a_level_meets_the_documents_by_one_join(spark, monkeypatch, capsys):
    plans, staged = [], mixing.staged

    def seen(df, name):
        if name == "mix-level":
            capsys.readouterr()
            df.explain()
            plans.append(capsys.readouterr().out)
        return staged(df, name)

    monkeypatch.setattr(mixing, "staged", seen)
    sized = spark.createDataFrame([("a", 3, 5 << 50), ("a", 4, 9 << 50), (None, 2, 7)], "source string, size long, h long")
    budgets = spark.createDataFrame([("a", 0, 3.0), (None, 0, 9.0), ("none", 0, 1.0)], "source string, budget int, amount double")
    got = {r.source: r.threshold for r in mixing.thresholds(sized, budgets).collect()}
    assert 5 << 50 < got["a"] <= 9 << 50 and min(got[None], got["none"]) >= 1 << mixing.HASH_BITS
    assert plans and all(plan.count("Join") == 1 for plan in plans)
