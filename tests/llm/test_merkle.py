"""The manifest against a tree built node by node in Python, and every version against a tree built anew."""

import hashlib
import random
import zlib

import oracle

from barlake.llm import merkle

SF = "/root/testdata/sf0.001"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        first = at - at % 16
        run = level[first : first + 16]
        yield run[: at % 16], run[at % 16 + 1 :]
        at //= 16


def brute(rows, again=3):
    """All rows of the query; ``again`` tampered rows have their folded root from a whole new tree."""
    low = lambda t: t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    key = lambda s: (s is not None, (s or "").encode())
    names = sorted(by, key=key)
    for name in names:
        by[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {name: levels([leaf(r) for r in by[name]]) for name in names}
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for i, r in enumerate(by[name]):
            path = [*siblings(trees[name], i), *siblings(top, k)]
            spoiled = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            start = folded = leaf([*r[:4], low(r[4])]) if spoiled else leaf(r)
            for left, right in path:
                folded = digest("".join([*left, folded, *right]))
            if spoiled and again:
                again -= 1
                anew = list(trees[name][0])
                anew[i] = start
                subroots = list(top[0])
                subroots[k] = levels(anew)[-1][0]
                assert folded == levels(subroots)[-1][0]
            proof = digest("".join("".join(left) + "".join(right) for left, right in path))
            out.append((r[0], leaf(r), trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def check(rows, out):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert out.columns == columns
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(brute([r[:5] for r in rows]), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def test_query_matches_sql(spark):
    assert oracle.compare(merkle.op13_merkle(spark, SF), oracle.connect(SF), merkle.OP13_SQL) is None


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    check([tuple(r) for r in docs.collect()], merkle.op13_merkle(spark, SF))


def test_sources_of_all_sizes(spark, made):
    """One leaf, full and broken runs, one block and one over, a source with most rows, many sources."""
    rng, rows = random.Random(3), []
    for name, n in (("one", 1), ("Two", 2), ("run", 16), ("over", 17), ("block", 256), ("broken", 257), ("hot", 5000), (None, 40), ("", 3), ("é", 18)):
        ids = rng.sample(range(10**6), n)
        rows += [(i, name, rng.choice(["en", None]), i % 7, rng.choice([f"Text {i}", f"low {i}"])) for i in ids]
    rows += [(i, f"s{i:03}", "en", 1, f"T{i}") for i in range(300)]
    rng.shuffle(rows)
    at = made("documents", rows, SCHEMA)
    check(rows, merkle.op13_merkle(spark, at))


def test_odd_rows(spark, made):
    rows = [
        (None, "a", None, None, None, "x", 1), (None, "a", None, None, None, "x", 1), (5, "a", "en", 0, "", "x", 1), (5, "a", "en", None, None, "x", 1),
        (5, "a", "en", 3, "ABC", "y", 2), (5, "a", "en", 3, "ABC", "y", 2), (10, "=", "en", 3, "É\nZ:", "y", 2), (-3, None, "-", 3, "-", None, None),
        (9, "b", "de", 1, "Long " * 400_000, "z", 3), (17, "b", "de", 1, "x" * 3_000_000, "z", 3), *[(20, "c", "en", 1, "Same", "y", 2)] * 700,
    ]
    at = made("documents", rows, SCHEMA + ", tree string, pos int")
    check(rows, merkle.op13_merkle(spark, at))


def test_empty_table(spark, made):
    at = made("documents", [], SCHEMA)
    assert merkle.op13_merkle(spark, at).collect() == []


def test_versions_share_what_they_don_t_copy(spark):
    """A version's own nodes are its leaf's ancestors; without tampering they are the tree's."""
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    tree = levels([leaf(r) for r in rows])
    for r in merkle.manifest(docs).collect():
        assert r.version == [level[r.pos // 16**k] for k, level in enumerate(tree)] and r.verified
    from pyspark.sql import functions as F

    (r,) = merkle.manifest(docs, F.col("doc_id") == 300).filter("not verified").collect()
    changed = levels([leaf([*x[:4], x[4].lower()]) if x[0] == 300 else leaf(x) for x in rows])
    assert r.version == [level[300 // 16**k] for k, level in enumerate(changed)]
