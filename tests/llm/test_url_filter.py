import math

from barlake.llm import url_filter

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [
        (len(h + p), h + p, v) for v, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def check(rows, out):
    by = {r.page_id: r for r in out}
    assert len(out) == len(rows)
    for page_id, url in rows:
        r = by[page_id]
        assert (r.host, r.path) == parts(url)
        name, verdict = rule(r.host, r.path)
        assert r.rule == name and r.verdict in ("allow", "block")
        if verdict:
            assert r.verdict == verdict


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    check(rows, url_filter.op7_url_filter(spark, SF).collect())


def test_odd_urls(spark, made):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?q", "a://example.org/en/1#f", "a://example.org/en/2",
        "a://notexample.org/es/", "x://org", "x://org/", "x://a.com?u=://b/c", "x://a.com/fr/\ny", "x://É.com/de/1", "://b.com/de/",
        "x://com/fr/" + "z" * 5000,
    ]
    rows = list(enumerate(urls)) + [(100, urls[4]), (None, urls[5])]
    at = made("pages", [(*r, 1, "x") for r in rows], "page_id long, url string, score int, grams string")
    check(rows, url_filter.op7_url_filter(spark, at).collect())


def test_empty_table_and_labels_of_one_kind(spark, made):
    at = made("pages", [], "page_id long, url string")
    assert url_filter.op7_url_filter(spark, at).collect() == []
    pages = spark.createDataFrame([(1, "a://b.net/c")], "page_id long, url string")
    none = spark.createDataFrame([], "url string, label int")
    assert url_filter.judge(pages, labelled=none).first().verdict == "allow"
    only = spark.createDataFrame([("a://b/c", 1)], "url string, label int")
    assert url_filter.judge(pages, labelled=only).first().verdict == "block"


def test_regression_learns_held_out_urls(spark):
    def url(i):
        kind = "casino-win" if i % 2 else "library-news"
        return f"http://{kind}{i * 37 % 101}.net/{'bonus' if i % 2 else 'article'}/{i}", i % 2

    labelled = spark.createDataFrame([url(i) for i in range(0, 400)], "url string, label int")
    held = [(i, *url(i)) for i in range(400, 600)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in held], "page_id long, url string")
    out = {r.page_id: r for r in url_filter.judge(pages, rules=(), labelled=labelled).collect()}
    right = sum((out[i].verdict == "block") == bool(y) for i, _, y in held)
    assert right >= 195 and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in out.values())


def test_a_rare_label_is_in_the_sample_of_a_large_table(spark):
    known = spark.range(60_000).selectExpr("concat('http://library', id % 101, '.net/article/', id) as url", "0 as label")
    rare = spark.createDataFrame([(f"http://casino-win{i}.net/bonus/{i}", 1) for i in (0, 2, 3)], "url string, label int")  # none is in a third of all URLs by hash
    pages = spark.createDataFrame(
        [(1, "http://library7.net/article/99999"), (2, "http://casino-win9.net/bonus/77")], "page_id long, url string"
    )
    out = {r.page_id: r for r in url_filter.judge(pages, rules=(), labelled=known.union(rare)).collect()}
    assert out[1].verdict == "allow" and out[1].score is not None and out[2].score > out[1].score


def test_after_an_observation(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation("seen")
    spark.range(10).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 10
    assert url_filter.op7_url_filter(spark, SF).filter("score is not null").count() > 0


def test_score_by_hand(spark):
    """The score of each url, from n-grams cut in Python and the fitted weights."""
    import random

    draw = random.Random(5)
    urls = [f"https://{draw.choice(['a', 'shop', 'x-y'])}.{draw.choice(['net', 'com', 'org'])}/{draw.choice(['de', 'fr', 'es'])}/{i}" for i in range(60)]
    labelled = spark.createDataFrame([(u, int("/de/" in u)) for u in urls], "url string, label int")
    pages = spark.createDataFrame(list(enumerate([*urls, None, "a://é.net/ü?q"])), "page_id long, url string")
    host, path = url_filter.split_url("url")
    model = url_filter.fit(labelled.select(host.alias("host"), path.alias("path"), "label").distinct(), features=256)
    out = url_filter.judge(pages, labelled=labelled, features=256).collect()
    grams = {}
    for r in out:
        cut = set()
        for mark, text in (("h", f"^{r.host}$"), ("p", f"^{r.path}$")):
            for n in url_filter.NGRAM:
                cut |= {mark + text[i : i + n] for i in range(max(len(text) - n + 1, 1))}
        grams[r.page_id] = cut
    every = sorted(set().union(*grams.values()))
    at = {r.g: r.h % 256 for r in spark.createDataFrame([(g,) for g in every], "g string").selectExpr("g", "hash(g) as h").collect()}
    for r in out:
        total = model.intercept + sum(model.weights[b] for b in {at[g] for g in grams[r.page_id]})
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    assert all((r.verdict == "block") == ("/de/" in urls[r.page_id]) for r in out if r.page_id < 60 and r.rule is None)
