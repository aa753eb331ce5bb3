import base64
import hashlib
import random

import oracle

from barlake.llm import warc

SF = "/root/testdata/sf0.001"


def want(rows, least=0):
    first = {}
    for i, _, html in rows:
        html = html or ""
        if i is not None and len(html.encode()) >= least:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        f = first.get(html or "") if i is not None else None
        seen = f is not None and f != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if seen else "response", f if seen else None))
    return sorted(out, key=repr)


def test_query_matches_sql(spark):
    assert oracle.compare(warc.op5_warc(spark, SF), oracle.connect(SF), warc.OP5_SQL) is None


ROWS = [
    (7, "http://a.org/x", "same"), (3, "http://A.org/x", "same"), (9, "http://www.a.org/x?y#z", "same"), (1, None, None), (2, "no scheme", ""),
    (4, "http://b.com/\r\nWARC/1.0\n", "é漢😀\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n"), (None, "http://n/", "same"), (3, "http://a.org/x", "same"),
    (10, "http://c/", "z" * 300_000), (11, "http://c/", "z" * 300_000),
]


def test_odd_pages(spark, made):
    at = made("pages", [(*r, 1, "x") for r in ROWS], "page_id long, url string, html string, first int, value string")
    out = sorted((tuple(r) for r in warc.op5_warc(spark, at).collect()), key=repr)
    assert out == want(ROWS)


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    out = warc.archived(pages, least=5).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in out), key=repr) == want(ROWS, 5)


def test_payloads_survive_and_index_is_ordered(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, f"http://{rng.choice('abc')}.example.org/{rng.randrange(4)}", f"page {rng.randrange(60)}") for i in rng.sample(range(1000), 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, file_records=20)
    read = warc.read_archives(spark, path, with_payload=True)
    html = {i: h for i, _, h in rows}
    found = {r.page_id: r for r in read.collect()}
    assert all(found[i].payload.decode() == h for i, h in html.items() if found[i].record_type == "response")
    assert all(html[r.refers_to] == html[i] for i, r in found.items() if r.refers_to is not None)
    index = warc.capture_index(warc.read_archives(spark, path), range_rows=40).collect()
    assert len(index) == len(rows) and len({r.range for r in index}) > 3
    keys = [(r.url_key, r.captured, r.page_id) for r in sorted(index, key=lambda r: (r.range, r.position))]
    assert keys == sorted(keys)


def test_one_url_for_all_captures_is_cut_into_ranges(spark):
    pages = spark.createDataFrame([(i, "http://hot/", str(i)) for i in range(2000)], "page_id long, url string, html string")
    counts = warc.capture_index(_records(spark, pages), range_rows=100).groupBy("range").count().collect()
    assert len(counts) >= 15 and max(r["count"] for r in counts) < 400


def _records(spark, pages):
    path = warc.work_dir(spark, "warc-test")
    warc.write_archives(pages, path)
    return warc.read_archives(spark, path)


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.choice("abc"), "t", rng.randrange(9), r) for _ in range(rng.randrange(12))) for r in range(k)]
        out = list(warc.LoserTree(runs))
        assert [o[:3] for o in out] == sorted(x[:3] for r in runs for x in r)
        assert [o for o in out] == sorted((x for r in runs for x in r), key=lambda x: (x[:3], x[3]))


def test_url_keys():
    assert warc.url_key("HTTP://www.B.example.org/P?q#f") == "org,example,b)/p?q"
    assert warc.url_key(None) == warc.url_key("no scheme") == ")"


def test_empty_table(spark, made):
    at = made("pages", [], "page_id long, url string, html string")
    assert warc.op5_warc(spark, at).collect() == []
