import random
from collections import defaultdict
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from barlake.operators import aggregates, complete, joins, keep, quality, runs, serve, setops, upsert, windows
from barlake.plans import silver

D = date(2024, 1, 1)


def day(n):
    return D + timedelta(days=n)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), (None, 3, "m")], "k string, o int, v string")
    assert as_set(keep.keep_last(df, ["k"], ["o"])) == {("a", 2, "y"), (None, 3, "m")}
    assert as_set(keep.keep_first(df, ["k"], ["o"])) == {("a", 1, "x"), (None, 1, "n")}
    assert keep.keep_any(df.select("k"), ["k"]).count() == 2


def test_daily_build_prefers_primary_even_when_bad(spark):
    primary = spark.createDataFrame(
        [("600000", "2024-01-01 15:00", "10", "10", "11", "9", "100", "1"),
         ("600000", "2024-01-02 15:00", "0", "0", "0", "0", "5", "1"),
         ("600000", "2024-01-03 15:00", "12", "12", "13", "11", "0.5", "x")],
        "stock_code string, datetime string, open string, close string, high string, low string, volume string, amount string")
    secondary = spark.createDataFrame(
        [("sh600000", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0), ("sh600000", "2024-01-04", 6.0, 6.0, 6.0, 6.0, 3.0)],
        "stock_code string, date string, open double, close double, high double, low double, volume double")
    bars, rejects = silver.daily_bars(primary, secondary)
    got = [(r.trade_date, r.close, r.pre_close, r.volume, r.amount, r.change_pct) for r in bars.orderBy("trade_date").collect()]
    assert got == [
        (date(2024, 1, 1), 10.0, None, 100, 1.0, None),
        (date(2024, 1, 3), 12.0, 10.0, 0, None, 20.0),
        (date(2024, 1, 4), 6.0, 12.0, 300, None, -50.0),
    ]
    assert [r.trade_date for r in rejects.collect()] == [date(2024, 1, 2)]


def test_dedup_latest_ties_keeps_ties_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), ("a", "x", 2), ("b", None, 1), ("b", None, 2), (None, "x", 1), ("c", "x", None)],
        "k string, l string, ts int")
    got = sorted(map(str, (tuple(r) for r in aggregates.dedup_latest_ties(df, ["k", "l"], "ts").collect())))
    assert len(got) == 6 and str(("a", "x", 1)) not in got


def test_surrogate_id_is_dense_and_ordered(spark):
    for stem in ("", "SAME-START-"):  # a common start is no single bucket
        codes = [f"{stem}{i * 7:06d}" for i in range(5000)]
        random.Random(1).shuffle(codes)
        df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(7)
        got = windows.surrogate_id(df, "code", 10).orderBy("code").collect()
        assert [r["id"] for r in got] == list(range(11, 5011)) and [r.code for r in got] == sorted(codes)
    assert windows.surrogate_id(df.filter("false"), "code").collect() == []
    own = windows.surrogate_id(df, "code", bucket=F.substring("code", 1, 13)).orderBy("code").collect()
    assert [r["id"] for r in own] == list(range(1, 5001))


def test_pre_close_chunked_equals_plain_with_a_hot_key(spark):
    rng = random.Random(2)
    rows, start = [], datetime(2024, 1, 1)
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}"
        rows.append((key, start + timedelta(minutes=i * 7), float(i)))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, close double")
    plain = windows.pre_close(df, "k", "ts")
    for chunk in ("hour", "day", "month"):
        assert as_set(windows.pre_close(df, "k", "ts", chunk=chunk)) == as_set(plain)


def test_seeded_pre_close_makes_incremental_equal_full(spark):
    rows = [(k, day(i), float(10 + i + len(k))) for k in ("a", "bb") for i in range(6) if (i, k) != (3, "a")]
    df = spark.createDataFrame(rows, "stock_code string, trade_date date, close double")
    full = as_set(windows.pre_close(df, "stock_code", "trade_date"))
    got = set()
    for i in range(6):
        seed = silver.last_close(df, F.lit(day(i)))
        got |= as_set(windows.pre_close(df.filter(F.col("trade_date") == day(i)), "stock_code", "trade_date", seed=seed)
                      .select("stock_code", "trade_date", "close", "pre_close"))
    assert got == full


def factor_case(spark):
    rng = random.Random(3)
    bars = [(k, day(i), 10.0 + rng.random()) for k in ("a", "b") for i in range(20) if rng.random() < 0.8]
    events = [(k, day(i), rng.choice([0.9, 0.5, None])) for k in ("a", "b", "c") for i in range(-2, 22, 3)]
    return (
        bars, events,
        spark.createDataFrame(bars, "stock_code string, trade_date date, close double"),
        spark.createDataFrame(events, "stock_code string, trade_date date, single_factor double"),
    )


def test_factor_asof_against_brute_force(spark):
    bars, events, b, e = factor_case(spark)
    out = joins.factor_asof(b, e, "stock_code", "trade_date")
    got = {(r.stock_code, r.trade_date): (round(r.factor_after, 9), round(r.factor_upto, 9)) for r in out.collect()}
    for k, d, _ in bars:
        after = upto = 1.0
        for k2, d2, f in events:
            if k2 == k:
                if d2 > d:
                    after *= f or 1.0
                else:
                    upto *= f or 1.0
        assert got[(k, d)] == (round(after, 9), round(upto, 9))
    assert len(got) == len(bars)


def test_adjusted_price_properties(spark):
    _, _, b, e = factor_case(spark)
    q = windows.adjust_forward(b, e, prices=["close"]).withColumnRenamed("close", "q").drop("adj")
    h = windows.adjust_backward(b, e, prices=["close"]).withColumnRenamed("close", "h").drop("adj")
    rows = b.join(q, ["stock_code", "trade_date"]).join(h, ["stock_code", "trade_date"]).collect()
    ratios = defaultdict(set)
    for r in rows:
        ratios[r.stock_code].add(round(r.h / r.q, 6))
    assert all(len(v) == 1 for v in ratios.values())
    # with no event after it, the last bar is unadjusted
    last = e.groupBy("stock_code").agg(F.max("trade_date").alias("last"))
    late = [r for r in q.join(last, "stock_code").join(b, ["stock_code", "trade_date"]).collect() if r.trade_date >= r.last]
    assert all(r.q == r.close for r in late)


def test_single_factor_edges(spark):
    df = spark.createDataFrame([(10.0, 1.0, 0.0, 0.0, 0.0), (None, 1.0, 0.0, 0.0, 0.0), (0.0, 1.0, 0.0, 0.0, 0.0), (10.0, 1.0, 5.0, -1.0, 0.0), (10.0, 0.5, 8.0, 0.3, 0.2)],
                               "pre double, div double, price double, rights double, bonus double")
    c = F.col
    got = [r[0] for r in df.select(windows.single_factor(c("pre"), c("div"), c("price"), c("rights"), c("bonus"))).collect()]
    assert got[:4] == [0.9, None, None, None]
    assert round(got[4], 9) == round((10 - 0.5 + 8 * 0.3) / (10 * 1.5), 9)


def test_expected_calendar_and_report(spark):
    cal_days = [0, 1, 2, 5, 6]
    bars = [("600000", day(i)) for i in cal_days] + [("000002", day(i)) for i in (1, 3, 6)] + [("000003", day(0))]
    b = spark.createDataFrame(bars, "stock_code string, trade_date date")
    s = spark.createDataFrame([("600000", day(-100)), ("000002", day(1)), ("000003", None), ("000004", day(6)), ("000005", day(50))],
                              "stock_code string, ipo_date date")
    got = {r.stock_code: r for r in complete.completeness_report(s, b, ["600000"]).collect()}
    assert set(got) == {"000002", "000003", "000004"}
    two = got["000002"]
    # the bar on day 3 is off the calendar but counts as actual
    assert (two.actual_days, two.missing_count, two.expected_days) == (3, 2, 5)
    assert two.missing_dates == [day(2), day(5)]
    assert got["000003"].missing_count is None and got["000003"].note == "no listing date"
    assert (got["000004"].actual_days, got["000004"].missing_count) == (0, 1)
    assert complete.completeness_report(s, b, ["600000"], codes=["000004"]).count() == 1
    empty = complete.completeness_report(s.filter("false"), b, ["600000"])
    assert empty.count() == 0 and "missing_count" in empty.columns


def brute_minute(rows, reference, codes, min_bars):
    cal = sorted({t.date() for k, t in rows if k == reference})
    per = defaultdict(lambda: defaultdict(int))
    for k, t in rows:
        per[k][t.date()] += 1
    out = set()
    for k in codes or per:
        latest = max(per[k], default=cal[-1]) if k in per else cal[-1]
        for d in cal:
            if d <= min(latest, cal[-1]) and d not in per.get(k, {}):
                out.add((k, d, sum(d < c <= latest for c in cal), None))
        for d, n in per.get(k, {}).items():
            if n < min_bars:
                out.add((k, d, sum(d < c <= latest for c in cal), n))
    return out


def minute_rows(start):
    rng, rows = random.Random(4), []
    for k in ("600000", "a", "b", "c"):
        for i in range(40):
            if rng.random() < (0.8 if k == "600000" else 0.5):
                rows += [(k, datetime(2023, 12, 10) + timedelta(days=i, hours=h)) for h in range(rng.randrange(1, 6))]
    rows += [("c", datetime(2024, 3, 1)), ("b", datetime(2023, 12, 1))]
    return rows


def test_completeness_minute_against_brute_force(spark):
    rows = minute_rows(0)
    df = spark.createDataFrame(rows, "stock_code string, datetime timestamp_ntz")
    assert as_set(complete.completeness_minute(df, min_bars=4)) == brute_minute(rows, "600000", None, 4)
    codes = ["a", "zz"]
    assert as_set(complete.completeness_minute(df, codes=codes, min_bars=4)) == brute_minute(rows, "600000", codes, 4)
    split = set()
    for y in (2023, 2024):
        split |= brute_minute([r for r in rows if r[1].year == y], "600000", codes, 4)
    assert as_set(complete.completeness_minute(df, codes=codes, min_bars=4, per_year=True)) == split
    listed = spark.createDataFrame([("a", date(2023, 12, 25))], "stock_code string, ipo_date date")
    late = as_set(complete.completeness_minute(df, codes=["a"], min_bars=0, listed=listed))
    assert late == {r for r in brute_minute(rows, "600000", ["a"], 0) if r[1] >= date(2023, 12, 25)}


def test_upserts(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 9), ("c", 5), ("c", 6)], "k string, v int")
    once = upsert.upsert_ignore(target, batch, ["k"], ["v"])
    assert as_set(once) == {("a", 1), ("b", 2), ("c", 5)}
    assert as_set(upsert.upsert_ignore(once, batch, ["k"], ["v"])) == as_set(once)
    assert as_set(upsert.upsert_update(target, batch, ["k"], ["v"])) == {("a", 1), ("b", 9), ("c", 6)}
    assert as_set(upsert.replace_keys(target, batch, "k", ["a", "c"])) == {("b", 2), ("c", 5), ("c", 6)}
    listed = spark.createDataFrame([("a",), ("c",)], "code string")
    assert as_set(upsert.replace_keys(target, batch, "k", listed)) == {("b", 2), ("c", 5), ("c", 6)}


def test_null_keys_survive_replace(spark):
    target = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert as_set(upsert.replace_keys(target, target.filter("false"), "k", ["a"])) == {(None, 1)}


def test_coverage(spark):
    codes = spark.createDataFrame([("1",), ("2",), ("3",)], "code string")
    df = spark.createDataFrame([("1", datetime(2024, 1, 1, 23, 59)), ("2", datetime(2024, 1, 2)), ("9", datetime(2024, 1, 1))], "c string, ingested_at timestamp_ntz")
    tables = [complete.Landed("t", "primary", df, "c", codes), complete.Landed("all", "primary", df), complete.Landed("none", "primary", df.filter("false"))]
    got = {r["table"]: r for r in complete.coverage_by_table(tables, F.lit(D)).collect()}
    t = got["t"]
    assert (t.expected, t.present, t.missing, t.status) == (3, 2, 2, "gap")
    assert as_set(complete.coverage_missing(tables[:1], F.lit(D)).select("table", "code")) == {("t", "2"), ("t", "3")}
    assert got["all"].status == "ok" and got["none"].status == "missing"
    heal = runs.heal_worklist(complete.coverage_by_table(tables, F.lit(D)), complete.coverage_missing(tables, F.lit(D)))
    assert as_set(heal.select("table", "plain_code")) == {("t", "2"), ("t", "3"), ("none", None)}


def test_runs(spark):
    res = spark.createDataFrame([
        ("bronze.bars_minute_2024", "ok", 5, ["600000: late"]),
        ("bronze.xdxr", "partial", 1, ["600001: x", "no code here", "abc: y", "sz000001: a: b"]),
        ("quotes", "partial", 3, ["600002: x"]),
        ("xdxr_extra", "fail", 0, ["600003: x"]),
    ], "table string, status string, rows int, errors array<string>")
    rules = spark.createDataFrame([("xdxr", "exact", "adj", 1), ("bars_minute_", "prefix", "minute", 2), ("quotes", "exclude", None, 3)], "pattern string, kind string, target string, priority int")
    assert as_set(runs.pending_targets(res, rules)) == {("minute",), ("adj",)}
    assert as_set(runs.failed_codes(res)) == {("xdxr", "600001"), ("xdxr", "sz000001"), ("quotes", "600002"), ("xdxr_extra", "600003")}
    assert as_set(runs.failed_codes(res, rules)) == {("adj", "600001"), ("adj", "sz000001")}


def test_run_rollup_limits(spark):
    rows = [("p", "s", i, 1, 0 if i % 2 else 1, 1, [f"{i:06d}: e", "plain"]) for i in range(200)] + [("p", "t", 1, 2, 0, 1, [])]
    df = spark.createDataFrame(rows, "plan_id string, step_name string, seq int, rows int, failed int, elapsed_ms int, errors array<string>")
    out = runs.run_step_rollup(df)
    got = {r.step_name: r for r in out.collect()}
    assert got["s"].rows == 200 and got["s"].failed == 100 and got["s"].status == "partial"
    assert got["s"].errors == [e for i in range(25) for e in (f"{i:06d}: e", "plain")]
    assert got["s"].failed_codes == [f"{i:06d}" for i in range(100)]
    assert got["t"].status == "ok" and got["t"].errors == []
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()


def test_quality_rules(spark):
    empty = spark.createDataFrame([], "stock_code string, trade_date date, single_factor double")
    assert quality.dq_adj_factor(empty).count() == 0
    df = spark.createDataFrame([("a", D, None), ("b", D, 1.5), ("c", D, 1.51), ("d", D, 0.0)], "stock_code string, trade_date date, single_factor double")
    issues = quality.dq_adj_factor(df)
    assert {(r.stock_code, r.level) for r in issues.collect()} == {("", "warning"), ("c", "warning"), ("d", "warning")}
    assert quality.build_status(issues, 3).first().status == "ok"
    error = quality.duplicate_rule(df.unionByName(df), "t", ["stock_code"])
    assert quality.build_status(error, 3).first().status == "partial"
    assert quality.build_status(error, 0).first().status == "fail"


def test_union_markets_skips_absent(spark):
    df = spark.createDataFrame([("1",)], "code string")
    assert as_set(setops.union_markets({"sz": df, "bj": None})) == {("1", "sz")}


def test_null_keys_are_stored_once(spark):
    target = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    batch = spark.createDataFrame([(None, 5), ("a", 6), ("c", 7)], "k string, v int")
    assert as_set(joins.new_keys_only(batch, target, ["k"])) == {("c", 7)}
    once = upsert.upsert_ignore(target, batch, ["k"])
    assert as_set(once) == {(None, 1), ("a", 2), ("c", 7)} == as_set(upsert.upsert_ignore(once, batch, ["k"]))
    assert as_set(upsert.upsert_update(target, batch, ["k"])) == {(None, 5), ("a", 6), ("c", 7)}


def test_undated_bars_and_events_are_rejected(spark):
    primary = spark.createDataFrame(
        [("600000", "junk", 77.0, 77.0, 80.0, 70.0, 1.0, 1.0), ("600000", "2024-01-02", 10.0, 10.0, 11.0, 9.0, 1.0, 1.0)],
        "stock_code string, datetime string, open double, close double, high double, low double, volume double, amount double")
    bars, rejects = silver.daily_bars(primary)
    assert [(r.trade_date, r.pre_close) for r in bars.collect()] == [(date(2024, 1, 2), None)] and rejects.count() == 1
    raw = spark.createDataFrame([("600000", 2024, 2, 31, 1, 1.0, 0.0, 0.0, 0.0), ("600000", 2024, 2, 3, 1, 1.0, 0.0, 0.0, 0.0)],
                                "code string, year int, month int, day int, category int, fenhong double, peigujia double, songzhuangu double, peigu double")
    assert [r.trade_date for r in silver.corporate_actions(raw).collect()] == [date(2024, 2, 3)]


def test_the_first_copy_of_a_minute_bar_to_arrive_stays(spark):
    rows = [("600000", "2024-01-02 09:31", c, c, c, c, 1.0, 1.0, datetime(2024, 1, 2, 10, m)) for c, m in ((2.0, 5), (5.0, 1), (1.0, 9))]
    raw = spark.createDataFrame(rows, "stock_code string, datetime string, open double, high double, low double, close double, vol double, amount double, ingested_at timestamp_ntz")
    bars, _ = silver.minute_bars(raw)
    assert [r.close for r in bars.collect()] == [5.0] and "ingested_at" not in bars.columns


def test_adjusted_bars_agree_with_each_other(spark):
    bars = spark.createDataFrame([("600000", day(i), c, c, c, c, p, 1, 1.0, 0.0) for i, (c, p) in enumerate([(10.0, None), (5.1, 10.0), (5.2, 5.1), (2.7, 5.2)])],
                                 "stock_code string, trade_date date, open double, high double, low double, close double, pre_close double, volume int, amount double, change_pct double")
    factors = spark.createDataFrame([("600000", day(1), 0.5), ("600000", day(3), 0.5)], "stock_code string, trade_date date, single_factor double")
    for fq, closes in (("qfq", [2.5, 2.55, 2.6, 2.7]), ("hfq", [10.0, 10.2, 10.4, 10.8])):
        for first in range(4):  # the range may begin on an ex-date
            got = serve.daily(bars, "600000", str(day(first)), str(day(3)), fq, factors).collect()
            assert [round(r.close, 9) for r in got] == closes[first:]
            before = [None, *closes][first:4]
            assert [r.pre_close if r.pre_close is None else round(r.pre_close, 9) for r in got] == before
            assert all(p is None or round(r.change_pct, 6) == round((r.close - p) / p * 100, 6) for r, p in zip(got, before))


def test_rounds_and_repair_work(spark):
    report = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1), ("d", 2)], "stock_code string, missing_count int")
    tried = spark.createDataFrame([("a", 1), ("c", 1), ("c", 2)], "stock_code string, round int")
    assert as_set(runs.backfill_worklist(report, tried)) == {("a", 3, 2), ("d", 2, 1)}
    outcome = spark.createDataFrame([("f", "1", "succeeded"), ("f", "2", "retry"), ("g", "1", "succeeded")], "table string, code string, outcome string")
    feeds = spark.createDataFrame([("f", "finance"), ("f", "stock_map"), ("g", "finance")], "table string, target string")
    assert as_set(runs.repair_worklist(outcome, feeds)) == {("finance", "1"), ("stock_map", "1")}


def test_rollup_counts_what_its_previews_cut(spark):
    rows = [("p", "s", i, 1, 1, 1, [f"{i:06d}: e", "plain"]) for i in range(200)]
    df = spark.createDataFrame(rows, "plan_id string, step_name string, seq int, rows int, failed int, elapsed_ms int, errors array<string>")
    got = runs.run_step_rollup(df).first()
    assert (got.n_errors, got.n_failed_codes) == (400, 200)
    assert runs.step_errors(df).count() == 400 and runs.step_failed_codes(df).count() == 200
