"""Streams over landed files give what a batch over the same files gives."""

import os

import pytest
from pyspark.sql import functions as F

from barlake.schemas import QUOTE_FIELDS
from barlake.sources.sinks import read_version, table_parts, write_version
from barlake.streaming import quotes as st


def line(code, price, clock, pct="1.0"):
    fields = {"code": code, "name": f"n{code}", "current_price": price, "update_time": clock, "change_pct": pct}
    return "~".join(fields.get(n, "") for n in QUOTE_FIELDS)


POLLS = {
    1: [("600000", "1", "20240105093000"), ("sz000001", "2", "20240105093000"), ("300001", "3", "20240105080000")],
    3: [("600000", "5", "20240105093500")],
    2: [("600000", "4", "20240105093300"), ("000001", "2", "20240105093000")],
}


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for poll, rows in POLLS.items():  # an out-of-order poll lands last
        text = "\n".join(line(*r) for r in rows) + "\n"
        (folder / f"poll{poll}.txt").write_bytes(text.encode("gbk"))
    return str(folder)


def stream(spark, landing):
    return st.stream_quotes(spark, landing, max_files=1)


def drain(spark, sdf, tmp_path, mode="append"):
    q = st.run_available(
        sdf, str(tmp_path / "ck"),
        lambda df, i: df.write.mode("overwrite" if mode != "append" else "append").option("partitionOverwriteMode", "static").parquet(str(tmp_path / "out")), mode)
    q.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_latest(spark, landing, tmp_path):
    out = drain(spark, st.stream_latest(stream(spark, landing)), tmp_path, "complete")
    assert {(r.code, r.current_price, r.poll_id) for r in out.collect()} == {("600000", "5", 3), ("000001", "2", 2), ("300001", "3", 1)}


def test_snapshot_replace_drops_absent_codes(spark, landing, tmp_path):
    sdf = stream(spark, landing)
    root = str(tmp_path / "snap")
    st.stream_snapshot_replace(sdf, root, str(tmp_path / "ck")).awaitTermination()
    got = read_version(spark, root, sdf.schema).collect()
    assert [(r.code, r.poll_id) for r in got] == [("600000", 3)]


def test_session_gate_and_dedup(spark, landing, tmp_path):
    sdf = st.stream_dedup(st.stream_session_gate(stream(spark, landing)))
    out = drain(spark, sdf, tmp_path)
    assert sorted((r.code, r.update_time[-6:]) for r in out.collect()) == [
        ("000001", "093000"), ("600000", "093000"), ("600000", "093300"), ("600000", "093500")]


def test_subscribe(spark, landing, tmp_path):
    subs = spark.createDataFrame([("s1", "sh600000"), ("s1", "600000"), ("s2", "999999"), ("all", None)], "sub_id string, code string")
    out = drain(spark, st.stream_subscribe(stream(spark, landing), subs), tmp_path)
    counts = {r.sub_id: r["count"] for r in out.groupBy("sub_id").count().collect()}
    assert counts == {"s1": 3, st.EVERYTHING: 6}
    assert [r.sub_id for r in st.wildcard_subscribers(subs).collect()] == ["all"]


def test_industry(spark, landing, tmp_path):
    industry = spark.createDataFrame([("600000", "x", "bank"), ("000001", "y", "bank")], "code string, name string, industry string")
    root = str(tmp_path / "ind")
    st.stream_industry(stream(spark, landing), industry, root, str(tmp_path / "ck")).awaitTermination()
    schema = spark.createDataFrame([], "industry string, avg_pct double, members bigint, tier int").schema
    assert {tuple(r) for r in read_version(spark, root, schema).collect()} == {("bank", 1.0, 2, 1), ("其他", 1.0, 1, 1)}


def test_bronze_to_silver_is_idempotent(spark, tmp_path):
    rows = [(f"{i % 5}", i // 5, float(i)) for i in range(50)]
    df = spark.createDataFrame(rows + rows, "k string, t int, v double")
    df.repartition(4).write.parquet(str(tmp_path / "bronze"))
    for checkpoint in ("a", "b"):  # a lost checkpoint replays everything
        st.stream_bronze_to_silver(
            spark, str(tmp_path / "bronze"), df.schema, lambda b: b.filter("v > 3"), str(tmp_path / "silver"),
            ["k", "t"], str(tmp_path / checkpoint), max_files=1).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "silver"))
    assert sorted(r.v for r in out.collect()) == [float(i) for i in range(4, 50)]


def test_update_time_is_event_time(spark, landing, tmp_path):
    out = drain(spark, stream(spark, landing), tmp_path)
    assert out.filter(F.col("event_time").isNull()).count() == 0


def test_new_checkpoint_continues_above_old_versions(spark, landing, tmp_path):
    root, folder = str(tmp_path / "snap"), tmp_path / "landing"
    st.stream_snapshot_replace(stream(spark, landing), root, str(tmp_path / "ck")).awaitTermination()
    (folder / "poll9.txt").write_bytes((line("000002", "7", "20240105094000") + "\n").encode("gbk"))
    sdf = stream(spark, landing)
    st.stream_snapshot_replace(sdf, root, str(tmp_path / "other")).awaitTermination()
    assert [(r.code, r.poll_id) for r in read_version(spark, root, sdf.schema).collect()] == [("000002", 9)]
    assert len(list((tmp_path / "snap").iterdir())) <= 2


def test_quotes_without_a_poll_number_are_an_error(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "quotes.txt").write_bytes((line("000002", "7", "20240105094000") + "\n").encode("gbk"))
    with pytest.raises(Exception, match="poll number"):
        st.stream_snapshot_replace(stream(spark, str(folder)), str(tmp_path / "s"), str(tmp_path / "ck")).awaitTermination()


def test_dedup_forgets_behind_the_watermark(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for poll, clock in ((1, "093000"), (2, "093100"), (3, "113000"), (4, "093000"), (5, "113000")):
        file = folder / f"poll{poll}.txt"
        file.write_bytes((line("600000", "1", f"20240105{clock}") + "\n").encode("gbk"))
        os.utime(file, (1_700_000_000 + poll, 1_700_000_000 + poll))  # files are read in this order
    out = drain(spark, st.stream_dedup(stream(spark, str(folder)), "10 minutes"), tmp_path)
    # the copy of 11:30 is a repeat; that of 09:30 lands an hour late and is dropped as late
    assert sorted(r.update_time[-6:] for r in out.collect()) == ["093000", "093100", "113000"]


def polls(folder, rows):
    """One file per poll, read in this order."""
    folder.mkdir(exist_ok=True)
    for poll, lines in rows:
        file = folder / f"poll{poll}.txt"
        file.write_bytes("".join(x + "\n" for x in lines).encode("gbk"))
        os.utime(file, (1_700_000_000 + poll, 1_700_000_000 + poll))


def test_late_rows_are_a_table(spark, tmp_path):
    folder, root, at = tmp_path / "landing", str(tmp_path / "split"), str(tmp_path / "ck")
    polls(folder, [(1, [line("600000", "1", "20240105093000")]), (2, [line("600000", "1", "20240105113000"), line("000001", "1", "20240105092000")])])
    st.stream_split_late(stream(spark, str(folder)), root, at).awaitTermination()
    polls(folder, [(3, [line("600000", "1", "20240105112500"), line("000001", "1", "20240105111900"), line("300001", "1", "some day")])])
    st.stream_split_late(stream(spark, str(folder)), root, at).awaitTermination()
    on_time = spark.read.parquet(f"{root}/on_time").select("code", "update_time").collect()
    late = {(r.code, r.update_time): r.reason for r in spark.read.parquet(f"{root}/late").collect()}
    assert late == {("000001", "20240105111900"): "behind 2024-01-05 11:20:00", ("300001", "some day"): "no event time"}
    assert len(on_time) == 4 and not {tuple(r) for r in on_time} & set(late)


def test_industry_changes_follow_the_quotes_that_moved(spark, tmp_path):
    folder, root, at = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "ck")
    industry = spark.createDataFrame([("600000", "n", "bank"), ("000001", "n", "bank"), ("300001", "n", "chips")], "code string, name string, industry string")
    schema = spark.createDataFrame([], "industry string, avg_pct double, members bigint, tier int").schema
    whole = str(tmp_path / "whole")
    for poll, lines in enumerate([
        [line("600000", "1", "20240105093000", "1.5"), line("300001", "1", "20240105093000", "9")],
        [line("600000", "1", "20240105093100", "3"), line("000001", "1", "20240105093100", "2")],
        [line("600000", "1", "20240105093000", "7"), line("688001", "1", "20240105093200", "4")],  # the first is older than the one kept
    ], 1):
        polls(folder, [(poll, lines)])
        st.stream_industry_changes(stream(spark, str(folder)), industry, root, at, buckets=4).awaitTermination()
        st.stream_industry(stream(spark, str(folder)), industry, f"{whole}{poll}", f"{at}{poll}").awaitTermination()
        rows = lambda df: sorted((r.industry, round(r.avg_pct, 6), r.members, r.tier) for r in df.collect())
        assert rows(read_version(spark, f"{root}/out", schema)) == rows(read_version(spark, f"{whole}{poll}", schema))
    kept = table_parts(spark, f"{root}/quotes")
    assert len({v for _, v in kept}) > 1  # buckets without a moved code are those of older versions


def test_dedup_keeps_a_quote_once_on_disk(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for poll in range(3):
        rows = [line(f"{i:06d}", "1", "20240105093000") for i in range(20)]
        (folder / f"poll{poll}.txt").write_bytes("\n".join(rows).encode("gbk"))
    q = st.run_available(
        st.stream_dedup(stream(spark, str(folder))), str(tmp_path / "ck"),
        lambda df, i: df.write.mode("append").parquet(str(tmp_path / "out")))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
    assert os.listdir(tmp_path / "ck" / "state") == ["0"]  # one operator holds state, not one per round
    names = [n for _, _, files in os.walk(tmp_path / "ck" / "state") for n in files]
    assert any(n.endswith(".changelog") for n in names) and not any(n.endswith(".delta") for n in names)


def snapshot(spark, folder, root, at):
    sdf = stream(spark, str(folder))
    st.stream_snapshot_replace(sdf, root, at).awaitTermination()
    rows = read_version(spark, root, sdf.schema)
    assert rows.columns == sdf.columns
    return sorted((r.poll_id, r.code, r.current_price) for r in rows.collect())


def test_snapshot_of_many_batches_is_not_written_again(spark, tmp_path):
    folder, root, at = tmp_path / "landing", str(tmp_path / "snap"), str(tmp_path / "ck")
    clock = "20240105093000"
    a, b, c = (line(code, "1", clock) for code in ("600000", "000001", "300001"))
    folder.mkdir()

    def land(name, rows, at=[0]):  # noqa: B006 - files are read in this order
        (folder / name).write_bytes("".join(x + "\n" for x in rows).encode("gbk"))
        at[0] += 1
        os.utime(folder / name, (1_700_000_000 + at[0], 1_700_000_000 + at[0]))

    land("poll2.txt", [a, a])
    assert snapshot(spark, folder, root, at) == [(2, "600000", "1")]
    written = {n for n in os.listdir(f"{root}/v={0:020d}/poll_id=2") if n.endswith(".parquet")}
    land("poll2-more.txt", [a, b, b])  # a row of the batch before comes again
    land("poll1.txt", [c])  # an older poll
    land("poll2-last.txt", [b, c])
    assert snapshot(spark, folder, root, at) == [(2, "000001", "1"), (2, "300001", "1"), (2, "600000", "1")]
    # the first batch's rows are still those that it wrote; a batch that changes nothing has no version
    assert len(table_parts(spark, root)) == 3
    assert {n for n in os.listdir(f"{root}/v={0:020d}/poll_id=2") if n.endswith(".parquet")} == written
    land("poll3.txt", [b])
    assert snapshot(spark, folder, root, at) == [(3, "000001", "1")]
    land("poll4.txt", [])
    land("poll2-late.txt", [a])
    assert snapshot(spark, folder, root, at) == [(3, "000001", "1")]
    assert "held" not in os.listdir(at)


def test_snapshot_that_was_written_whole_goes_on(spark, tmp_path):
    folder, root, at = tmp_path / "landing", str(tmp_path / "snap"), str(tmp_path / "ck")
    a, b = (line(code, "1", "20240105093000") for code in ("600000", "000001"))
    polls(folder, [(2, [a])])
    rows = stream(spark, str(folder))
    q = st.run_available(rows, str(tmp_path / "whole"), lambda df, i: write_version(df, root, i))
    q.awaitTermination()
    (folder / "poll2-more.txt").write_bytes("".join(x + "\n" for x in (a, b)).encode("gbk"))
    assert snapshot(spark, folder, root, at) == [(2, "000001", "1"), (2, "600000", "1")]
