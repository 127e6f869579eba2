import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.sources import sinks
from pulsegrid.streaming import incremental as inc

T0 = dt.datetime(2026, 1, 5, 12)
SCHEMA = "k string, ts timestamp, v double"


def put(spark, path, rows):
    data = [(k, T0 + dt.timedelta(seconds=s), float(v)) for k, s, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_new_files_are_read_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, source, [("a", 0, 1), ("a", 1, 2)])
    inc.run_available(inc.files(spark, source, SCHEMA), target, check)
    put(spark, source, [("b", 0, 3)])
    inc.run_available(inc.files(spark, source, SCHEMA), target, check)
    inc.run_available(inc.files(spark, source, SCHEMA), target, check)
    assert spark.read.parquet(target).count() == 3


def test_exam_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, source, [("e1", 0, 1), ("e2", 1, 2)])
    inc.run_available(inc.once_per_exam(inc.files(spark, source, SCHEMA), "k", "ts"), target, check)
    put(spark, source, [("e1", 5, 9), ("e3", 6, 1)])
    inc.run_available(inc.once_per_exam(inc.files(spark, source, SCHEMA), "k", "ts"), target, check)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == ["e1", "e2", "e3"]


def test_windows_equal_batch_and_late_samples_are_out(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, source, [("a", s, s) for s in range(25)])
    stream = inc.windowed(inc.files(spark, source, SCHEMA), ["k"], "ts", "v", "10 seconds")
    inc.run_available(stream, target, check)
    put(spark, source, [("a", 3, 100), ("a", 60, 1)])
    inc.run_available(stream, target, check)
    got = {(r.w_start, r.n, r["mean"]) for r in spark.read.parquet(target).collect()}
    want = {(T0, 10, 4.5), (T0 + dt.timedelta(seconds=10), 10, 14.5), (T0 + dt.timedelta(seconds=20), 5, 22.0)}
    assert got == want


def test_gap_alarms_across_batches(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, source, [("a", 1, 0), ("a", 0, 0), ("b", 0, 0)])
    stream = inc.gap_alarms(inc.files(spark, source, SCHEMA), "k", "ts", 5.0)
    inc.run_available(stream, target, check)
    put(spark, source, [("a", 31, 0), ("b", 2, 0)])
    inc.run_available(stream, target, check)
    assert [(r.k, r.gap_s) for r in spark.read.parquet(target).collect()] == [("a", 30.0)]


def test_append_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "signals")
    rows = spark.createDataFrame([("r", T0, "HR", 70.0), ("r", T0, "HR", 71.0), ("r", T0, "BIS", 40.0)], "recording_id string, ts timestamp, variable string, value double")
    assert sinks.signal_table(rows, path) == (3, 2)
    assert sinks.signal_table(rows, path) == (3, 0)
    assert spark.read.parquet(path).count() == 2


def test_quarantine_upsert_and_feed(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    good = sinks.quarantine(df, F.col("v").isNull(), "no value", str(tmp_path / "bad"))
    assert [r.k for r in good.collect()] == ["a"]
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["no value"]
    merged = sinks.upsert(df, spark.createDataFrame([("b", 5), ("c", 6)], "k string, v int"), ["k"])
    assert sorted((r.k, r.v) for r in merged.collect()) == [("a", 1), ("b", 5), ("c", 6)]
    sinks.feed(merged.orderBy("k"), str(tmp_path / "feed"))
    assert spark.read.json(str(tmp_path / "feed")).count() == 3


def test_state_ends_with_the_recording(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, source, [("a", 1, 0), ("a", 0, 0), ("b", 0, 0)])
    run = lambda: inc.run_available(inc.recordings(inc.files(spark, source, SCHEMA), "k", "ts", 5.0, 60.0), target, check)
    run()
    assert sorted((r.key, r.n) for r in inc.states(spark, check).collect()) == [("a", 2), ("b", 1)]
    put(spark, source, [("a", 31, 0)])
    run()
    put(spark, source, [("a", 70, 0), ("c", 75, 0)])
    run()
    # b's last sample lies over a minute before the watermark; what it kept is gone.
    assert sorted((r.key, r.n) for r in inc.states(spark, check).collect()) == [("a", 4), ("c", 1)]
    got = sorted((r.k, r.kind, r.at, r.gap_s, r.n_samples) for r in spark.read.parquet(target).collect())
    at = lambda s: T0 + dt.timedelta(seconds=s)
    assert [g[:4] for g in got[:2]] == [("a", "gap", at(1), 30.0), ("a", "gap", at(31), 39.0)]
    assert got[2][:3] == ("b", "ended", at(0)) and got[2][4] == 1 and len(got) == 3
    put(spark, source, [("b", 80, 0), ("c", 200, 0)])
    run()
    assert sorted((r.key, r.n) for r in inc.states(spark, check).collect()) == [("c", 2)]
    assert sorted((r.k, r.n_samples) for r in spark.read.parquet(target).collect() if r.kind == "ended") == [("a", 4), ("b", 1), ("b", 1)]


def test_the_state_of_recordings_comes_with_their_rows(spark, tmp_path):
    """No call for each state and timer: 300 recordings in a batch, with samples older than the state, null times and a null key."""
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, source, [(f"r{i}", 10, 0) for i in range(300)] + [(None, 10, 0)])
    df = inc.recordings(inc.files(spark, source, SCHEMA), "k", "ts", 5.0, 60.0)
    assert "FlatMapGroupsInPandasWithState" in df._jdf.queryExecution().logical().toString()
    inc.run_available(df, target, check)
    put(spark, source, [(f"r{i}", s, 0) for i in range(300) for s in (9.5, 12, 30)] + [(None, 30, 0)])
    inc.run_available(df, target, check)
    spark.createDataFrame([("r0", None, 0.0), ("new", None, 0.0)], SCHEMA).write.mode("append").parquet(source)
    inc.run_available(df, target, check)
    n = {r.key: r.n for r in inc.states(spark, check).collect()}
    assert n == {None: 2} | {f"r{i}": 4 for i in range(300)}
    got = spark.read.parquet(target).collect()
    assert sorted(r.gap_s for r in got) == [18.0] * 300 + [20.0] and {r.kind for r in got} == {"gap"}
