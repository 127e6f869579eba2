"""Keyed tables: what is read, what a dead or a second writer leaves, and null keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid.sources import sinks, tables


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, day string, v int")


def content(spark, path, **options):
    return sorted(map(tuple, tables.read(spark, path, **options).collect()), key=str)


def test_insert_replace_and_versions(spark, tmp_path):
    path = str(tmp_path)
    assert tables.read(spark, path) is None and tables.versions(spark, path) == []
    assert tables.insert(frame(spark, [(1, "a", 1), (2, "b", 2), (2, "b", 9), (None, None, 3)]), path, ["k", "day"], "day") == (4, 3)
    assert tables.insert(frame(spark, [(1, "a", 7), (3, "a", 3), (None, None, 4)]), path, ["k", "day"], "day") == (3, 1)
    assert tables.insert(frame(spark, [(1, "a", 7)]), path, ["k", "day"], "day") == (1, 0)
    assert tables.versions(spark, path) == [1, 2]
    assert content(spark, path) == sorted([(1, "a", 1), (2, "b", 2), (None, None, 3), (3, "a", 3)], key=str)
    assert tables.replace(frame(spark, [(1, "a", 8), (4, "c/d=e", 4), (None, None, 5)]), path, ["k", "day"], "day") == (3, 4)
    assert content(spark, path) == sorted([(1, "a", 8), (2, "b", 2), (3, "a", 3), (4, "c/d=e", 4), (None, None, 5)], key=str)
    assert content(spark, path, buckets=["c/d=e"]) == [(4, "c/d=e", 4)]
    assert content(spark, path, version=1) == sorted([(1, "a", 1), (2, "b", 2), (None, None, 3)], key=str)
    assert tables.insert(frame(spark, []), path, ["k", "day"], "day") == (0, 0)


def test_a_write_reads_only_its_buckets(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    tables.insert(frame(spark, [(i, f"d{i % 50}", i) for i in range(500)]), path, ["k", "day"], "day")
    listed, read = [], tables.read

    def seen(spark, path, buckets=None, version=None):
        out = read(spark, path, buckets, version)
        listed.append(sorted({f.split("/__bucket=")[1].split("/")[0] for f in out.inputFiles()}))
        return out

    monkeypatch.setattr(tables, "read", seen)
    assert tables.insert(frame(spark, [(7, "d7", 0), (1000, "d8", 0)]), path, ["k", "day"], "day") == (2, 1)
    assert listed == [["d7", "d8"]]


def test_a_write_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    tables.insert(frame(spark, [(1, "a", 1)]), path, ["k"], "day")
    with monkeypatch.context() as m:
        m.setattr(tables, "commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            tables.replace(frame(spark, [(1, "a", 2)]), path, ["k"], "day")
    assert content(spark, path) == [(1, "a", 1)] and tables.versions(spark, path) == [1]
    tables.replace(frame(spark, [(1, "a", 3)]), path, ["k"], "day")
    assert content(spark, path) == [(1, "a", 3)]


def test_of_two_writers_the_second_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    tables.insert(frame(spark, [(1, "a", 1)]), path, ["k"], "day")
    old = tables.manifest(spark, path)
    tables.insert(frame(spark, [(2, "a", 2)]), path, ["k"], "day")
    with monkeypatch.context() as m:
        m.setattr(tables, "manifest", lambda *a: old)
        with pytest.raises(tables.Conflict):
            tables.insert(frame(spark, [(3, "a", 3)]), path, ["k"], "day")
    assert content(spark, path) == [(1, "a", 1), (2, "a", 2)]


def test_upsert_of_null_keys(spark):
    current = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    incoming = spark.createDataFrame([(None, 3), ("b", 4)], "k string, v int")
    assert sorted(map(tuple, sinks.upsert(current, incoming, ["k"]).collect()), key=str) == [("a", 2), ("b", 4), (None, 3)]


def test_registering_again_changes_nothing_but_the_status(spark, tmp_path):
    schema = "project string, patient string, device string, sha256 string, parse_status string"
    first = spark.createDataFrame([("p", "1", "d", "aa", None), ("p", "2", "d", "bb", "parsed"), ("q", "1", "e", "cc", "duplicate"), (None, None, None, "dd", "x")], schema)
    one = {r.sha256: r for r in sinks.register(first, str(tmp_path)).collect()}
    assert {k: r.parse_status for k, r in one.items()} == {"aa": "pending", "bb": "parsed", "dd": "x"}
    second = spark.createDataFrame([("p", "1", "d", "aa", "parsed"), ("p", "2", "d", "bb", "duplicate"), ("q", "1", "e", "cc", "parsed")], schema)
    two = {r.sha256: r for r in sinks.register(second, str(tmp_path)).collect()}
    assert {k: r.parse_status for k, r in two.items()} == {"aa": "parsed", "bb": "parsed", "cc": "parsed", "dd": "x"}
    assert all(two[k].recording_id == one[k].recording_id and two[k].participant_id == one[k].participant_id for k in one)
    assert len({r.recording_id for r in two.values()}) == 4


def test_content_hashes_know_rows_not_their_order(spark):
    at = lambda s: dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s)
    rows = [("a", at(s), "HR", float(s % 7)) for s in range(0, 9000, 60)]
    schema = "r string, ts timestamp, variable string, value double"
    df = spark.createDataFrame(rows + [("b", *x[1:]) for x in rows] + [("c", *x[1:]) for x in rows[:-1]] + [("d", rows[0][1], "HR", None)], schema)
    got = {r.r: r.sha256 for r in sinks.content_hashes(df, "r", "ts", ["variable", "value"]).collect()}
    again = {r.r: r.sha256 for r in sinks.content_hashes(df.orderBy(F.rand(3)), "r", "ts", ["variable", "value"]).collect()}
    assert got == again and got["a"] == got["b"] and len({got["a"], got["c"], got["d"]}) == 3


def test_csv_exports_are_made_once(spark, tmp_path):
    path = str(tmp_path)
    df = spark.createDataFrame([("p", 1, 1.5), ("p", 2, 2.5), (None, 1, 3.5)], "project string, patient int, v double")
    assert sinks.csv_exports(df.where("patient = 1"), path, ["project", "patient"]) == (2, 0)
    assert sinks.csv_exports(df.withColumn("v", F.col("v") + 1), path, ["project", "patient"]) == (1, 2)
    assert sinks.csv_exports(df.where("false"), path, ["project", "patient"]) == (0, 0)
    got = spark.read.csv(f"{path}/csv", header=True, schema="v double, project string, patient int").collect()
    assert sorted((r.project or "", r.patient, r.v) for r in got) == [("", 1, 3.5), ("p", 1, 1.5), ("p", 2, 3.5)]


def test_ids_follow_ranges_that_are_cut_once(spark, tmp_path):
    import random

    names = [f"{random.Random(i).random():.12f}" for i in range(20_000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    # Ranges are cut by samples, which a second plan takes anew; so small ones would be joined.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.get_or_create(df.where("name < '0.5'"), f"{tmp_path}/ids", ["name"], "id")
        got = sinks.get_or_create(df, f"{tmp_path}/ids", ["name"], "id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    low, high = sorted(n for n in names if n < "0.5"), sorted(n for n in names if n >= "0.5")
    assert sorted((r.id, r.name) for r in got) == list(enumerate(low + high, 1))
    assert [p.name for p in tmp_path.iterdir()] == ["ids"]


def test_a_unit_is_exported_in_few_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    rows = [(u, i, f'a "{i}", \n' if i % 9 == 0 else "") for u in ("a/b=c", "d", "") for i in range(100)]
    df = spark.createDataFrame(rows, "unit string, i int, s string").repartition(16, "i")
    (tmp_path / "csv" / "unit=d").mkdir(parents=True)
    (tmp_path / "csv" / "unit=d" / "part-77.csv").write_text("i,s\n-1,died\n")
    assert sinks.csv_exports(df, path, ["unit"]) == (3, 0)
    files = [p for p in (tmp_path / "csv").rglob("*") if p.is_file()]
    assert sorted(p.parent.name for p in files) == ["unit=__HIVE_DEFAULT_PARTITION__", "unit=a%2Fb%3Dc", "unit=d"]
    got = spark.read.csv(f"{path}/csv", header=True, multiLine=True, schema="i int, s string, unit string").collect()
    assert sorted((r.unit or "", r.i, (r.s or "").strip()) for r in got) == sorted((u, i, s.strip()) for u, i, s in rows)
    monkeypatch.setattr(sinks, "FILE_ROWS", 40)
    assert sinks.csv_exports(df.withColumn("unit", F.lit("e")), path, ["unit"]) == (1, 0)
    assert len(list((tmp_path / "csv" / "unit=e").glob("*.csv"))) == 8
