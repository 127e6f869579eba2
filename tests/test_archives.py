"""Zipped exams by member: damaged members, wrong names, footers that disagree, drifting columns."""

import io
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pulsegrid.sources import archives
from pulsegrid.sources import readers as r

GOOD = "P_1_2026-01-05_12-00-00_0000aaaa_0000bbbb.parquet.zip"


def part(columns, **pairs):
    raw = io.BytesIO()
    pq.write_table(pa.table(columns).replace_schema_metadata(pairs), raw)
    return raw.getvalue()


def put(path, name, parts, kind=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path / name, "w", kind) as z:
        for member, raw in parts.items():
            z.writestr(member, raw)


def spoil(path, what):
    raw = bytearray(path.read_bytes())
    raw[raw.index(what) + len(what) + 40] ^= 255
    path.write_bytes(bytes(raw))


def test_exams(spark, tmp_path):
    one = part({"local_time": [2.0, 1.0], "value": [-32768.0, 5.0]}, exam_guid="0000BBBB", session_guid="0000aaaa", sampling_frequency="['draeger_ecg=200', 'x = 2', odd]")
    two = part({"local_time": [3], "more": ["x"], "__index_level_0__": [0]}, exam_guid="1111bbbb")
    put(tmp_path, GOOD, {"time_bin=0/sensor=draeger/signal=p/a.parquet": one, "time_bin=1/sensor=other/signal=q/b.parquet": two, "notes.txt": b"no"})
    put(tmp_path, "x.parquet.zip", {"sensor=s/signal=p/a.parquet": one}, zipfile.ZIP_STORED)
    other = GOOD.replace("bbbb", "cccc")
    put(tmp_path, other, {"sensor=s/signal=p/a.parquet": one})
    put(tmp_path, "empty.zip", {"notes.txt": b"no"})
    (tmp_path / "none.zip").write_bytes(b"no archive")
    bad = GOOD.replace("aaaa", "dddd")
    put(tmp_path, bad, {"sensor=s/signal=a/a.parquet": one, "sensor=s/signal=b/b.parquet": two}, zipfile.ZIP_STORED)
    spoil(tmp_path / bad, b"signal=a/a.parquet")
    found = archives.members(spark, str(tmp_path))
    got = {x.path.rsplit("/", 1)[-1]: x for x in archives.exams(found).collect()}
    assert {k: x.reason for k, x in got.items()} == {
        GOOD: None, "x.parquet.zip": "bad_filename", other: "guid_mismatch", "empty.zip": "empty_zip", "none.zip": "unreadable_zip", bad: "crc32_failure",
    }
    good = got[GOOD]
    assert (good.patient, good.session_guid, good.exam_guid, good.n_members) == ("P_1", "0000aaaa", "0000BBBB", 2)
    assert good.sampling_frequency == {"draeger_ecg": "200", "x": "2"}
    assert good.unexpected == ["more"] and sorted(good.missing) == ["annotation", "dimension", "form", "received_time", "remote_time"]
    rows = archives.samples(found).collect()
    assert sum(not x.crc_ok for x in rows) == 1 and sum(x.path.endswith(bad) and x.crc_ok for x in rows) == 1
    mine = sorted((x.time_bin, x.sensor, x.signal, x.local_time, x.value) for x in rows if x.path.endswith(GOOD) and x.sensor == "draeger")
    assert mine == [("0", "draeger", "p", 1.0, 5.0), ("0", "draeger", "p", 2.0, -32768.0)]


def test_members_of_one_archive_are_dealt_to_tasks(spark, tmp_path):
    raw = part({"local_time": [1.0], "value": [1.0]})
    put(tmp_path, GOOD, {f"sensor=s{i}/signal=p/a.parquet": raw for i in range(64)})
    rows = archives.samples(archives.members(spark, str(tmp_path))).withColumn("task", F.spark_partition_id())
    assert rows.count() == 64 and rows.select("task").distinct().count() > 1


def test_exam_zip_takes_the_sentinel_of_its_sensor(spark, tmp_path):
    part_ = io.BytesIO()
    pd.DataFrame({"local_time": [2.0], "value": [-32768.0]}).to_parquet(part_)
    put(tmp_path, "e.zip", {f"sensor={s}/signal=p/x.parquet": part_.getvalue() for s in ("draeger", "other")})
    assert {(x.sensor, x["value"]) for x in r.exam_zip(spark, str(tmp_path)).collect()} == {("draeger", None), ("other", -32768.0)}


def test_a_user_whose_number_begins_like_the_year(spark, tmp_path):
    from pulsegrid.plans import QUERIES

    rows = [(i, u, t, i * 1.5) for u in (20265, 15) for i, t in enumerate(("click", "view", "view"))]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    events.withColumn("ts", F.timestamp_seconds("event_id").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    checked = QUERIES["checked_exams"](spark, str(tmp_path)).collect()
    assert sorted((r.user_id, r.n_members, r.reason) for r in checked) == [(15, 2, "bad_filename"), (20265, 2, "bad_filename")]
    assert sorted(r.user_id for r in QUERIES["read_zipped_exams"](spark, str(tmp_path)).collect()) == [15] * 3 + [20265] * 3
