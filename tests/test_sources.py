import datetime as dt
import io
import zipfile

import numpy as np
import pandas as pd
import pytest

from pulsegrid.sources import device
from pulsegrid.sources import readers as r


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *columns):
    return sorted(tuple(x) for x in df.select(*columns).collect())


def test_sniff_delimiter():
    assert r.sniff_delimiter("a;b;c,d") == ";"
    assert r.sniff_delimiter("a\tb") == "\t"
    assert r.sniff_delimiter("alone", default=";") == ";"


def test_headings_number_repeats():
    assert device.headings(['"HR"', "HR", "HR", " x "]) == ["HR", "HR.1", "HR.2", "x"]


def test_resolve_first_source_wins():
    got = device.resolve(["HR (/min)", "hr", "HR.1", "Odd"], {"HR": "HR", "ART M": "ART_MEAN"})
    assert got == {"HR (/min)": "HR", "hr": "hr", "HR.1": "HR.1", "Odd": "Odd"}


def test_monitor_csv(spark, tmp_path):
    write(
        tmp_path / "case7.csv",
        "OBSERVATION_DATETIME;HR (/min);Odd\n20260105120000.5;70;1\n20260105120000;71;2\n20260105120001;-1401;***\n20260105120002;72;\nbroken;73;4\n",
    )
    got = r.monitor_csv(spark, str(tmp_path), "OBSERVATION_DATETIME", {"HR": "HR"}, [-1401.0])
    t = lambda s: dt.datetime(2026, 1, 5, 12, 0, s)
    assert rows(got, "recording_id", "ts", "variable", "value") == [("case7", t(0), "HR", 70.0), ("case7", t(0), "Odd", 1.0), ("case7", t(2), "HR", 72.0)]


def test_waveform_slices(spark, tmp_path):
    name = "case1260105120000250"
    write(tmp_path / f"{name}-1.csv", "Time (msecs);ART\n0;80,5\n5;81\n")
    write(tmp_path / f"{name}-2.csv", "Time (msecs);ART\n10;82,25\n")
    got = r.waveform_slices(spark, str(tmp_path))
    base = dt.datetime(2026, 1, 5, 12, 0, 0, 250000)
    want = [(name, s, base + dt.timedelta(milliseconds=m), v) for s, m, v in ((1, 0, 80.5), (1, 5, 81.0), (2, 10, 82.25))]
    assert rows(got, "recording_id", "slice", "ts", "value") == want


def test_nol_export(spark, tmp_path):
    write(
        tmp_path / "nol.csv",
        "Id,Age\n7,61\n\n  Abs Time Vector,Relative Time,NOL,HR,Events\n\n12-Aug-2026 14:06:11,0,NaN,NaN,\" Intubation\"\n12-Aug-2026 14:06:16,5,12,70,\nfooter\n",
    )
    got = r.nol_export(spark, str(tmp_path))
    assert rows(got["demographics"], "field", "value") == [("Age", "61"), ("Id", "7")]
    series = got["series"].orderBy("relative_s").collect()
    assert [(x.relative_s, x.nol, x.hr) for x in series] == [(0.0, None, None), (5.0, 12.0, 70.0)]
    assert rows(got["events"], "text") == [("Intubation",)]


def test_eeg_raw(spark, tmp_path):
    x = np.array([[1, -2], [3, 4], [5, 6]], "<i2")
    (tmp_path / "a.r2a").write_bytes(x.tobytes())
    (tmp_path / "odd.r2a").write_bytes(b"\x01\x02\x03")
    got = r.eeg_raw(spark, str(tmp_path))
    good = got.where("error is null").orderBy("channel", "i").collect()
    assert np.allclose([g.value for g in good], x.T.ravel() * r.EEG_SCALE)
    assert rows(got.where("error is not null"), "recording_id", "error") == [("odd", "odd number of bytes")]
    with pytest.raises(ValueError):
        r.decode_eeg(np.array([[0, 0], [20000, 20000], [0, 0], [20000, 20000]], ">i2").tobytes()[:-2] * 2, 3)


def test_eeg_trends_and_pairs(spark, tmp_path):
    write(tmp_path / "a.spa", "title\nTime|BIS value|Other\n2026-01-05 12:00:00|45|1\n2026-01-05 12:00:10|-1|2\n")
    got = r.eeg_trends(spark, str(tmp_path), {"time": "time", "bis": "bis"}, {"bis": 1})
    assert [(x.recording_id, x.variable, x.value) for x in got.orderBy("ts").collect()] == [("a", "bis", 45.0), ("a", "bis", None)]
    raw = spark.createDataFrame([("a", 0, i, i / 128, 1.0, None) for i in range(200)], "recording_id string, channel int, i long, t_s double, value double, error string")
    pair = r.eeg_pairs(raw, got).collect()[0]
    assert pair.duration_mismatch and pair.flat_channel and pair.trend_s == 10.0


def test_pump_events(spark, tmp_path):
    write(tmp_path / "p.csv", "No;Date;Time;Event;Value\n1;05/01/2026;12:00:01;Start;2,5\n")
    got = r.pump_events(spark, str(tmp_path)).collect()[0]
    assert got.ts == dt.datetime(2026, 1, 5, 12, 0, 1) and got.event == "Start" and got["value"] == "2,5"


def test_exam_zip(spark, tmp_path):
    part = io.BytesIO()
    pd.DataFrame({"local_time": [2.0, 1.0], "value": [-32768.0, 5.0]}).to_parquet(part)
    with zipfile.ZipFile(tmp_path / "e1.zip", "w") as z:
        z.writestr("time_bin=0/sensor=draeger/signal=p/x.parquet", part.getvalue())
        z.writestr("time_bin=0/sensor=other/signal=p/x.parquet", part.getvalue())
    got = r.exam_zip(spark, str(tmp_path))
    assert {(x.sensor, x["value"]) for x in got.where("local_time = 2").collect()} == {("draeger", None), ("other", -32768.0)}
    assert got.where("crc_ok").count() == 4


def test_footer_census(spark, tmp_path):
    pd.DataFrame({"a": [1.0, None], "b": [None, None], "c": ["x", "y"]}).astype({"b": float}).to_parquet(tmp_path / "f.parquet")
    got = {x.column: x.has_values for x in r.footer_census(spark, str(tmp_path)).collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_head_census_and_fingerprints(spark, tmp_path):
    write(tmp_path / "a.txt", "\nTitre é\nHeure;HR\n1;2\n3;4,5\n", "cp1252")
    (tmp_path / "b.bin").write_bytes(b"PK\x03\x04rest")
    got = {x.path.rsplit("/", 1)[-1]: x for x in r.head_census(spark, str(tmp_path)).collect()}
    assert got["a.txt"].delimiter == ";" and got["a.txt"].columns == ["Heure", "HR"] and got["a.txt"].numeric_share == 1.0 and got["a.txt"].encoding == "cp1252"
    kinds = {x.path.rsplit("/", 1)[-1]: x.kind for x in r.fingerprints(spark, str(tmp_path)).collect()}
    assert kinds == {"a.txt": "unknown", "b.bin": "zip"}


def test_reader_registry():
    assert r.reader("monitor_csv") is r.monitor_csv
    with pytest.raises(KeyError):
        r.reader("nothing")


def test_catalogues_are_read_as_texts(spark, tmp_path):
    texts = {"a": ('[{"n": 1},\n {"n": 2}]', "utf-8"), "b": ('{"n": 3,\n "s": "é"}', "utf-8-sig"), "c": ('[{"n": 4}]', "utf-16"), "d": ('[{"n": 5}]', "utf-16-le"), "e": ("", "utf-8")}
    for name, (text, encoding) in texts.items():
        (tmp_path / f"{name}.json").write_bytes(text.encode(encoding))
    got = r.json_catalog(spark, str(tmp_path))
    assert sorted((x.n, x.s) for x in got.collect()) == [(1, None), (2, None), (3, "é"), (4, None), (5, None)]
    # The reader of JSON over many lines takes time by the square of the number of files.
    assert "FileScan json" not in got._jdf.queryExecution().executedPlan().toString()
