"""The data source of device files: each file by its own heading, delimiter and encoding, however it is cut in ranges."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.sources import device
from pulsegrid.sources import readers as r


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))


def cells(rows):
    return sorted(((x.path.rsplit("/", 1)[-1], x.time, c["variable"], c["value"]) for x in rows for c in x.cells), key=str)


MIXED = {
    "a.csv": ("T;HR;SPO2\n1;70;97\n2;71;98\n", "utf-8"),
    "b.csv": ("T;SPO2;HR\n1;97;60\n2;98\n", "utf-8"),
    "c.csv": ("T,HR,RR\n1,50,12\n", "utf-8-sig"),
    "d.csv": ("made by x\n\nT|Fréq|HR\n1|é|40\n", "latin-1"),
    "e.csv": ('T\t"HR"\tHR\r\n1\t"4\t1"\t42\r\n\r\n2\té\t43', "utf-16"),
    "f.csv": ("nothing here\n1\n2\n", "utf-8"),
    "g.csv": ("", "utf-8"),
}


@pytest.mark.parametrize("range_bytes", [1 << 20, 7, 1])
def test_each_file_by_its_own_heading(spark, tmp_path, range_bytes):
    for name, (text, encoding) in MIXED.items():
        put(tmp_path / name, text, encoding)
    rows = device.device_csv(spark, str(tmp_path), time_heading="t", aliases={"Fréq": "rate"}, range_bytes=range_bytes).collect()
    assert cells(x for x in rows if not x.error) == sorted(
        [
            *[("a.csv", t, v, x) for t, v, x in (("1", "HR", "70"), ("1", "SPO2", "97"), ("2", "HR", "71"), ("2", "SPO2", "98"))],
            *[("b.csv", t, v, x) for t, v, x in (("1", "HR", "60"), ("1", "SPO2", "97"), ("2", "SPO2", "98"))],
            ("c.csv", "1", "HR", "50"),
            ("c.csv", "1", "RR", "12"),
            ("d.csv", "1", "HR", "40"),
            ("d.csv", "1", "rate", "é"),
            *[("e.csv", t, v, x) for t, v, x in (("1", "HR", "4\t1"), ("1", "HR.1", "42"), ("2", "HR", "é"), ("2", "HR.1", "43"))],
            ("b.csv", "2", "HR", None),
        ],
        key=str,
    )
    assert sorted((x.path[-5:], x.error) for x in rows if x.error) == [("f.csv", "no heading"), ("g.csv", "empty file")]


def test_monitor_files_with_other_headings_keep_their_variables(spark, tmp_path):
    """Three exports of one folder: other order, other delimiter, other columns."""
    t = "20260105120000"
    put(tmp_path / "a.csv", f"T;HR;SPO2\n{t};70;97\n")
    put(tmp_path / "b.csv", f"T;SPO2;HR\n{t};96;60\n")
    put(tmp_path / "c.csv", f"T,HR,RR\n{t},50,12\n")
    got = r.monitor_csv(spark, str(tmp_path), "T", {}, [])
    assert sorted((x.recording_id, x.variable, x.value) for x in got.collect()) == [("a", "HR", 70), ("a", "SPO2", 97), ("b", "HR", 60), ("b", "SPO2", 96), ("c", "HR", 50), ("c", "RR", 12)]
    assert r.unread(spark, str(tmp_path), time_heading="X").count() == 3


def test_export_metadata(spark, tmp_path):
    put(tmp_path / "a.csv", "T;HR;Odd\n" + "".join(f"202601051200{s:02};70;1\n" for s in (0, 1, 2, 4)))
    put(tmp_path / "b.csv", "T;Odd;More\n20260105120000;1;2\n")
    got = {x.recording_id: x for x in r.export_metadata(r.monitor_csv(spark, str(tmp_path), "T", {}, []), ["HR"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.n_rows, a.median_interval_s, a.min_interval_s, a.max_interval_s, a.estimated_hz) == (4, 1.0, 1.0, 2.0, 1.0)
    assert (a.n_recognised, a.n_unknown, a.export_type) == (1, 1, "physiological")
    assert (b.n_rows, b.median_interval_s, b.estimated_hz, b.n_unknown, b.export_type) == (1, None, None, 2, "non_physiological_or_unrecognised")


def test_slices_with_other_columns_and_encodings(spark, tmp_path):
    name = "case1260105120000250"
    put(tmp_path / f"{name}-1.csv", "Time (msecs);ART;µV\n0;80,5;1\n5;81;2\n", "latin-1")
    put(tmp_path / f"{name}-2.csv", "Time (msecs)\tµV\tART\n5\t9\t9\n10\t3\t82,25\n")
    put(tmp_path / f"{name}-4.csv", "Time (msecs)|ART\n8|7\n")
    samples = r.waveform_slices(spark, str(tmp_path))
    base = dt.datetime(2026, 1, 5, 12, 0, 0, 250000)
    got = sorted((x.slice, (x.ts - base).total_seconds() * 1000, x.variable, x.value) for x in samples.collect())
    assert got == [(1, 0, "ART", 80.5), (1, 0, "µV", 1), (1, 5, "ART", 81), (1, 5, "µV", 2), (2, 10, "ART", 82.25), (2, 10, "µV", 3), (4, 8, "ART", 7)]
    order = r.slice_order(samples).orderBy("slice").collect()
    assert [(x.slice, x.n_rows, x.missing_before, x.overlaps) for x in order] == [(1, 2, 0, False), (2, 1, 0, False), (4, 1, 1, True)]


def test_pump_logs_with_other_columns(spark, tmp_path):
    put(tmp_path / "p.csv", "Date;Heure;Drug name\n05/01/2026;12:00:30;X\n")
    put(tmp_path / "q.csv", "Rate,Time\n2,05-01-2026 13:00:00\n")
    got = sorted((x.recording_id, x.ts.hour, x.drug_name, x.rate) for x in r.pump_events(spark, str(tmp_path)).collect())
    assert got == [("p", 12, "X", None), ("q", 13, None, "2")]


@given(st.lists(st.text(alphabet="ab;é日 \r", max_size=9), max_size=12), st.integers(1, 40), st.sampled_from(["utf-8", "utf-16"]))
@settings(max_examples=150, deadline=None)
def test_ranges_cover_every_line_once(lines, size, encoding):
    import io

    raw = ("T;x\n" + "\n".join(lines)).encode(encoding)
    found = device.layout(raw)
    whole = list(device.lines_between(io.BytesIO(raw), found.begin, len(raw), "\n".encode(found.encoding)))
    parts = [line for b in range(0, len(raw), size) for line in device.DeviceReader._lines(io.BytesIO(raw), device.Range("", b, min(len(raw), b + size)), found)]
    assert parts == whole
    assert [line.decode(found.encoding) for _, line in whole] == (lines if lines and lines[-1] else lines[:-1])


def test_short_ranges_share_tasks(tmp_path):
    """Tasks don't grow with the number of files or ranges, and batches hold rows of several files."""
    for i in range(300):
        put(tmp_path / f"{i:03}.csv", f"T;HR\n{i};70\n{i};71\n")
    reader = device.DeviceReader({"path": str(tmp_path), "timeheading": "T", "rangebytes": "5", "tasks": "4"})
    tasks = reader.partitions()
    assert len(tasks) <= 8
    batches = [b for t in tasks for b in reader.read(t)]
    assert len(batches) == len(tasks)
    assert sorted(x for b in batches for x in b.column(2).to_pylist()) == sorted(str(i) for i in range(300) for _ in "xx")


def test_first_rows_name_all_columns(spark, tmp_path):
    put(tmp_path / "p.csv", "Date;Heure;Drug name\n\n\n05/01/2026;12:00\n05/01/2026;12:01;X\n")
    put(tmp_path / "q.csv", "Rate,Time\n")
    rows = device.device_csv(spark, str(tmp_path), time_pattern="time|date|heure", range_bytes=3, first_rows=True).collect()
    assert [(x.time, [c["heading"] for c in x.cells]) for x in rows] == [("05/01/2026 12:00", ["Drug name"])]
    assert r.pump_events(spark, str(tmp_path), range_bytes=3).columns == ["recording_id", "ts", "drug_name"]
