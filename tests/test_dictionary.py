import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import dictionary as d


def test_profile_inherits_and_merges():
    profiles = {"base": {"a": {"x": 1, "y": 2}, "b": [1]}, "child": {"extends": "base", "a": {"y": 3}, "b": [2]}}
    assert d.profile(profiles, "child") == {"a": {"x": 1, "y": 3}, "b": [2]}
    with pytest.raises(ValueError):
        d.profile({"a": {"extends": "b"}, "b": {"extends": "a"}}, "a")


def test_overlay_tells_what_it_changes():
    got, changed = d.overlay({"HR": {"min": 20, "max": 250, "detectors": ["spike"]}}, {"HR": {"min": 30, "max": 250}, "NEW": {"min": 0, "max": 1}})
    assert got == {"HR": {"min": 30, "max": 250, "detectors": ["spike"]}, "NEW": {"min": 0, "max": 1}}
    assert changed == ["HR.min: 20 -> 30"]
    assert d.unknown_methods({"HR": {"detectors": ["spike", "odd"], "filter": "none"}}, ["spike"]) == ["HR: none", "HR: odd"]


def test_families(spark):
    names = ["NBP S (mm(hg))", "ART M (mmHg)", "HR (/min)", "HRV", "SpO2", "T1 temp", "odd"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(d.family(F.col("n"))).collect()] == ["NIBP", "IBP", "HR", "OTHER", "SPO2", "TEMP", "OTHER"]


def test_tiers_and_paths(spark):
    df = spark.createDataFrame([("study/Patient 7/monitor/case_hr.csv",), ("study/p12/pump/notes.pdf",), ("x/eeg/a.r2a",), ("x/unknown.bin",)], "path string")
    got = d.classify_paths(df, "path", [(r"_hr\.csv$", "monitor", "raw"), (r"\.r2a$", "eeg", "raw"), (r"notes", "document", "doc")], {"monitor": "monitor", "pump": "pump", "eeg": "eeg"})
    assert [(r.source, r.stage, r.subject, r.needs_review) for r in got.collect()] == [("monitor", "raw", "007", False), ("document", "doc", "012", True), ("eeg", "raw", None, False), (None, None, None, True)]
    names = spark.createDataFrame([("a.tmp",), ("a.csv",), ("a.pdf",), ("a.x",)], "n string")
    assert [r[0] for r in names.select(d.tier(F.col("n"), ["*.tmp"], ["*.csv", "*.tmp"], ["*.pdf"])).collect()] == ["C", "A", "B", None]


def test_mapping_tiers(spark):
    aliases = d.alias_table(spark, {"HR": ["Heart Rate"], "ART_MEAN": ["ART M"]})
    df = spark.createDataFrame([("heart  rate",), ("ART M (mm(hg)^^ISO+)",), ("HR.11",), ("pump rate",), ("??",)], "name string")
    got = {r.name: (r.variable, r.tier) for r in d.map_columns(df, "name", aliases, [("pump", "device")]).select("name", "variable", "tier").collect()}
    assert got == {"heart  rate": ("HR", "alias_exact"), "ART M (mm(hg)^^ISO+)": ("ART_MEAN", "alias_base"), "HR.11": ("HR", "alias_base"), "pump rate": ("device", "classified"), "??": (None, "review")}
