"""Operators on small series whose answers are known by hand; queries against their SQL are in test_queries."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C
from pulsegrid.operators import catalog, filters, learning, quality, stats, validation, windows
from pulsegrid.operators import timeseries as ts


def series(spark, values, step_s=1.0, key="r"):
    t0 = dt.datetime(2026, 1, 1)
    rows = [(key, i, t0 + dt.timedelta(seconds=i * step_s), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, i int, ts timestamp, v double")


def flags(df, column):
    return [x[0] for x in df.orderBy("i").select(column).collect()]


def test_saturation(spark):
    got = ts.saturation(series(spark, [1, 2, 5, 5, 5, 5, 5, 5, 3, 1]), ["k"], "i", "v")
    assert [i for i, f in enumerate(flags(got, "saturated")) if f] == [2, 3, 4, 5, 6, 7]


def test_spike_and_smooth(spark):
    random = np.random.default_rng(0)
    values = random.normal(70, 1, 300)
    values[150] = 4000
    hits = [i for i, f in enumerate(flags(ts.spikes(series(spark, values), ["k"], "i", "v", 100), "spike")) if f]
    assert 150 in hits and len(hits) < 10
    smooth = flags(ts.robust_smooth(series(spark, [70] * 50 + [4000] + [70] * 50), ["k"], "i", "v", 11), "smoothed")
    assert max(smooth) < 100


def test_flatline(spark):
    got = flags(ts.flatline(series(spark, list(range(50)) + [50] * 100), ["k"], "i", "v", 20), "flatline")
    assert all(got[62:135]) and not any(got[:40])


def test_gap_runs(spark):
    got = flags(ts.missing_gaps(series(spark, [70] * 10 + [None] * 30 + [70] * 10 + [None]), ["k"], "i", "v", 10), "qc")
    assert got.count("GAP") == 30 and got[-1] == "MISSING"


def test_missingness_kinds(spark):
    kind = lambda v: ts.missingness(series(spark, v), ["k"], "i", "v").first().kind
    assert kind([1] * 20) == "complete"
    assert kind([1, None] + [1] * 20) == "sparse_isolated"
    assert kind([1] * 30 + [None] * 15 + [1]) == "gappy"
    assert kind([None] * 5) == "entirely_missing"


def test_time_base(spark):
    t0 = dt.datetime(2026, 1, 1)
    rows = [("k", i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate([*(j * 0.005 for j in range(2000)), 30.0, 30.005])]
    got = ts.time_base(spark.createDataFrame(rows, "k string, i int, ts timestamp"), ["k"], "i", "ts").first()
    assert got.nominal_hz == pytest.approx(200.0) and got.gap_fraction > 0 and got.gap_s > 15


def test_validity_keeps_unknown(spark):
    spec = quality.dictionary(spark, [("HR", 20.0, 250.0, False, False), ("ECG", -5.0, 5.0, True, True), ("X", None, 5.0, False, False)])
    rows = [("HR", 70.0), ("HR", 4000.0), ("HR", 0.0), ("HR", -1401.0), ("ECG", 0.5), ("odd", 3.0), ("X", 9.0), ("HR", None)]
    df = spark.createDataFrame(rows, "variable string, v double").withColumn("i", F.monotonically_increasing_id())
    got = quality.validity(df, "v", "variable", spec, [-1401.0]).orderBy("i").collect()
    assert [g.qc for g in got] == ["VALID", "INVALID_RANGE", "INVALID_RANGE", "MISSING", "LOW_QUALITY", "UNREVIEWED", "VALID", "MISSING"]
    assert got[1].clean is None and got[5].clean == 3.0


def test_safety_rails(spark):
    df = series(spark, [1, 2, 3, 4])
    got = flags(quality.safety_rails(df, ["k"], "v", F.col("v") > 1), "qc")
    assert got == ["VALID"] + ["KEPT_OVERFILTER_REVIEW"] * 3
    assert set(flags(quality.safety_rails(df, ["k"], "v", F.col("v") > 0), "qc")) == {"KEPT_WOULD_WIPE"}


def test_local_to_utc_ambiguous_and_missing_hours(spark):
    rows = [(dt.datetime(2026, 1, 5, 12),), (dt.datetime(2026, 3, 8, 2, 30),), (dt.datetime(2026, 11, 1, 1, 30),)]
    got = spark.createDataFrame(rows, "t timestamp").select(C.local_to_utc(F.col("t"), "America/Montreal").alias("u")).collect()
    assert [g.u for g in got] == [dt.datetime(2026, 1, 5, 17), None, None]


def test_text_helpers(spark):
    df = spark.createDataFrame([('  "Heart  Rate" ', "HR.1.2", "Âge – Été", "12,5", "a/Bc12/x.csv")], "a string, b string, c string, d string, e string")
    got = df.select(
        C.normal_key(F.col("a")), C.without_copy_suffix(F.col("b")), C.folded(F.col("c")), C.decimal_comma(F.col("d")), C.redacted(F.col("e"), ["a"]), C.versioned_key(F.col("e"), F.lit("0123456789"))
    ).first()
    assert list(got) == ["heart rate", "HR", "age ete", 12.5, "a/aa##/a.aaa", "a/Bc12/x.v2-01234567.csv"]


def plain_filter(x, order, cutoff, fs, kind):
    """The recursion over the whole series, forward and backward, sample by sample."""
    sections = filters.butter_sections(order, cutoff, fs, kind)
    good = ~np.isnan(x)
    if sections is None or good.sum() < 3 * order + 1:
        return x
    v = x[good]
    pad = min(3 * (2 * len(sections) + 1), len(v) - 1)
    y = np.concatenate([2 * v[0] - v[pad:0:-1], v, 2 * v[-1] - v[-2 : -pad - 2 : -1]])
    for _ in range(2):
        for b0, b1, b2, _one, a1, a2 in sections:
            level = y[0] * (b0 + b1 + b2) / (1 + a1 + a2)
            z1, z2, out = level - b0 * y[0], b2 * y[0] - a2 * level, []
            for s in y:
                out.append(b0 * s + z1)
                z1, z2 = b1 * s - a1 * out[-1] + z2, b2 * s - a2 * out[-1]
            y = np.array(out)
        y = y[::-1]
    got = x.copy()
    got[good] = y[pad : len(y) - pad]
    return got


def test_butterworth_response():
    fs = 200.0
    t = np.arange(0, 5, 1 / fs)
    x = np.sin(2 * np.pi * t) + 0.5 * np.sin(2 * np.pi * 60 * t)
    y = plain_filter(x, 4, 10.0, fs, "low")
    assert np.std((y - np.sin(2 * np.pi * t))[100:-100]) < 0.01
    y = plain_filter(x, 4, 30.0, fs, "high")
    assert np.std((y - 0.5 * np.sin(2 * np.pi * 60 * t))[100:-100]) < 0.01
    y = plain_filter(x, 3, (40.0, 80.0), fs, "band")
    assert np.std((y - 0.5 * np.sin(2 * np.pi * 60 * t))[100:-100]) < 0.02
    # A gain of 1 / sqrt(2) at the cut-off, once per pass.
    sections = filters.butter_sections(4, 10.0, fs, "low")
    z = np.exp(2j * np.pi * 10 / fs)
    gain = np.prod([(s[0] * z**2 + s[1] * z + s[2]) / (z**2 + s[4] * z + s[5]) for s in sections])
    assert abs(gain) == pytest.approx(math.sqrt(0.5), rel=1e-6)


@pytest.mark.parametrize(
    "order,cutoff,fs,kind,size",
    [(2, 0.1, 1.0, "low", 50), (4, 0.003, 1.0, "low", 64), (4, 0.1, 1.0, "high", 100), (3, (0.05, 0.2), 1.0, "band", 37), (4, 0.1, 1.0, "low", 5000), (2, (0.5, 40.0), 1.0, "band", 50)],
)
def test_filter_in_blocks_equals_the_recursion(spark, order, cutoff, fs, kind, size):
    """With a memory of many blocks too; nulls, short series, single blocks and a null key."""
    random = np.random.default_rng(6)
    waves = {"a": np.cumsum(random.normal(0, 1, 1203)), "b": random.normal(0, 1, 150), "c": random.normal(0, 1, 6), None: random.normal(5, 1, 333), "d": np.array([np.nan] * 9), "e": random.normal(0, 1, 14)}
    waves["a"][random.random(1203) < 0.1] = np.nan
    rows = [(k, i, None if np.isnan(v) else float(v)) for k, w in waves.items() for i, v in enumerate(w)]
    df = spark.createDataFrame(rows, "k string, i long, v double").repartition(4)
    got = {(r.k, r.i): r.filtered for r in filters.filtered(df, ["k"], "i", "v", fs, kind, cutoff, order, size=size).collect()}
    assert len(got) == len(rows)
    for k, w in waves.items():
        y = np.array([np.nan if got[k, i] is None else got[k, i] for i in range(len(w))])
        assert np.allclose(y, plain_filter(w, order, cutoff, fs, kind), atol=1e-9, equal_nan=True), k


def test_ecg_labels(spark):
    random, t = np.random.default_rng(1), np.arange(60 * 360) / 360
    beat = np.exp(-((t % 0.8 - 0.4) ** 2) / 0.002)
    x = beat + random.normal(0, 0.005, len(t))
    x[3600:3960] = x[3600]
    x[30 * 360 : 31 * 360] += random.normal(0, 0.3, 360)
    qc = filters.ecg_qc(x, 360.0)
    assert qc[10] == "FLAT" and "NOISY" in qc[29:32] and (qc == "VALID").mean() > 0.7


@pytest.mark.parametrize("m,n", [(1, 1), (3, 3), (3, 5), (5, 4), (2, 8)])
def test_exact_u_counts_all_splits(m, n):
    from itertools import combinations

    us = [sum(ranks) - m * (m + 1) // 2 for ranks in combinations(range(1, m + n + 1), m)]
    for u in range(m * n + 1):
        low = min(u, m * n - u)
        assert stats.exact_u(m, n, u) == pytest.approx(min(1.0, 2 * sum(x <= low for x in us) / len(us)))


def test_rank_test_methods(spark):
    rows = [("small", "a", 1.0), ("small", "a", 2.0), ("small", "a", 3.0), ("small", "b", 4.0), ("small", "b", 5.0), ("small", "b", 6.0), ("small", "b", 9.0)]
    rows += [("ties", g, float(i % 4)) for g in "ab" for i in range(5)] + [("large", "ab"[i % 2], float(i * 37 % 101)) for i in range(40)]
    rows += [("three", "abc"[i % 3], float(i)) for i in range(12)] + [("one", "a", float(i)) for i in range(4)]
    got = {r.s: r for r in stats.rank_test(spark.createDataFrame(rows, "s string, g string, v double"), "g", "v", ["s"]).collect()}
    assert {k: r.method for k, r in got.items()} == {"small": "exact", "ties": "normal", "large": "normal", "three": "chi2", "one": None}
    assert got["small"].u == 0 and got["small"].p == pytest.approx(2 / 35)
    assert got["one"].p is None


def test_rank_test_against_known_values(spark):
    # Ranks 1, 2, 3, 4 and 7 of ten: U = 17 - 15.
    rows = [("a", v) for v in (1.0, 2.0, 3.0, 4.0, 7.0)] + [("b", v) for v in (5.0, 6.0, 8.0, 9.0, 10.0)]
    got = stats.rank_test(spark.createDataFrame(rows, "g string, v double"), "g", "v").first()
    assert got.u == 2.0 and got.n_groups == 2
    # Small groups without ties are exact: of 252 splits 1, 1 and 2 give 0, 1 and 2. Nine against nine are not.
    assert got.p == pytest.approx(2 * 4 / 252)
    rows = [("a", float(v)) for v in range(9)] + [("b", v + 0.5) for v in range(9)]
    got = stats.rank_test(spark.createDataFrame(rows, "g string, v double"), "g", "v").first()
    assert got.p == pytest.approx(math.erfc((40.5 - 36 - 0.5) / math.sqrt(81 * 19 / 12) / math.sqrt(2)))
    assert stats.chi2_tail(5.991464547, 2) == pytest.approx(0.05)
    assert stats.chi2_tail(3.841458821, 1) == pytest.approx(0.05)


def test_k_anonymity(spark):
    rows = [("big", u, 1.0) for u in range(5)] + [("small", u, 1.0) for u in range(4)]
    got = stats.k_anonymous(spark.createDataFrame(rows, "g string, u int, v double"), ["g"], "u", "v").collect()
    assert [g.g for g in got] == ["big"]


def test_full_grid_and_gaps(spark):
    df = series(spark, [1, 2, 3, 4, 5, 6]).where("i not in (2, 3)").withColumn("label", F.lit("hr"))
    w = windows.windowize(df, ["k", "label"], "ts", "v", F.lit(True), 1.0, by=["k"])
    grid = windows.full_grid(w, "k", "label", ["hr"])
    assert grid.count() == 6
    gap = windows.empty_stretches(grid, "k", ["hr"], 1.0, 2.0).first()
    assert (gap["first"], gap["last"], gap["n"]) == (2, 3, 2)


def test_size_chunks(spark):
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate([2, 2, 9, 1, 1, 1])], "s string, i int, n int")
    assert flags(catalog.size_chunks(df, ["s"], "i", "n", 4), "chunk") == [0, 0, 1, 2, 2, 2]


def test_size_chunks_streams_long_scopes(spark):
    n = 200_000
    df = spark.range(n + 10).select(F.when(F.col("id") < n, 1).alias("s"), F.col("id").alias("i"), (F.col("id") % 7 + 1).alias("n"))
    out = catalog.size_chunks(df, ["s"], "i", "n", 20)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    twice = catalog.size_chunks(spark.createDataFrame([("s", 1, 3), ("s", 1, 3), ("s", None, 1)], "s string, i int, n int"), ["s"], "i", "n", 4)
    assert sorted((r.i is None, r.chunk) for r in twice.collect()) == [(False, 0), (False, 1), (True, 1)]
    want, used, chunk = [], 0, -1
    for i in range(n + 10):
        size = i % 7 + 1
        if i in (0, n):
            used, chunk = 0, -1
        if chunk < 0 or used + size > 20:
            used, chunk = 0, chunk + 1
        used += size
        want.append(chunk)
    assert flags(out, "chunk") == want


def test_split_keeps_units_together(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("u"))
    got = learning.split(df, "u").groupBy("u").agg(F.countDistinct("part").alias("n"))
    assert got.where("n > 1").count() == 0


def test_missing_scores_never_win(spark):
    rows = [("m", "v1", 0.9), ("m", "v2", None), ("n", "v1", None)]
    got = {r.model: r.version for r in validation.champion(spark.createDataFrame(rows, "model string, version string, f1 double"), "model", "f1", "version").collect()}
    assert got == {"m": "v1", "n": "v1"}
    rows = [("u", "d", "ODD"), ("u", "d", "FAIL"), ("u", "e", "ODD"), ("u", "e", "PASS")]
    got = validation.checklist(spark.createDataFrame(rows, "u string, d string, r string"), "u", "d", "r", ["d", "e", "f"], ("FAIL", "PASS")).first()
    assert (got.d, got.e, got.f) == ("FAIL", "PASS", "ABSENT")
    assert validation.worst_kind(spark.createDataFrame(rows, "u string, d string, r string"), ["u"], "r", ("FAIL", "PASS")).first().worst_kind == "FAIL"


def test_nothing_is_resurrected(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "clean double, filtered double")
    assert [r.filtered for r in quality.never_resurrect(df, "clean", "filtered").collect()] == [2.0, None]


def test_windows_are_interpolated(spark):
    df = spark.createDataFrame([([1.0, None, 3.0],), ([None, None, 1.0],), (None,)], "w array<double>")
    assert [r.w for r in filters.interpolate_windows(df, "w").collect()] == [[1.0, 2.0, 3.0], None, None]


def test_learning_helpers(spark):
    assert learning.promote(0.80, 0.82) and not learning.promote(0.80, 0.805)
    df = spark.createDataFrame([(0.3, 1.0, 0.9), (0.0, 0.0, 0.9), (0.0, 1.0, 0.1), (0.0, 1.0, 0.9)], "m double, s double, n double")
    assert [r.p for r in df.select(learning.pseudo_label(F.col("m"), F.col("s"), F.col("n"), True).alias("p")).collect()] == [1, 1, 1, 0]
    rows = spark.createDataFrame([(float(i), i % 7 / 7.0, int(i >= 30)) for i in range(60)], "a double, b double, y int")
    out = learning.probability(learning.boosted(rows, ["a", "b"], "y", rounds=3), rows)
    assert out.where("(p > 0.5) = (y = 1)").count() >= 58


def test_correlation_with_a_constant_is_no_error(spark):
    rows = [("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 7.0), ("up", None, -9.0), ("flat", 5.0, 1.0), ("flat", 5.0, 2.0), ("none", 1.0, None)]
    got = dict(spark.createDataFrame(rows, "k string, a double, b double").groupBy("k").agg(stats.correlation(F.col("a"), F.col("b")).alias("r")).collect())
    assert got["up"] == pytest.approx(0.99339927) and math.isnan(got["flat"]) and got["none"] is None


def test_window_means_add_in_order(spark):
    values = [0.1, 1e16, 0.2, -1e16, 0.7, 3.3, None, 0.1] * 3
    df = series(spark, values).repartition(5, "v")
    got = {r.window: r.mean for r in windows.sliding_features(df, ["k"], "i", "v", 8, 8, 1).collect()}
    total = 0.0
    for v in values[:8]:
        total += v or 0.0
    assert got == {w: total / 7 for w in range(3)}


def test_columns_of_files_are_dealt_by_their_number(spark, sf_dir, monkeypatch):
    """Tasks that join and count the columns of files hold so many rows, however many there are."""
    from pulsegrid.plans import audit

    monkeypatch.setattr(audit, "COLUMNS_OF_TASK", 100, raising=False)
    # As for tables that are too large to be broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = audit._columns(spark, sf_dir)
        most = lambda df: df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        assert rows.count() > 5000
        assert most(rows) < 400
        # Counts by file stay where the rows are.
        assert most(rows.groupBy("project", "name", "file").count()) < 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_forest_makes_its_rows_once(spark):
    """However often the training reads them."""
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 400, 1, 40).selectExpr("id", "cast(id % 7 as double) AS a", "cast(id % 5 as double) AS b", "cast(id % 7 > 3 AS int) AS y")
    rows = rows.mapInArrow(make, "id long, a double, b double, y int")
    model = learning.forest(rows, ["a", "b"], "y", trees=5, depth=3)
    assert made.value == 400
    assert model.transform(rows).where("prediction <> y").isEmpty()


def test_short_series_are_filtered_whole_in_one_pass_however_batches_cut_them(spark):
    rng = np.random.default_rng(5)
    sizes = [1, 9, 10, 30, 31, 32, 70, 5]
    rows = [(k, i, float(v)) for k, n in enumerate(sizes) for i, v in enumerate(rng.normal(size=n))]
    rows += [(6, 100 + i, None) for i in range(3)] + [(None, i, float(i % 4)) for i in range(12)]
    df = spark.createDataFrame(rows, "k int, i int, v double").repartition(5)
    whole = filters.filtered(df, ["k"], "i", "v", 1.0, "high", 0.02, 3)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.k, r.i): r.filtered for r in whole.collect()}
        # A size of 16 cuts all of 32 samples or more in blocks.
        blocks = {(r.k, r.i): r.filtered for r in filters.filtered(df, ["k"], "i", "v", 1.0, "high", 0.02, 3, size=16).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.keys() == blocks.keys() == {r[:2] for r in rows}
    for k, i, v in rows:
        if v is None or k is not None and sizes[k] < 10:
            assert got[k, i] == blocks[k, i] == v
        else:
            assert abs(got[k, i] - blocks[k, i]) < 1e-9 and got[k, i] != v
