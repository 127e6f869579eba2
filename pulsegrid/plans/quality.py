"""Queries on validity, analysis windows and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import quality, windows
from pulsegrid.operators.timeseries import seconds
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import KEYS, samples, with_missing
from pulsegrid.session import table

#: Ranges for the event types, standing for variables; ``error`` has no entry, ``click`` only a fallback range.
SPEC = [
    ("click", 20.0, 250.0, True, True),
    ("view", 40.0, 160.0, False, False),
    ("purchase", None, 200.0, False, False),
    ("signup", 0.0, 300.0, True, False),
]
_SPEC = "(VALUES " + ", ".join(f"('{v}', {'NULL' if lo is None else lo}::DOUBLE, {hi}::DOUBLE, {z}, {f})" for v, lo, hi, z, f in SPEC) + ") d(variable, low, high, zero_is_valid, fallback)"
#: Every fifth sample is given a missing code, every seventh a zero.
_X = "CASE WHEN event_id % 5 = 0 THEN -1401 WHEN event_id % 7 = 0 THEN 0 ELSE value END"


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("event_id") % 5 == 0, -1401.0).when(F.col("event_id") % 7 == 0, 0.0).otherwise(F.col("value"))
    return samples(spark, sf_dir).withColumn("x", x)


@query(f"""
SELECT event_id, CASE WHEN x = -1401 THEN 'MISSING' WHEN variable IS NULL THEN 'UNREVIEWED'
       WHEN low IS NOT NULL AND high IS NOT NULL AND ((x = 0 AND NOT zero_is_valid) OR x < low OR x > high) THEN 'INVALID_RANGE'
       WHEN fallback THEN 'LOW_QUALITY' ELSE 'VALID' END AS qc,
       CASE WHEN x = -1401 OR (low IS NOT NULL AND high IS NOT NULL AND ((x = 0 AND NOT zero_is_valid) OR x < low OR x > high)) THEN NULL ELSE x END AS clean
FROM (SELECT *, {_X} AS x FROM events) LEFT JOIN {_SPEC} ON event_type = variable""")
def validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.validity(coded(spark, sf_dir), "x", "event_type", quality.dictionary(spark, SPEC), [-1401.0, 9999.0])
    return out.select("event_id", "qc", "clean")


@query(f"""
SELECT event_id, CASE WHEN x IN (-1401, 9999) OR (x = 0 AND NOT coalesce(zero_is_valid, true)) THEN NULL ELSE x END AS x
FROM (SELECT *, {_X} AS x FROM events) LEFT JOIN {_SPEC} ON event_type = variable""")
def missing_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.missing_rules(coded(spark, sf_dir), "x", "event_type", quality.dictionary(spark, SPEC), [-1401.0, 9999.0])
    return out.select("event_id", "x")


@query(f"""
WITH q AS (
  SELECT event_type, CASE WHEN x = -1401 THEN 'MISSING' WHEN variable IS NULL THEN 'UNREVIEWED'
         WHEN low IS NOT NULL AND high IS NOT NULL AND ((x = 0 AND NOT zero_is_valid) OR x < low OR x > high) THEN 'INVALID_RANGE'
         WHEN fallback THEN 'LOW_QUALITY' ELSE 'VALID' END AS qc
  FROM (SELECT *, {_X} AS x FROM events) LEFT JOIN {_SPEC} ON event_type = variable
)
SELECT event_type, qc, count(*) AS n FROM q GROUP BY ALL""")
def qc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.validity(coded(spark, sf_dir), "x", "event_type", quality.dictionary(spark, SPEC), [-1401.0, 9999.0])
    return out.groupBy("event_type", "qc").agg(F.count("*").alias("n"))


@query("""
WITH h AS (SELECT event_id, user_id, event_type, value, value > 100 AS hit FROM events),
s AS (SELECT *, sum(hit::INT) OVER w / count(value) OVER w AS share FROM h WINDOW w AS (PARTITION BY user_id, event_type)),
q AS (SELECT event_id, value, CASE WHEN NOT hit THEN 'VALID' WHEN share >= 0.99 THEN 'KEPT_WOULD_WIPE' WHEN share > 0.5 THEN 'KEPT_OVERFILTER_REVIEW' ELSE 'ARTIFACT' END AS qc FROM s)
SELECT event_id, qc, CASE WHEN qc <> 'ARTIFACT' THEN value END AS kept FROM q""")
def safety_rails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.safety_rails(samples(spark, sf_dir), KEYS, "value", F.col("value") > 100).select("event_id", "qc", "kept")


@query("""
WITH k AS (SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'scalar' WHEN event_type = 'signup' THEN 'setting' ELSE 'event' END AS kind,
                  CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'on' ELSE CAST(event_id AS VARCHAR) END AS t FROM events)
SELECT event_id, CASE WHEN kind = 'event' THEN 'VALID' WHEN trim(t) = '' THEN 'MISSING' WHEN kind = 'setting' THEN 'VALID'
       WHEN try_cast(t AS DOUBLE) IS NULL THEN 'INVALID' ELSE 'VALID' END AS qc FROM k""")
def class_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    kind = F.when(e.isin("view", "click"), "scalar").when(e == "signup", "setting").otherwise("event")
    i = F.col("event_id")
    text = F.when(i % 11 == 0, "").when(i % 13 == 0, "on").otherwise(i.cast("string"))
    return quality.by_class(samples(spark, sf_dir).withColumn("kind", kind).withColumn("t", text), "t", "kind").select("event_id", "qc")


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, l_quantity AS vt, l_linenumber * 10.0 AS rr, l_quantity * l_linenumber / 90.0 AS mve,
                  l_discount * 100 AS pip, l_tax * 100 AS pplat, 1.0 AS peep FROM lineitem),
c AS (SELECT l_orderkey, l_linenumber, coalesce(abs(mve - vt * rr / 1000) / nullif(abs(vt * rr / 1000), 0) <= 0.3, true) AS minute_volume_ok,
             coalesce(pip >= pplat AND pplat >= peep, true) AS pressure_order_ok FROM f)
SELECT minute_volume_ok, pressure_order_ok, NOT (minute_volume_ok AND pressure_order_ok) AS any_violation, count(*) AS n FROM c GROUP BY ALL""")
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    df = table(spark, sf_dir, "lineitem").select(
        c("l_quantity").alias("vt"), (c("l_linenumber") * 10.0).alias("rr"), (c("l_quantity") * c("l_linenumber") / 90.0).alias("mve"),
        (c("l_discount") * 100).alias("pip"), (c("l_tax") * 100).alias("pplat"), F.lit(1.0).alias("peep"),
    )
    return quality.consistency(df).groupBy("minute_volume_ok", "pressure_order_ok", "any_violation").agg(F.count("*").alias("n"))


@query("""
SELECT l_linenumber, round(avg(abs(l_discount * 1000 - l_tax * 1000)), 6) AS gradient, round(avg((abs(l_discount * 1000 - l_tax * 1000) >= 30)::INT) * 100, 6) AS high_pct
FROM lineitem GROUP BY l_linenumber""")
def pressure_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select("l_linenumber", (F.col("l_discount") * 1000).alias("art"), (F.col("l_tax") * 1000).alias("nbp"))
    out = quality.pressure_gradient(df, "art", "nbp", 30.0).groupBy("l_linenumber")
    return out.agg(F.round(F.avg("gradient"), 6).alias("gradient"), F.round(F.avg(F.col("gradient_high").cast("int")) * 100, 6).alias("high_pct"))


@query("""
WITH s AS (SELECT event_id, user_id, ts, CASE WHEN value >= 30 THEN value END AS v, row_number() OVER w AS pos FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS lp,
             min(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np FROM s),
g AS (SELECT n.event_id, np - lp - 1 AS gap, a.v + (b.v - a.v) * (n.pos - lp) / (np - lp) AS corrected, a.v AS av, b.v AS bv
      FROM n JOIN s a ON a.user_id = n.user_id AND a.pos = lp JOIN s b ON b.user_id = n.user_id AND b.pos = np WHERE n.v IS NULL)
SELECT event_id, gap, round(corrected, 6) AS corrected FROM g WHERE gap BETWEEN 2 AND 10 AND av BETWEEN 30 AND 400 AND bv BETWEEN 30 AND 400""")
def short_gap_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.when(F.col("value") >= 30, F.col("value")))
    out = quality.short_gap_examples(df, ["user_id"], "ts", "v", 30, 400)
    return out.select("event_id", F.col("gap").cast("long").alias("gap"), F.round("corrected", 6).alias("corrected"))


_DAY = 86400.0
_WINDOWS = f"""
o AS (SELECT user_id, min(epoch_us(ts)) / 1e6 AS t0 FROM events GROUP BY user_id),
w AS (SELECT user_id, event_type, floor((epoch_us(ts) / 1e6 - t0) / {_DAY})::BIGINT AS win, median(CASE WHEN value >= 100 THEN value END) AS value,
             count(CASE WHEN value >= 100 THEN value END) AS n_valid FROM events JOIN o USING (user_id) GROUP BY ALL)"""
_GRID = f"""{_WINDOWS},
e AS (SELECT user_id, min(win) AS a, max(win) AS b FROM w GROUP BY user_id),
spine AS (SELECT user_id, unnest(generate_series(a, b)) AS win FROM e),
p AS (SELECT user_id, win, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS "view" FROM w GROUP BY ALL),
g AS (SELECT spine.user_id, spine.win, click, "view" FROM spine LEFT JOIN p USING (user_id, win))"""


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowize(samples(spark, sf_dir), KEYS, "ts", "value", F.col("value") >= 100, _DAY, by=["user_id"])


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.full_grid(_windows(spark, sf_dir), "user_id", "event_type", ["click", "view"])


@query(f'WITH {_WINDOWS} SELECT user_id, event_type, win AS "window", round(value, 6) AS value, n_valid FROM w')
def windowize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir).withColumn("value", F.round("value", 6))


@query(f'WITH {_GRID} SELECT user_id, win AS "window", round(click, 6) AS click, round("view", 6) AS "view" FROM g')
def full_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("user_id", "window", F.round("click", 6).alias("click"), F.round("view", 6).alias("view"))


@query(f"""
WITH {_GRID},
c AS (SELECT *, click IS NULL AND "view" IS NULL AS empty FROM g),
n AS (SELECT *, CASE WHEN lag(empty) OVER x = empty THEN 0 ELSE 1 END AS new FROM c WINDOW x AS (PARTITION BY user_id ORDER BY win)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY win) AS run FROM n),
s AS (SELECT user_id, run, min(win) AS first, max(win) AS last, count(*) AS n FROM r WHERE empty GROUP BY ALL)
SELECT user_id, first, last, n FROM s WHERE n * {_DAY} >= {3 * _DAY}""")
def recording_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.empty_stretches(_grid(spark, sf_dir), "user_id", ["click", "view"], _DAY, 3 * _DAY)


@query(f"""
WITH {_GRID},
t AS (SELECT *, coalesce(click, 0) AS x, lag(coalesce(click, 0)) OVER z AS px, abs(click - lag(click) OVER z) AS ch FROM g WINDOW z AS (PARTITION BY user_id ORDER BY win))
SELECT user_id, round(avg(click), 6) AS mean, round(stddev_pop(click), 6) AS sd, round(count(click) / count(*) * 100, 6) AS valid_pct,
       round(coalesce(sum((x + px) / 2 * {_DAY}), 0), 3) AS auc, round(avg((click > 150)::INT) * 100, 6) AS over_pct, round(sum(x) * {_DAY}, 3) AS total, round(max(ch), 6) AS max_change
FROM t GROUP BY user_id""")
def patient_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.patient_features(_grid(spark, sf_dir), ["user_id"], "window", "click", _DAY, 150)
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("mean", "sd", "valid_pct", "over_pct", "max_change")], F.round("auc", 3).alias("auc"), F.round("total", 3).alias("total"))


@query("""
WITH s AS (SELECT user_id, ts, event_id, value AS v, lag(value) OVER w AS b, lead(value, 1) OVER w AS l1, lead(value, 2) OVER w AS l2,
                  median(CASE WHEN value > 0 THEN value END) OVER (PARTITION BY user_id) AS lev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
h AS (SELECT * FROM s WHERE abs(v - b) > 0.25 * lev AND abs(l1 - b) > 0.25 * lev AND abs(l2 - b) > 0.25 * lev),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS k FROM h)
SELECT user_id, event_id, round(v - b, 6) AS step FROM r WHERE k = 1""")
def dose_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.dose_steps(samples(spark, sf_dir), ["user_id"], "ts", "value").select("user_id", "event_id", F.round("step", 6).alias("step"))


@query("""
WITH e AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS t0, event_id % 2 = 0 AS low FROM events WHERE event_type = 'purchase'),
s AS (SELECT user_id, epoch_us(ts) / 1e6 AS t, value FROM events WHERE event_type <> 'purchase'),
p AS (SELECT e.event_id, e.user_id, low, CASE WHEN t - t0 >= -86400 AND t - t0 < 0 THEN value END AS b, CASE WHEN t - t0 > 0 AND t - t0 <= 86400 THEN value END AS a
      FROM e LEFT JOIN s ON e.user_id = s.user_id AND t BETWEEN t0 - 86400 AND t0 + 86400)
SELECT user_id, event_id, round(median(b), 6) AS baseline, round(CASE WHEN low THEN min(a) ELSE max(a) END, 6) AS peak,
       round(CASE WHEN low THEN min(a) ELSE max(a) END - median(b), 6) AS delta FROM p GROUP BY user_id, event_id, low""")
def event_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("t", seconds(F.col("ts")))
    events = df.where("event_type = 'purchase'").select("user_id", "event_id", F.col("t").alias("at"))
    out = windows.event_response(events, df.where("event_type <> 'purchase'"), "user_id", "event_id", "at", "t", "value", 86400.0, F.col("event_id") % 2 == 0)
    return out.select("user_id", "event_id", *[F.round(c, 6).alias(c) for c in ("baseline", "peak", "delta")])


@query("""
WITH s AS (SELECT user_id, epoch_us(ts) / 1e6 AS start_s, epoch_us(ts) / 1e6 + 7200 AS end_s, (value > 60)::INT AS label FROM events),
w AS (SELECT DISTINCT user_id, floor(epoch_us(ts) / 1e6 / 14400) * 14400 AS w_start, floor(epoch_us(ts) / 1e6 / 14400) * 14400 + 14400 AS w_end FROM events),
p AS (SELECT w.user_id, w_start, w_end, label, least(end_s, w_end) - greatest(start_s, w_start) AS o FROM w JOIN s ON w.user_id = s.user_id AND start_s < w_end AND end_s > w_start),
a AS (SELECT user_id, w_start, w_end, sum(CASE WHEN label = 1 THEN o ELSE 0 END) AS artifact_s, sum(CASE WHEN label = 0 THEN o ELSE 0 END) AS clean_s FROM p WHERE o > 0 GROUP BY ALL)
SELECT user_id, w_start, round(artifact_s, 3) AS artifact_s, round(clean_s, 3) AS clean_s, (artifact_s >= clean_s)::INT AS label FROM a""")
def segment_label_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("t", seconds(F.col("ts")))
    segments = df.select("user_id", F.col("t").alias("start_s"), (F.col("t") + 7200).alias("end_s"), (F.col("value") > 60).cast("int").alias("label"))
    start = F.floor(F.col("t") / 14400) * 14400.0
    w = df.select("user_id", start.alias("w_start"), (start + 14400).alias("w_end")).distinct()
    out = windows.segment_votes(segments, w, "user_id", 14400.0)
    return out.select("user_id", "w_start", F.round("artifact_s", 3).alias("artifact_s"), F.round("clean_s", 3).alias("clean_s"), "label")


@query("""
WITH s AS (SELECT user_id, value AS v, row_number() OVER w - 1 AS i, abs(value - lag(value) OVER w) AS d, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
x AS (SELECT *, unnest(generate_series(greatest(ceil((i - 19) / 10)::BIGINT, 0), least(floor(i / 10)::BIGINT, floor((n - 20) / 10)::BIGINT))) AS win FROM s),
a AS (SELECT user_id, win, count(v) AS n, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max, max(v) - min(v) AS range, median(v) AS median,
             max(CASE WHEN i > win * 10 THEN d END) AS max_change, count(DISTINCT round(v, 2)) AS n_unique FROM x GROUP BY ALL)
SELECT user_id, win AS "window", n, round(mean, 6) AS mean, round(std, 6) AS std, min, max, round(range, 6) AS range, round(median, 6) AS median, round(max_change, 6) AS max_change, n_unique
FROM a WHERE n >= 10""")
def window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.sliding_features(samples(spark, sf_dir), ["user_id"], "ts", "value", 20, 10)
    rounded = ("mean", "std", "range", "median", "max_change")
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query("""
WITH s AS (SELECT user_id, CASE WHEN value >= 20 THEN value END AS v, row_number() OVER w - 1 AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, floor(i / 30)::BIGINT AS win, i, v FROM s),
m AS (SELECT user_id, win, median(v) AS mid FROM g GROUP BY ALL),
d AS (SELECT g.*, abs(v - mid) AS dev, abs(v - lag(v) OVER w) > 50 AS jump FROM g JOIN m USING (user_id, win) WINDOW w AS (PARTITION BY g.user_id, g.win ORDER BY i))
SELECT user_id, win AS "window", round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS min, max(v) AS max, round(regr_slope(v, i), 6) AS slope,
       round(median(dev), 6) AS mad, round(1 - count(v) / count(*), 6) AS missing, count(*) FILTER (jump) AS n_jumps FROM d GROUP BY ALL""")
def trend_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsegrid.operators.timeseries import series

    df = samples(spark, sf_dir).withColumn("v", F.when(F.col("value") >= 20, F.col("value")))
    df = df.withColumn("i", F.row_number().over(series(["user_id"], "ts")) - 1).withColumn("window", F.floor(F.col("i") / 30))
    out = windows.trend_features(df, ["user_id", "window"], "v", "i", 50)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "slope", "mad", "missing")})


@query("""
WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'a' WHEN event_id % 3 = 1 THEN 'b' ELSE 'c' END AS col FROM events),
c AS (SELECT user_id, event_type, col, count(CASE WHEN value >= 100 THEN value END) AS n FROM e GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY n DESC, col) AS r FROM c WHERE n > 0)
SELECT e.event_id, e.col FROM e JOIN b ON e.user_id = b.user_id AND e.event_type = b.event_type AND e.col = b.col WHERE r = 1""")
def fuller_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id") % 3
    df = with_missing(samples(spark, sf_dir)).withColumn("col", F.when(i == 0, "a").when(i == 1, "b").otherwise("c"))
    return windows.fuller_column(df, KEYS, "col", "v").select("event_id", "col")


@query(f"""
WITH q AS (
  SELECT event_id, user_id, event_type, ts, CASE WHEN x = -1401 THEN 'MISSING' WHEN variable IS NULL THEN 'UNREVIEWED'
         WHEN low IS NOT NULL AND high IS NOT NULL AND ((x = 0 AND NOT zero_is_valid) OR x < low OR x > high) THEN 'INVALID_RANGE'
         WHEN fallback THEN 'LOW_QUALITY' ELSE 'VALID' END AS qc, x
  FROM (SELECT *, {_X} AS x FROM events) LEFT JOIN {_SPEC} ON event_type = variable
),
c AS (SELECT *, CASE WHEN qc NOT IN ('MISSING', 'INVALID_RANGE') THEN x END AS clean FROM q),
m AS (SELECT *, CASE WHEN count(clean) OVER w = 5 THEN median(clean) OVER w END AS med FROM c WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
d AS (SELECT *, abs(clean - med) AS dev FROM m),
z AS (SELECT *, CASE WHEN count(dev) OVER w = 5 THEN median(dev) OVER w END AS mad FROM d WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
f AS (SELECT event_type, CASE WHEN coalesce(dev / (1.4826 * nullif(mad, 0)) > 5, false) THEN 'SPIKE' ELSE qc END AS qc, clean FROM z)
SELECT event_type, qc, count(*) AS n, round(avg(clean), 6) AS mean FROM f GROUP BY ALL""")
def flagged_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity first, then spikes among what is left; every sample keeps a label."""
    from pulsegrid.operators import timeseries as ts

    rows = quality.validity(coded(spark, sf_dir), "x", "event_type", quality.dictionary(spark, SPEC), [-1401.0, 9999.0])
    rows = ts.spikes(rows, KEYS, "ts", "clean", 5)
    rows = rows.withColumn("qc", F.when(F.col("spike"), "SPIKE").otherwise(F.col("qc")))
    return rows.groupBy("event_type", "qc").agg(F.count("*").alias("n"), F.round(F.avg("clean"), 6).alias("mean"))
