"""Queries on ordered samples: ``events`` is a set of recordings, one per user, with a variable per event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import timeseries as ts
from pulsegrid.plans.registry import query
from pulsegrid.session import table

KEYS = ["user_id", "event_type"]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, event_type, ts, value of every sample."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")


def with_missing(df: DataFrame) -> DataFrame:
    """Values under 100 as missing: the table has no nulls of its own."""
    return df.withColumn("v", F.when(F.col("value") >= 100, F.col("value")))


_W = "WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)"
_V = "CASE WHEN value >= 100 THEN value END"


@query(f"""
WITH s AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, count(*) AS n_rows, epoch_us(min(ts)) AS t_start, epoch_us(max(ts)) AS t_end,
       round(median(dt), 3) AS median_dt_s, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration_s,
       round(CASE WHEN median(dt) > 0 THEN 1 / median(dt) END, 9) AS fs_hz,
       array_to_string(list_sort(list(DISTINCT event_type)), ',') AS variables
FROM s GROUP BY user_id""")
def recording_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ts.describe_recording(samples(spark, sf_dir), ["user_id"], "ts", "event_type")
    return out.select(
        "user_id",
        "n_rows",
        ts.micros(F.col("t_start")).alias("t_start"),
        ts.micros(F.col("t_end")).alias("t_end"),
        F.round("median_dt_s", 3).alias("median_dt_s"),
        F.round("duration_s", 6).alias("duration_s"),
        F.round("fs_hz", 9).alias("fs_hz"),
        F.array_join("variables", ",").alias("variables"),
    )


@query(f"""
WITH s AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt FROM events {_W})
SELECT user_id, event_type, round(median(dt), 2) AS median_s, round(min(dt), 6) AS min_s, round(max(dt), 6) AS max_s,
       round(1 / median(dt), 9) AS estimated_hz
FROM s WHERE dt > 0 GROUP BY user_id, event_type""")
def sampling_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ts.rates(samples(spark, sf_dir), KEYS, "ts")
    return out.select(*KEYS, F.round("median_s", 2).alias("median_s"), *[F.round(c, 6).alias(c) for c in ("min_s", "max_s")], F.round("estimated_hz", 9).alias("estimated_hz"))


@query("""
WITH s AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
m AS (SELECT user_id, median(dt) AS med FROM s WHERE dt > 0 GROUP BY user_id)
SELECT user_id, round(any_value(med), 3) AS median_s, round(1 / any_value(med), 9) AS nominal_hz,
       round(avg((abs(dt - med) > 0.5 * med)::INT), 6) AS irregular, round(avg((dt <= 0)::INT), 6) AS disorder,
       round(avg((dt > 10 * med)::INT), 6) AS gap_fraction, round(coalesce(sum(CASE WHEN dt > 10 * med THEN dt END), 0), 6) AS gap_s
FROM s JOIN m USING (user_id) WHERE dt IS NOT NULL GROUP BY user_id""")
def time_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ts.time_base(samples(spark, sf_dir), ["user_id"], "event_id", "ts")
    return out.select(
        "user_id",
        F.round("nominal_hz", 9).alias("nominal_hz"),
        F.round("median_s", 3).alias("median_s"),
        *[F.round(c, 6).alias(c) for c in ("irregular", "disorder", "gap_fraction", "gap_s")],
    )


@query("""
WITH s AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, round(max(dt), 6) AS worst_gap_s, count(*) FILTER (dt > 86400) AS n_gaps FROM s GROUP BY user_id""")
def gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ts.gap_check(samples(spark, sf_dir), ["user_id"], "ts", 86400)
    return out.select("user_id", F.round("worst_gap_s", 6).alias("worst_gap_s"), "n_gaps")


@query(f"""
WITH f AS (
  SELECT user_id, ts, event_id, CASE WHEN least(greatest(round(value), 100), 300) IN (100, 300) THEN least(greatest(round(value), 100), 300) END AS v
  FROM events
),
c AS (SELECT *, CASE WHEN v IS NOT DISTINCT FROM lag(v) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c)
SELECT event_id, v IS NOT NULL AND count(*) OVER (PARTITION BY user_id, run) >= 3 AS saturated FROM r""")
def saturation_runs(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    """Values clipped to 100..300, so that the ends are reached again and again."""
    df = samples(spark, sf_dir).withColumn("clipped", F.least(F.greatest(F.round("value"), F.lit(100.0)), F.lit(300.0)))
    return ts.saturation(df, ["user_id"], "ts", "clipped", 3, size=size).select("event_id", "saturated")


@query("""
WITH s AS (SELECT user_id, ts, floor(value / 100) AS v FROM events),
c AS (SELECT *, CASE WHEN lag(v) OVER w = v THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c),
n AS (SELECT user_id, run, count(*) - 1 AS n FROM r GROUP BY ALL)
SELECT user_id, max(n) AS longest FROM n GROUP BY user_id""")
def longest_run(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.floor(F.col("value") / 100))
    return ts.longest_unchanged(df, ["user_id"], "ts", "v", size=size)


@query("""
WITH s AS (SELECT user_id, ts, floor(value / 50) AS v FROM events),
c AS (SELECT *, row_number() OVER w AS pos, coalesce(lag(v) OVER w <> v, true) AS changed FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT user_id, pos - lag(pos) OVER (PARTITION BY user_id ORDER BY pos) AS gap FROM c WHERE changed),
a AS (SELECT user_id, count(*) AS n_changes, median(gap) * 5.0 AS hold_s FROM g GROUP BY user_id)
SELECT user_id, n_changes, hold_s, CASE WHEN n_changes < 3 THEN 'ERROR' WHEN hold_s > 5 THEN 'WARNING' ELSE 'OK' END AS status FROM a""")
def held_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.floor(F.col("value") / 50))
    return ts.held_channel(df, ["user_id"], "ts", "v", 5.0, 5.0)


@query("""
WITH s AS (SELECT event_id, user_id, ts, floor(value / 150) AS v FROM events)
SELECT event_id, coalesce(count(v) OVER w = 4 AND var_samp(v) OVER w < 1e-12, false) AS flatline
FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""")
def flatline(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.floor(F.col("value") / 150).cast("double"))
    return ts.flatline(df, ["user_id"], "ts", "v", 4, size=size).select("event_id", "flatline")


@query("""
WITH m AS (SELECT *, CASE WHEN count(value) OVER w = 11 THEN median(value) OVER w END AS med FROM events
           WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
d AS (SELECT *, abs(value - med) AS dev FROM m),
z AS (SELECT *, CASE WHEN count(dev) OVER w = 11 THEN median(dev) OVER w END AS mad FROM d
      WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING))
SELECT event_id, coalesce(dev / (1.4826 * nullif(mad, 0)) > 3, false) AS spike FROM z""")
def spike_mad(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    return ts.spikes(samples(spark, sf_dir), ["user_id"], "ts", "value", 11, 3.0, size=size).select("event_id", "spike")


@query("""
WITH m AS (SELECT *, median(value) OVER w AS med FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
d AS (SELECT *, abs(value - med) AS dev FROM m),
z AS (SELECT *, median(dev) OVER w AS mad FROM d WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT event_id, round(CASE WHEN dev / (1.4826 * greatest(mad, 1e-9)) > 3 THEN med ELSE value END, 6) AS smoothed FROM z""")
def robust_smooth(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    out = ts.robust_smooth(samples(spark, sf_dir), ["user_id"], "ts", "value", 7, size=size)
    return out.select("event_id", F.round("smoothed", 6).alias("smoothed"))


@query(f"""
WITH s AS (SELECT event_id, user_id, event_type, ts, CASE WHEN value >= 100 THEN round(value / 100) END AS v FROM events),
q AS (
  SELECT event_id, CASE WHEN count(v) OVER b = 3 AND stddev_samp(v) OVER b = 0 THEN 'FLATLINE'
         WHEN abs(v - lag(v) OVER w) / nullif(abs(median(v) OVER (PARTITION BY user_id, event_type)), 0) > 0.5 THEN 'SPIKE' ELSE 'VALID' END AS qc
  FROM s WHERE v IS NOT NULL
  WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts), b AS (PARTITION BY user_id, event_type ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)
SELECT * FROM q UNION ALL SELECT event_id, 'MISSING' FROM s WHERE v IS NULL""")
def ontology_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.when(F.col("value") >= 100, F.round(F.col("value") / 100)))
    return ts.ontology_scalar(df, KEYS, "ts", "v", 3).select("event_id", "qc")


@query(f"""
WITH s AS (SELECT event_id, user_id, event_type, ts, CASE WHEN value >= 20 THEN value - 50 END AS v FROM events),
i AS (SELECT *, v - lag(v) OVER w AS inc FROM s {_W})
SELECT event_id, round(inc, 6) AS increment,
       CASE WHEN v IS NULL THEN 'MISSING' WHEN v < 0 THEN 'INVALID' WHEN inc < 0 THEN 'SUSPICIOUS' ELSE 'VALID' END AS qc FROM i""")
def counter_qc(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.when(F.col("value") >= 20, F.col("value") - 50))
    return ts.counter(df, KEYS, "ts", "v", size=size).select("event_id", F.round("increment", 6).alias("increment"), "qc")


@query(f"SELECT event_id, coalesce(abs(value - lag(value) OVER w) > 60 OR value = 0, false) AS step FROM events {_W}")
def step_rule(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    return ts.step_rule(samples(spark, sf_dir), KEYS, "ts", "value", 60.0, zero_is_artifact=True, size=size).select("event_id", "step")


@query("""
WITH m AS (SELECT event_id, value / nullif(median(value) OVER w, 0) AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING))
SELECT event_id, coalesce(r > 1.8 OR r < 0.55, false) AS off_ratio FROM m""")
def ratio_to_median(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    return ts.ratio_rule(samples(spark, sf_dir), ["user_id"], "ts", "value", 9, size=size).select("event_id", "off_ratio")


@query("""
WITH h AS (SELECT event_id, user_id, ts, coalesce((lag(value, 4) OVER w - value > 40)::INT, 0) AS hit FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT event_id, max(hit) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) = 1 AS in_drop FROM h""")
def temperature_drop(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    return ts.drop_rule(samples(spark, sf_dir), ["user_id"], "ts", "value", 4, 40.0, size=size).select("event_id", "in_drop")


@query("""
SELECT event_id, max((value > 200)::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) = 1 AS near FROM events""")
def artifact_expand(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("artifact", F.col("value") > 200)
    return ts.expand(df, ["user_id"], "ts", "artifact", before=1, after=2, size=size).select("event_id", "near")


@query(f"""
WITH s AS (SELECT event_id, user_id, ts, epoch_us(ts) / 1e6 AS t FROM events WHERE value >= 100),
g AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY user_id ORDER BY ts) > 43200, false)::INT AS new FROM s)
SELECT event_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS segment FROM g""")
def gap_segments(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    return ts.gap_segments(with_missing(samples(spark, sf_dir)), ["user_id"], "ts", "v", 43200, size=size).select("event_id", "segment")


@query(f"""
WITH s AS (SELECT user_id, event_type, ts, {_V} IS NULL AS m FROM events),
c AS (SELECT *, CASE WHEN lag(m) OVER w = m THEN 0 ELSE 1 END AS new FROM s {_W}),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS run FROM c),
n AS (SELECT user_id, event_type, run, m, count(*) AS n FROM r GROUP BY ALL),
a AS (SELECT user_id, event_type, sum(n) AS n, coalesce(sum(n) FILTER (m), 0) AS n_missing, coalesce(max(n) FILTER (m), 0) AS l FROM n GROUP BY ALL),
b AS (SELECT *, n_missing / n AS f, CASE WHEN n = n_missing THEN 0 ELSE l END AS longest FROM a)
SELECT user_id, event_type, n::BIGINT AS n, n_missing::BIGINT AS n_missing, longest::BIGINT AS longest, round(f, 6) AS missing_fraction,
       CASE WHEN n_missing = 0 THEN 'complete' WHEN n_missing = n THEN 'entirely_missing' WHEN f > 0.5 THEN 'high_missing'
            WHEN longest >= 10 THEN 'gappy' ELSE 'sparse_isolated' END AS kind FROM b""")
def missing_runs(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    out = ts.missingness(with_missing(samples(spark, sf_dir)), KEYS, "ts", "v", size=size)
    return out.withColumn("missing_fraction", F.round("missing_fraction", 6))


@query(f"""
WITH s AS (SELECT event_id, user_id, ts, epoch_us(ts) / 1e6 AS t, floor(value / 150) AS v FROM events),
c AS (SELECT *, CASE WHEN lag(v) OVER w = v THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c)
SELECT event_id, new = 0 AND max(t) OVER x - min(t) OVER x >= 100000 AS flat FROM r WINDOW x AS (PARTITION BY user_id, run)""")
def flat_runs(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.floor(F.col("value") / 150))
    return ts.flat_runs(df, ["user_id"], "ts", "v", 100000, size=size).select("event_id", "flat")


@query(f"""
WITH s AS (SELECT event_id, user_id, ts, {_V} IS NULL AS m FROM events),
c AS (SELECT *, CASE WHEN lag(m) OVER w = m THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c)
SELECT event_id, CASE WHEN m AND count(*) OVER (PARTITION BY user_id, run) >= 3 THEN 'GAP' WHEN m THEN 'MISSING' ELSE 'VALID' END AS qc FROM r""")
def missing_gaps(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    return ts.missing_gaps(with_missing(samples(spark, sf_dir)), ["user_id"], "ts", "v", 3, size=size).select("event_id", "qc")


@query(f"""
WITH s AS (SELECT user_id, ts, (value > 150)::INT AS label FROM events),
c AS (SELECT *, CASE WHEN lag(label) OVER w = label THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c),
o AS (SELECT user_id, min(epoch_us(ts)) / 1e6 AS t0 FROM events GROUP BY user_id)
SELECT user_id, round(min(epoch_us(ts)) / 1e6 - any_value(t0), 6) AS start_s, round(max(epoch_us(ts)) / 1e6 - any_value(t0), 6) AS end_s, label, count(*) AS n
FROM r JOIN o USING (user_id) GROUP BY user_id, run, label""")
def label_segments(spark: SparkSession, sf_dir: str, size: int | None = None) -> DataFrame:
    out = ts.label_segments(samples(spark, sf_dir), ["user_id"], "ts", (F.col("value") > 150).cast("int"), size=size)
    return out.select("user_id", F.round("start_s", 6).alias("start_s"), F.round("end_s", 6).alias("end_s"), "label", "n")
