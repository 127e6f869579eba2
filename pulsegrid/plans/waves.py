"""Queries on filters, waveform features and learning; SQL expresses few of them, tests hold the others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators import filters, learning, peaks, windows
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples
from pulsegrid.session import table


def _pass_sql(name: str, source: str, sections: list[list[float]]) -> str:
    """A recursive table of one pass over ``source`` (user_id, t, x): user_id, t, y."""
    first, later, level, at = [], [], "x", "x"
    for k, (b0, b1, b2, _, a1, a2) in enumerate(sections):
        steady = f"({level}) * {(b0 + b1 + b2) / (1 + a1 + a2)!r}"
        first += [f"{steady} - ({level}) * {b0!r} AS p{k}", f"({level}) * {b2!r} - {steady} * {a2!r} AS q{k}"]
        out = f"({at}) * {b0!r} + p{k}"
        later += [f"({at}) * {b1!r} - ({out}) * {a1!r} + q{k} AS p{k}", f"({at}) * {b2!r} - ({out}) * {a2!r} AS q{k}"]
        level, at = steady, out
    return (
        f"{name} AS (SELECT user_id, -1::BIGINT AS t, {', '.join(first)}, NULL::DOUBLE AS y FROM {source} WHERE t = 0 UNION ALL "
        f"SELECT e.user_id, e.t, {', '.join(later)}, {at} AS y FROM {name} f JOIN {source} e ON e.user_id = f.user_id AND e.t = f.t + 1)"
    )


def _filter_sql(order: int, cutoff: float, fs: float, kind: str, least: int) -> str:
    """The recursion in SQL, forward and backward over odd extensions, for series of ``least`` samples or more."""
    sections = filters.butter_sections(order, cutoff, fs, kind).tolist()
    pad = 3 * (2 * len(sections) + 1)
    return f"""
WITH RECURSIVE s AS (SELECT user_id, event_id, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
p AS (SELECT user_id, n, least({pad}, n - 1) AS pad, max(v) FILTER (i = 0) AS head, max(v) FILTER (i = n - 1) AS tail FROM s WHERE n >= {least} GROUP BY ALL),
j AS (SELECT s.*, pad, head, tail FROM s JOIN p USING (user_id, n)),
e AS (SELECT user_id, pad + i AS t, v AS x FROM j UNION ALL SELECT user_id, pad - i, 2 * head - v FROM j WHERE i BETWEEN 1 AND pad
      UNION ALL SELECT user_id, pad + 2 * (n - 1) - i, 2 * tail - v FROM j WHERE n - 1 - i BETWEEN 1 AND pad),
{_pass_sql("f", "e", sections)},
r AS (SELECT f.user_id, n + 2 * pad - 1 - t AS t, y AS x FROM f JOIN p USING (user_id) WHERE t >= 0),
{_pass_sql("b", "r", sections)}
SELECT s.user_id, event_id, v AS value, round(coalesce(b.y, v), 6) AS filtered
FROM s LEFT JOIN p USING (user_id, n) LEFT JOIN b ON b.user_id = s.user_id AND b.t = n + pad - 1 - i"""


@query(_filter_sql(4, 0.1, 1.0, "low", 13))
def zero_phase_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-pass of each user's values as if sampled once a second."""
    out = filters.filtered(samples(spark, sf_dir), ["user_id"], "event_id", "value", 1.0, "low", 0.1)
    return out.withColumn("filtered", F.round("filtered", 6))


@query(_filter_sql(4, 0.1, 1.0, "low", 13))
def zero_phase_filter_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in blocks shorter than the series: their states are scanned."""
    out = filters.filtered(samples(spark, sf_dir), ["user_id"], "event_id", "value", 1.0, "low", 0.1, size=16)
    return out.withColumn("filtered", F.round("filtered", 6))


@query(_filter_sql(3, 0.02, 1.0, "high", 10))
def high_pass_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a slow drift leaves: the filter remembers longer than the series."""
    out = filters.filtered(samples(spark, sf_dir), ["user_id"], "event_id", "value", 1.0, "high", 0.02, 3)
    return out.withColumn("filtered", F.round("filtered", 6))


@query("""
WITH x AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 40 AS w, event_id, value AS v FROM events),
s AS (SELECT *, row_number() OVER o - 1 AS i, v - lag(v) OVER o AS d FROM x WINDOW o AS (PARTITION BY user_id, w ORDER BY event_id)),
a AS (SELECT user_id, w, count(*) AS n, max(v) AS high, min(v) AS low, max(d) FILTER (d > 0) AS max_rise, avg(d) FILTER (d > 0) AS mean_rise, sum(v) - (arg_min(v, i) + arg_max(v, i)) / 2 AS total FROM s GROUP BY ALL),
t AS (SELECT user_id, w, (lag(i) OVER o + i - 1) // 2 AS pos, v - d AS h, i FROM s WHERE d <> 0 WINDOW o AS (PARTITION BY user_id, w ORDER BY i) QUALIFY lag(d) OVER o > 0 AND d < 0),
h AS (SELECT t.user_id, t.w, t.pos, s.v AS h FROM t JOIN s ON s.user_id = t.user_id AND s.w = t.w AND s.i = t.pos),
p AS (SELECT user_id, w, unnest(list_reduce(list_sort(list({'h': h, 'a': pos}), 'DESC'), lambda kept, x: CASE WHEN len(list_filter(kept, lambda y: abs(y.a - x.a) < 10)) = 0 THEN list_append(kept, x) ELSE kept END, []::STRUCT(h DOUBLE, a BIGINT)[])).a AS pos FROM h GROUP BY user_id, w),
e AS (SELECT p.user_id, p.w, p.pos, h.h, coalesce(max(s.i) FILTER (s.i < p.pos AND s.v > h.h), -1) AS l, coalesce(min(s.i) FILTER (s.i > p.pos AND s.v > h.h), 1000) AS r
      FROM p JOIN h USING (user_id, w, pos) JOIN s USING (user_id, w) GROUP BY ALL),
m AS (SELECT e.user_id, e.w, e.pos, e.h - greatest(min(s.v) FILTER (s.i <= e.pos AND s.i > e.l), min(s.v) FILTER (s.i >= e.pos AND s.i < e.r)) AS prominence FROM e JOIN s USING (user_id, w) GROUP BY e.user_id, e.w, e.pos, e.h),
b AS (SELECT m.user_id, m.w, m.pos, m.pos - lag(m.pos) OVER o AS gap, lag(m.pos) OVER o AS was FROM m JOIN a USING (user_id, w) WHERE prominence >= CASE WHEN high > low THEN 0.1 * (high - low) ELSE 1.0 END WINDOW o AS (PARTITION BY m.user_id, m.w ORDER BY m.pos)),
c AS (SELECT *, (SELECT count(*) FROM h WHERE h.user_id = b.user_id AND h.w = b.w AND h.pos > b.was AND h.pos < b.pos) AS between_ FROM b),
g AS (SELECT user_id, w, count(*) AS n_beats, avg(gap) AS gap, stddev_pop(gap) AS sd, count(*) FILTER (gap > 10 AND between_ > 0) AS notches FROM c GROUP BY ALL)
SELECT user_id, w AS "window", round(CASE WHEN n >= 20 THEN high ELSE 0 END, 7) AS highest, round(CASE WHEN n >= 20 THEN low ELSE 0 END, 7) AS lowest, round(CASE WHEN n >= 20 THEN high - low ELSE 0 END, 7) AS pulse,
       round(CASE WHEN n >= 20 THEN coalesce(max_rise, 0) ELSE 0 END, 7) AS max_rise, round(CASE WHEN n >= 20 THEN coalesce(mean_rise, 0) ELSE 0 END, 7) AS mean_rise, CASE WHEN n >= 20 THEN coalesce(n_beats, 0)::DOUBLE ELSE 0 END AS n_beats,
       round(CASE WHEN n >= 20 AND n_beats >= 2 THEN gap ELSE 0 END, 7) AS interval, round(CASE WHEN n >= 20 AND n_beats >= 2 THEN sd / (gap + 1e-6) ELSE 0 END, 7) AS interval_spread,
       round(CASE WHEN n >= 20 AND n_beats >= 2 THEN notches / (n_beats - 1) ELSE 0 END, 7) AS notch_share, round(CASE WHEN n >= 20 THEN high / (low + 1e-6) ELSE 0 END, 7) AS high_to_low, round(CASE WHEN n >= 20 THEN total - low * (n - 1) ELSE 0 END, 7) AS area
FROM a LEFT JOIN g USING (user_id, w)""")
def morphology_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the pulse in windows of 40 samples, as of a pressure wave."""
    rows = samples(spark, sf_dir).withColumn("window", F.floor((F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1) / 40))
    out = peaks.pulse_features(rows, ["user_id", "window"], "event_id", "value")
    return out.withColumns({c: F.round(c, 7) for c in out.columns if c not in ("user_id", "window")})


@query()
def ecg_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels per second of each user's values as if sampled four times a second."""
    return filters.ecg_labels(samples(spark, sf_dir), ["user_id"], "event_id", "value", 4.0)


@query()
def window_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose next one has a high mean, by a random forest on window features; scores on the test part."""
    rows = windows.sliding_features(samples(spark, sf_dir), ["user_id"], "ts", "value", 20, 20)
    later = F.lead("mean").over(Window.partitionBy("user_id").orderBy("window"))
    rows = rows.withColumn("label", (later > F.col("mean")).cast("int")).where("label is not null")
    parts = learning.split(rows, "user_id")
    names = ["mean", "std", "min", "range", "median", "max_change"]
    model = learning.forest(parts.where("part = 'train'"), names, "label", trees=100, depth=12)
    return learning.scores(model.transform(parts.where("part = 'test'")))


@query()
def embedding_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = learning.clusters(table(spark, sf_dir, "embeddings"), "embedding", k=5)
    return out.groupBy("cluster").agg(F.count("*").alias("n"), F.countDistinct("label").alias("n_labels"))


@query()
def silhouette_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.silhouettes(table(spark, sf_dir, "embeddings"), "embedding", (3, 5, 7, 10))


@query("""
WITH f AS (SELECT user_id, event_id % 2 AS y, (value > 100)::INT AS p FROM events),
c AS (SELECT count(*) FILTER (y = 1 AND p = 1)::DOUBLE AS tp, count(*) FILTER (y = 0 AND p = 1)::DOUBLE AS fp, count(*) FILTER (y = 1 AND p = 0)::DOUBLE AS fn, count(*) FILTER (y = 0 AND p = 0)::DOUBLE AS tn FROM f)
SELECT (tp + fp + fn + tn)::BIGINT AS n, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc,
       CASE WHEN 2 * tp / (2 * tp + fp + fn) < 0.8 THEN 'UNRELIABLE' ELSE 'RELIABLE' END AS status FROM c""")
def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).select((F.col("event_id") % 2).alias("label"), (F.col("value") > 100).cast("int").alias("prediction"))
    return learning.scores(rows).withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1", "mcc")})
