"""Queries on family rules, exams and censuses of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import census, exams, rules
from pulsegrid.operators import timeseries as ts
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import KEYS, samples
from pulsegrid.session import table

c = F.col
#: Families that stand for the event types.
FAMILY = {"click": "HR", "view": "SPO2", "purchase": "ETCO2", "error": "NBP_SYS", "signup": "ECG"}
_FAMILY = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FAMILY.items()) + " END"
_HARD = {f: (lo, hi) for f, lo, hi, _, _ in rules.BOUNDS}
_USUAL = {f: (lo, hi) for f, _, _, lo, hi in rules.BOUNDS}
_pick = lambda table, i: "CASE family " + " ".join(f"WHEN '{f}' THEN {table[f][i]}" for f in FAMILY.values() if f in table) + " END"


def with_family(df: DataFrame) -> DataFrame:
    return df.withColumn("family", F.create_map(*[F.lit(x) for kv in FAMILY.items() for x in kv])[c("event_type")])


@query(f"""
WITH f AS (SELECT *, {_FAMILY} AS family FROM events)
SELECT family, count(*) AS n, count(*) FILTER (value < {_pick(_HARD, 0)} OR value > {_pick(_HARD, 1)}) AS n_artifact FROM f GROUP BY family""")
def hard_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_family(samples(spark, sf_dir)).withColumn("artifact", rules.hard_bounds(c("value"), c("family")))
    return df.groupBy("family").agg(F.count("*").alias("n"), F.count_if("artifact").alias("n_artifact"))


@query(f"""
WITH f AS (SELECT *, {_FAMILY} AS family, CASE WHEN value >= 20 THEN value END AS v FROM events),
a AS (SELECT user_id, family, count(v) AS n, min(v) AS low, max(v) AS high, avg((v < {_pick(_USUAL, 0)} OR v > {_pick(_USUAL, 1)})::INT) * 100 AS p FROM f GROUP BY ALL)
SELECT user_id, family, n, low, high, round(p, 6) AS outside_pct, CASE WHEN n = 0 THEN 'EMPTY' WHEN p IS NULL THEN 'NO_NORM' WHEN p < 5 THEN 'OK' ELSE 'WARN' END AS status FROM a""")
def norm_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_family(samples(spark, sf_dir)).withColumn("v", F.when(c("value") >= 20, c("value")))
    return rules.norm_check(df, ["user_id"], "v", "family").withColumn("outside_pct", F.round("outside_pct", 6))


@query(f"""
SELECT p_type, count(*) AS n, count(*) FILTER (regexp_matches(lower(p_name), '{"|".join(rules.DRUG_FRAGMENTS)}')) AS n_drug FROM part GROUP BY p_type""")
def drug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.count_if(rules.is_drug(c("p_name"))).alias("n_drug"))


_EXT = ["csv", "PDF", "jpg", "xlsx", "vital", "txt"]
_FILE = "(CASE WHEN page_id % 7 = 0 THEN 'P/photos/' ELSE 'P/data/' END || CASE WHEN page_id % 11 = 0 THEN '.DS_Store' ELSE 'f' || page_id || '.' || (['" + "','".join(_EXT) + "'])[(page_id % 6 + 1)::INT] END)"
_listed = lambda xs: ", ".join(f"'{x}'" for x in xs)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = c("page_id")
    name = F.when(i % 11 == 0, ".DS_Store").otherwise(F.concat(F.lit("f"), i, F.lit("."), F.get(F.array(*map(F.lit, _EXT)), (i % 6).cast("int"))))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.when(i % 7 == 0, "P/photos/").otherwise("P/data/"), name).alias("path"), F.length("html").alias("size"))


@query(f"""
WITH f AS (SELECT page_id, {_FILE} AS path FROM pages), n AS (SELECT *, lower(string_split(path, '/')[-1]) AS name, lower(regexp_extract(string_split(path, '/')[-1], '.\\.([A-Za-z0-9]+)$', 1)) AS ext FROM f)
SELECT page_id, CASE WHEN name IN ({_listed(rules.JUNK_NAMES)}) THEN 'junk' WHEN list_contains(string_split(lower(path), '/'), 'photos') THEN 'excluded'
  WHEN ext IN ({_listed(rules.PHOTO_EXTENSIONS)}) THEN 'photo' WHEN ext IN ({_listed(rules.DOCUMENT_EXTENSIONS)}) THEN 'document' ELSE 'data' END AS kind FROM n""")
def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).select("page_id", rules.file_kind(c("path")).alias("kind"))


@query(f"""
WITH f AS (SELECT {_FILE} AS path, length(html) AS size FROM pages), n AS (SELECT *, lower(regexp_extract(string_split(path, '/')[-1], '.\\.([A-Za-z0-9]+)$', 1)) AS ext FROM f)
SELECT CASE WHEN ext = '' THEN '(none)' ELSE ext END AS ext, count(*) AS n_files, sum(size)::BIGINT AS n_bytes FROM n GROUP BY ALL""")
def file_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.formats(_files(spark, sf_dir), [], "path", "size")


@query("""
WITH t AS (SELECT p_partkey, string_split_regex(lower(p_name), '[^a-z0-9]+') AS k FROM part)
SELECT p_partkey, CASE WHEN list_has_all(k, ['part', '1']) THEN 'first' WHEN list_has_all(k, ['part', '2']) THEN 'second' WHEN list_has_all(k, ['part']) THEN 'other' END AS signal FROM t""")
def signals_by_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [("first", ["part", "1"]), ("second", ["part", "2"]), ("other", ["part"])]
    return table(spark, sf_dir, "part").select("p_partkey", rules.signal_by_tokens(c("p_name"), wanted).alias("signal"))


@query(f"""
WITH f AS (SELECT *, {_FAMILY} AS family, CASE WHEN value <> 0 THEN value END AS x FROM events),
m AS (SELECT *, median(x) OVER w AS mid FROM f WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)),
d AS (SELECT *, abs(x - mid) AS dev FROM m),
s AS (SELECT *, median(dev) OVER w AS mad FROM d WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)),
r AS (SELECT *, CASE WHEN x IS NULL THEN 'missing' WHEN x < {_pick(_HARD, 0)} OR x > {_pick(_HARD, 1)} THEN 'hard_bounds'
        WHEN family NOT IN ('ECG', 'PLETH') AND dev > 2.5 * 1.4826 * greatest(mad, 1e-9) THEN 'spike' END AS reason FROM s),
h AS (SELECT *, coalesce(reason IN ('hard_bounds', 'spike'), false) AND x IS NOT NULL AS hit FROM r),
p AS (SELECT *, sum(hit::INT) OVER w / nullif(count(x) OVER w, 0) AS share FROM h WINDOW w AS (PARTITION BY user_id, event_type)),
q AS (SELECT *, CASE WHEN x IS NULL THEN 'MISSING' WHEN NOT hit THEN 'VALID' WHEN share >= 0.99 THEN 'KEPT_WOULD_WIPE' WHEN share > 0.5 THEN 'KEPT_OVERFILTER_REVIEW' ELSE 'ARTIFACT' END AS qc FROM p)
SELECT event_type, qc, coalesce(reason, '') AS reason, count(*) AS n, count(CASE WHEN qc <> 'ARTIFACT' THEN x END) AS n_kept FROM q GROUP BY ALL""")
def flag_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_family(samples(spark, sf_dir)).withColumn("at", F.struct("ts", "event_id"))
    out = rules.flag_chain(df, KEYS, "at", "value", "family", [0.0], threshold=2.5)
    return out.groupBy("event_type", "qc", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.count("kept").alias("n_kept"))


@query("""
WITH s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
k AS (SELECT s.*, w FROM s, unnest(range(greatest((floor((i - 20) / 10) + 1)::BIGINT, 0), i // 10 + 1)) AS t(w)),
f AS (SELECT user_id, w FROM k GROUP BY ALL HAVING count(*) = 20 AND avg(value) > 60)
SELECT user_id, event_id, EXISTS (SELECT 1 FROM k JOIN f USING (user_id, w) WHERE k.user_id = s.user_id AND k.i = s.i) AS flagged FROM s""")
def window_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 samples, every 10, whose mean is high, brought back to their samples."""
    from pulsegrid.operators import windows

    df = samples(spark, sf_dir)
    scored = windows.sliding_features(df, ["user_id"], "event_id", "value", 20, 10).select("user_id", "window", (c("mean") > 60).alias("flagged"))
    return rules.windows_to_samples(df, ["user_id"], "event_id", scored, 20, 10, "flagged").select("user_id", "event_id", "flagged")


@query("""
WITH s AS (SELECT user_id, CASE WHEN value >= 40 THEN value END AS v, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 30 AS "window" FROM events)
SELECT user_id, "window", count(*) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd, round(1 - count(v) / count(*), 6) AS missing, 1 - count(v) / count(*) > 0.2 OR coalesce(stddev_pop(v) < 1e-6, true) AS suspect FROM s GROUP BY ALL""")
def fixed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.when(c("value") >= 40, c("value")))
    out = rules.fixed_windows(df, ["user_id"], "event_id", "v")
    return out.withColumns({x: F.round(x, 6) for x in ("mean", "sd", "missing")})


@query("""
WITH s AS (SELECT event_id, user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 30 AS w FROM events)
SELECT event_id, round((value - avg(value) OVER p) / (stddev_pop(value) OVER p + 1e-6), 5) AS z FROM s WINDOW p AS (PARTITION BY user_id, w)""")
def normalised_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("w", F.floor((F.row_number().over(ts.series(["user_id"], "event_id")) - 1) / 30))
    return rules.normalised(rows, ["user_id", "w"], "value").select("event_id", F.round("z", 5).alias("z"))


@query("""
WITH s AS (SELECT user_id, event_id, CASE WHEN value >= 30 THEN floor(value / 10) END AS v, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 40 AS w FROM events),
n AS (SELECT user_id, w, count(*) AS n_all, count(v) AS n FROM s GROUP BY ALL HAVING count(v) >= 10),
a AS (SELECT s.*, row_number() OVER o AS i, abs(v - lag(v) OVER o) AS step, abs(v - 2 * lag(v) OVER o + lag(v, 2) OVER o) AS bend,
        max(v) OVER g - min(v) OVER g AS span
      FROM s WHERE v IS NOT NULL WINDOW o AS (PARTITION BY user_id, w ORDER BY event_id), g AS (PARTITION BY user_id, w)),
k AS (SELECT user_id, w, i, v, lag(v) OVER o AS was FROM a WINDOW o AS (PARTITION BY user_id, w ORDER BY i)),
t AS (SELECT user_id, w, (lag(i) OVER o + i - 1) // 2 AS pos, was AS h FROM k WHERE v <> was WINDOW o AS (PARTITION BY user_id, w ORDER BY i) QUALIFY lag(v > was) OVER o AND v < was),
p AS (SELECT user_id, w, unnest(list_reduce(list_sort(list({'h': h, 'a': pos}), 'DESC'), lambda kept, x: CASE WHEN len(list_filter(kept, lambda y: abs(y.a - x.a) < 3)) = 0 THEN list_append(kept, x) ELSE kept END, []::STRUCT(h DOUBLE, a BIGINT)[])).a AS pos FROM t GROUP BY user_id, w),
q AS (SELECT user_id, w, count(*) AS n_peaks, avg(gap) AS gm, stddev_pop(gap) AS gs FROM (SELECT *, pos - lag(pos) OVER (PARTITION BY user_id, w ORDER BY pos) AS gap FROM p) GROUP BY ALL),
b AS (SELECT *, step < greatest(1e-9, span * 1e-4) AS flat,
        median(step) OVER (PARTITION BY user_id, w) AS mid FROM a),
r AS (SELECT *, sum(CASE WHEN flat THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, w ORDER BY event_id) AS run FROM b),
l AS (SELECT user_id, w, max(k) AS longest FROM (SELECT user_id, w, run, count(*) AS k FROM r WHERE flat GROUP BY ALL) GROUP BY ALL),
f AS (SELECT user_id, w, avg(v) AS mean, stddev_pop(v) AS sd, median(v) AS median, min(v) AS low, max(v) AS high, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr, count(DISTINCT v) AS d, max(step) AS max_step, count(*) FILTER (step > 5 * mid + 1e-9) AS n_spikes, avg(bend) AS bend, regr_slope(v, i) AS slope,
        avg((v BETWEEN 5 AND 15)::INT) AS in_norm, avg((v = 0)::INT) AS zero, avg((v < 0)::INT) AS negative FROM r GROUP BY ALL)
SELECT user_id, w, round(1 - n / n_all, 5) AS missing, round(mean, 5) AS mean, round(sd, 5) AS sd, median, low AS "min", high AS "max", high - low AS "range", round(iqr, 5) AS iqr, coalesce(n_peaks, 0) AS n_peaks,
       round(CASE WHEN n_peaks >= 3 THEN greatest(0, least(1, 1 - gs / (gm + 1e-9))) ELSE 0 END, 5) AS peak_regularity, round(coalesce(longest, 0) / n, 5) AS flat, round(d / n, 5) AS "unique", max_step, n_spikes,
       round(coalesce(bend, 0) / (high - low + 1e-9), 5) AS smoothness, round(slope * 100 / (sd + 1e-9), 4) AS trend, round(in_norm, 5) AS in_norm, round(zero, 5) AS zero, round(negative, 5) AS negative
FROM n JOIN f USING (user_id, w) LEFT JOIN l USING (user_id, w) LEFT JOIN q USING (user_id, w)""")
def window_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("w", F.floor((F.row_number().over(ts.series(["user_id"], "event_id")) - 1) / 40))
    rows = rows.withColumn("v", F.when(c("value") >= 30, F.floor(c("value") / 10)).cast("double"))
    out = rules.window_shape(rows.select("user_id", "w", "event_id", "v"), ["user_id", "w"], "event_id", "v", 5, 15)
    rounded = ("missing", "mean", "sd", "iqr", "peak_regularity", "flat", "unique", "smoothness", "in_norm", "zero", "negative")
    return out.withColumns({**{x: F.round(x, 5) for x in rounded}, "trend": F.round("trend", 4)})


@query(f"""
WITH f AS (SELECT {_FAMILY} AS family, value FROM events WHERE value BETWEEN 10 AND 250)
SELECT family, count(*) AS n_clean, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM f GROUP BY family""")
def learned_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.learned_normals(with_family(samples(spark, sf_dir)), "family", "value", c("value").between(10, 250))
    return out.withColumns({x: F.round(x, 6) for x in ("p01", "p50", "p99")})


@query("""
WITH u AS (SELECT user_id, count(*) AS n, count(*) / 3.0 AS minutes, max(value) > 200 AS complete, min(value) < 1 AS review FROM events GROUP BY user_id),
s AS (SELECT complete AS a, coalesce(minutes >= 20, false) AS b, NOT review AS d FROM u)
SELECT 0 AS step, 'all' AS condition, count(*) AS n FROM s UNION ALL SELECT 1, 'complete', count(*) FILTER (a) FROM s UNION ALL
SELECT 2, 'long_enough', count(*) FILTER (a AND b) FROM s UNION ALL SELECT 3, 'no_review', count(*) FILTER (a AND b AND d) FROM s""")
def cohort_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = samples(spark, sf_dir).groupBy("user_id").agg((F.count("*") / 3.0).alias("minutes"), (F.max("value") > 200).alias("complete"), (F.min("value") < 1).alias("review"))
    return rules.cohort(units, "minutes", 20, "complete", "review")[1]


@query("SELECT event_id, (k)::VARCHAR AS kept FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'type' ELSE 'type,value' END AS k FROM events)")
def without_identifying(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.map_filter(F.create_map(F.lit("type"), F.lit("x"), F.lit("Patient_Name"), F.lit("y"), F.lit("value"), F.lit("z")), lambda k, v: (c("event_type") != "error") | (k != "value"))
    out = rules.without_identifying(samples(spark, sf_dir).withColumn("meta", m), "meta", ["patient_name", "birth_date"])
    return out.select("event_id", F.array_join(F.array_sort(F.map_keys("meta")), ",").alias("kept"))


# Exams: a user's events are an exam, event types its signals, customers of the same number their footers.

def _exam_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("sensor", F.when(c("event_type") == "click", "Draeger").otherwise("other"))
    df = df.withColumn("value", F.when(c("value") > 190, exams.SENTINEL).otherwise(c("value")))
    return exams.without_sentinels(df, "sensor", "value")


@query("""
SELECT event_type, count(*) FILTER (event_type = 'click' AND value > 190) AS n_sentinel, count(*) AS n FROM events GROUP BY event_type""")
def sentinel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exams.sentinel_counts(_exam_samples(spark, sf_dir), ["event_type"])


_V = "CASE WHEN event_type = 'click' AND value > 190 THEN NULL WHEN value > 190 THEN -32768 ELSE value END"


@query(f"""
SELECT user_id, event_type, count(*) AS n, count(*) FILTER (({_V}) IS NULL) AS n_null, round(avg({_V}), 8) AS mean, round(stddev_samp({_V}), 8) AS sd, min({_V}) AS "min", max({_V}) AS "max",
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration_s FROM events GROUP BY ALL""")
def exam_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exams.exam_features(_exam_samples(spark, sf_dir), KEYS, "ts", "value")
    return out.withColumns({"mean": F.round("mean", 8), "sd": F.round("sd", 8), "duration_s": F.round("duration_s", 6)})


@query(f"""
WITH f AS (SELECT user_id, event_type, count(*) AS n, count(*) FILTER (({_V}) IS NULL) AS n_null, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS d FROM events WHERE NOT (event_type = 'signup' AND user_id > 3) GROUP BY ALL),
g AS (SELECT event_type, count(DISTINCT user_id) AS k, sum(d) / 3600 AS hours, sum(n_null) / sum(n) AS null_share FROM f GROUP BY event_type)
SELECT event_type, CASE WHEN k >= 5 THEN k END AS n_exams, CASE WHEN k >= 5 THEN round(hours, 5) END AS hours, CASE WHEN k >= 5 THEN round(null_share, 6) END AS null_share FROM g""")
def state_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One signal that only few exams have is suppressed."""
    f = exams.exam_features(_exam_samples(spark, sf_dir).where("not (event_type = 'signup' and user_id > 3)"), KEYS, "ts", "value")
    return exams.state_feed(f, "event_type", "user_id").withColumns({"hours": F.round("hours", 5), "null_share": F.round("null_share", 6)})


_COLUMNS = ["local_time", "value", "sensor"]


@query("""
WITH x AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS odd, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, event_type = 'click' AND value > 190 AS sentinel FROM events),
b AS (SELECT *, ts < lag(ts) OVER (PARTITION BY user_id ORDER BY CASE WHEN user_id % 5 = 0 THEN odd ELSE i END) AS back FROM x),
a AS (SELECT user_id, count(*) AS n, count(*) FILTER (back) AS n_back, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS d, count(*) FILTER (sentinel) AS k FROM b GROUP BY user_id),
f AS (SELECT c_custkey AS user_id, c_nationkey AS nation, c_acctbal AS bal FROM customer),
j AS (SELECT f.*, coalesce(n, 0) AS n, n_back, d, coalesce(k, 0) AS k FROM f LEFT JOIN a USING (user_id))
SELECT user_id, 'identity_present' AS "check", CASE WHEN nation <> 7 THEN 'PASS' ELSE 'FAIL' END AS result, '' AS detail FROM j UNION ALL
SELECT user_id, 'footer_complete', CASE WHEN bal >= 0 THEN 'PASS' ELSE 'WARNING' END, CASE WHEN bal >= 0 THEN '' ELSE 'exam_stop_time,signal_type' END FROM j UNION ALL
SELECT user_id, CASE WHEN n = 0 THEN 'has_rows' ELSE 'time_sorted' END, CASE WHEN n > 0 AND n_back = 0 THEN 'PASS' ELSE 'FAIL' END, '' FROM j UNION ALL
SELECT user_id, 'duration_matches_footer', CASE WHEN abs(d - 2500000) <= 50000 THEN 'PASS' ELSE 'WARNING' END, '' FROM j WHERE d IS NOT NULL UNION ALL
SELECT user_id, 'schema_drift', CASE WHEN nation > 3 THEN 'PASS' ELSE 'WARNING' END, CASE WHEN nation > 3 THEN '' ELSE 'extra' END FROM j UNION ALL
SELECT user_id, 'sentinels_nulled', 'PASS', k::VARCHAR FROM j""")
def exam_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    footers = table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("user_id"), F.when(c("c_nationkey") != 7, "e").alias("exam_guid"), F.lit("s").alias("session_guid"), F.lit("a").alias("exam_start_time"),
        F.when(c("c_acctbal") >= 0, "b").alias("exam_stop_time"), F.lit("1").alias("ett_version"), F.lit("1").alias("sampling_frequency"), F.when(c("c_acctbal") >= 0, "n").alias("signal_type"),
        F.lit(2_500_000.0).alias("recording_duration"), F.when(c("c_nationkey") > 3, F.array(*map(F.lit, _COLUMNS))).otherwise(F.array(*map(F.lit, [*_COLUMNS, "extra"]))).alias("columns"),
    )
    rows = _exam_samples(spark, sf_dir)
    raw = samples(spark, sf_dir).select("event_id", c("value").alias("raw"))
    rows = rows.join(raw, "event_id").withColumn("at", F.when(c("user_id") % 5 == 0, c("raw")).otherwise(0.0))
    rows = rows.withColumn("place", F.struct("at", "event_id"))
    return exams.exam_checks(rows, footers, "user_id", "place", "ts", _COLUMNS, 50_000)


@query("""
WITH m AS (SELECT DISTINCT md5(text) AS h FROM documents WHERE lang = 'en'), i AS (SELECT doc_id, md5(text) AS h FROM documents)
SELECT h AS hash, min(doc_id) AS doc_id FROM i WHERE h NOT IN (SELECT h FROM m) GROUP BY h""")
def new_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.md5(c("text").cast("binary")).alias("hash"))
    return exams.new_by_hash(docs.select("doc_id", "hash"), docs.where("lang = 'en'"), "hash", "doc_id").select("hash", "doc_id")


@query("""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM pages)
SELECT page_id, CASE WHEN path = 'blog.therst.example.net/en' OR starts_with(path, 'blog.therst.example.net/en/') THEN 'C' WHEN starts_with(path, 'blog.therst.example.net/') THEN 'B' END AS project FROM p""")
def projects_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^https?://", "")
    return table(spark, sf_dir, "pages").select("page_id", exams.project_by_prefix(path, [("blog.therst.example.net", "B"), ("/blog.therst.example.net/en/", "C")]).alias("project"))


# Censuses: orders are files of customers, line items their columns.

#: Columns of files that one task joins and counts.
COLUMNS_OF_TASK = 500_000


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """project (nation), unit (customer), file (order), name (a column: the item's tax and flag).

    Dealt by file in as many tasks as the rows need, which the joins and counts by file keep: so a task's memory doesn't grow
    with the table.
    """
    li = table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // COLUMNS_OF_TASK))
    li = li.select(c("l_orderkey").alias("file"), F.concat(c("l_returnflag"), c("l_linestatus"), F.lit("_"), c("l_quantity").cast("int")).alias("name")).repartition(tasks, "file")
    o = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("file"), c("o_custkey").alias("unit"))
    k = table(spark, sf_dir, "customer").select(c("c_custkey").alias("unit"), c("c_nationkey").alias("project"))
    return li.join(o.join(k, "unit"), "file")


_X = """x AS (SELECT c_nationkey AS project, o_custkey AS unit, l_orderkey AS file, l_returnflag || l_linestatus || '_' || l_quantity::INT AS name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


@query(f"""
WITH {_X}, d AS (SELECT DISTINCT project, name FROM x), u AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY name) AS k FROM d WHERE name NOT LIKE 'A%')
SELECT project, count(*) AS n_unmapped, array_to_string(list(name ORDER BY name) FILTER (k <= 8), ',') AS examples FROM u GROUP BY project""")
def unmapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _columns(spark, sf_dir).select("project", "name").distinct().withColumn("variable", F.when(c("name").startswith("A"), "known").otherwise(" "))
    return census.unmapped(names, ["project"], "name", "variable").withColumn("examples", F.array_join("examples", ","))


@query(f"""
WITH {_X}, p AS (SELECT project, name, file, count(*) AS n FROM x GROUP BY ALL HAVING count(*) > 1)
SELECT project, name, count(*) AS n_files, max(n) AS most_in_one FROM p GROUP BY ALL ORDER BY n_files DESC, project, name LIMIT 15""")
def repeated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.most_repeated(_columns(spark, sf_dir), ["project"], "name", "file")


@query(f"""
WITH {_X}, p AS (SELECT project, name FROM x GROUP BY ALL HAVING count(DISTINCT unit) = 1) SELECT project, count(*) AS n_single FROM p GROUP BY project""")
def columns_of_one_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.in_one_unit(_columns(spark, sf_dir), ["project"], "name", "unit")


@query(f"""
WITH {_X}, t AS (SELECT project, count(DISTINCT file) AS n_files FROM x GROUP BY project)
SELECT project, name, count(DISTINCT file) AS seen_in, n_files FROM x JOIN t USING (project) GROUP BY ALL HAVING count(DISTINCT file) < n_files""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.schema_drift(_columns(spark, sf_dir), ["project"], "name", "file")


@query("""
WITH t AS (SELECT o_orderstatus AS project, o_orderpriority AS device, o_orderkey AS file, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS turn FROM orders),
p AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY turn, device, file) AS place FROM t) SELECT project, device, file, place FROM p WHERE place <= 20""")
def sampled_in_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 20 files of each project, devices in turn."""
    files = table(spark, sf_dir, "orders").select(c("o_orderstatus").alias("project"), c("o_orderpriority").alias("device"), c("o_orderkey").alias("file"))
    return census.round_robin(files, ["project"], "device", "file", 20)


@query("""
WITH i AS (SELECT DISTINCT c_nationkey AS project, c_custkey AS unit FROM customer), o AS (SELECT c_nationkey AS project, o_custkey AS unit, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
p AS (SELECT project, unit, CASE WHEN unit % 9 = 0 THEN -unit ELSE unit END AS source_unit, CASE WHEN unit % 13 = 0 THEN 0 ELSE n END AS n_rows FROM o), d AS (SELECT DISTINCT project, unit FROM o WHERE n > 8),
b AS (SELECT p.project, count(*) FILTER (k.unit IS NULL OR n_rows = 0) AS n_broken FROM p LEFT JOIN (SELECT DISTINCT unit FROM i) k ON p.source_unit = k.unit GROUP BY ALL),
r AS (SELECT i.project, count(*) AS n_ingested, count(p.unit) AS n_processed, count(*) FILTER (p.unit IS NULL) AS n_missing, 0 AS n_extra, count(d.unit) AS n_drawn FROM i LEFT JOIN p ON i.project = p.project AND i.unit = p.unit LEFT JOIN d ON p.project = d.project AND p.unit = d.unit GROUP BY ALL)
SELECT project, n_ingested, n_processed, n_missing, n_extra, n_drawn, coalesce(n_broken, 0) AS n_broken, round(n_processed / n_ingested, 6) AS preserved, round(coalesce(n_drawn / nullif(n_processed, 0), 0), 6) AS drawn, n_missing = 0 AND coalesce(n_broken, 0) = 0 AS ok FROM r LEFT JOIN b USING (project)""")
def continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = table(spark, sf_dir, "customer").select(c("c_nationkey").alias("project"), c("c_custkey").alias("unit"))
    o = table(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("unit")).agg(F.count("*").alias("n")).join(k, "unit")
    p = o.select("project", "unit", F.when(c("unit") % 9 == 0, -c("unit")).otherwise(c("unit")).alias("source_unit"), F.when(c("unit") % 13 == 0, 0).otherwise(c("n")).alias("n_rows"))
    return census.continuity(k, p, o.where("n > 8"), "project", "unit").withColumns({x: F.round(x, 6) for x in ("preserved", "drawn")})


_STATUS = """s AS (SELECT user_id, count(*) AS n, count(*) FILTER (value > 190) AS n_high, max(value) AS top FROM events GROUP BY user_id),
p AS (SELECT user_id, 'rows' AS source, 'high' AS severity, n::VARCHAR AS detail FROM s WHERE n < 60 UNION ALL SELECT user_id, 'range', 'medium', n_high::VARCHAR FROM s WHERE n_high > 2 UNION ALL SELECT user_id, 'top', 'low', 'top' FROM s WHERE top < 300)"""


def _problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(c("value") > 190).alias("n_high"), F.max("value").alias("top"))
    found = [("rows", c("n") < 60, "high", c("n")), ("range", c("n_high") > 2, "medium", c("n_high")), ("top", c("top") < 300, "low", F.lit("top"))]
    return census.problems(s, found).select("user_id", "source", "severity", "detail")


@query(f"WITH {_STATUS} SELECT * FROM p")
def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _problems(spark, sf_dir)


@query(f"""
WITH {_STATUS}, n AS (SELECT user_id, count(*) FILTER (severity = 'high') AS n_high, count(*) FILTER (severity = 'medium') AS n_medium, count(*) FILTER (severity = 'low') AS n_low FROM p GROUP BY user_id)
SELECT *, CASE WHEN n_high > 0 THEN 'high' WHEN n_medium > 0 THEN 'medium' WHEN n_low > 0 THEN 'low' END AS worst, n_high > 0 OR n_medium >= 3 AS attention FROM n""")
def worst_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census.worst_severity(_problems(spark, sf_dir), ["user_id"])


@query("""
WITH k AS (SELECT p_brand, regexp_matches(p_name, '1') AS hit FROM part)
SELECT p_brand, count(*) FILTER (hit) AS n_identifier, CASE WHEN count(*) FILTER (hit) > 0 THEN 'identifier columns in standardised files: review before release' END AS finding FROM k GROUP BY p_brand""")
def linkage(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "part").select("p_brand", F.when(c("p_name").rlike("1"), "identifier").otherwise("signal").alias("kind"))
    return census.linkage(kinds, ["p_brand"], "kind")


@query(f"""
WITH l AS (SELECT page_id, page_id % 6 AS k FROM pages)
SELECT page_id, CASE k WHEN 1 THEN 'a/b/c' WHEN 2 THEN 'x/y' WHEN 5 THEN 'q|r/s/t' ELSE '' END AS columns, CASE k WHEN 2 THEN 2 END AS "offset", CASE k WHEN 0 THEN 'empty_file' WHEN 3 THEN 'blank_file' WHEN 4 THEN 'content_unparseable' ELSE '' END AS reason FROM l""")
def recovered_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("page_id") % 6
    text = F.when(k == 1, "a;b;c\n1;2;3").when(k == 2, "\n\nx,y\n1,2").when(k == 3, " \n ").when(k == 4, " \nwords only").otherwise("q|r;s;t\n1")
    lines = F.when(k == 0, F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    return table(spark, sf_dir, "pages").select("page_id", census.header_at(lines, 0).alias("h")).select("page_id", F.array_join("h.columns", "/").alias("columns"), "h.offset", "h.reason")


@query("""
SELECT event_type, key, kind, count(*) AS n FROM (
  SELECT event_type, 'k' AS key, 'number' AS kind FROM events UNION ALL
  SELECT event_type, 'list', 'array' FROM events UNION ALL SELECT event_type, 'name', 'string' FROM events UNION ALL SELECT event_type, 'ok', 'boolean' FROM events) GROUP BY ALL""")
def json_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = table(spark, sf_dir, "events").select("event_type", F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(', "list": [1, 2], "name": "x", "ok": true}')).alias("text"))
    return census.json_inventory(props, ["event_type"], "text")


@query("""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part) SELECT p_brand, p_partkey, p_retailprice, place FROM p WHERE place <= 5""")
def top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dearest parts of each brand."""
    return census.top(table(spark, sf_dir, "part"), ["p_brand"], "p_retailprice", "p_partkey", 5).select("p_brand", "p_partkey", "p_retailprice", "place")


@query("""
WITH a AS (SELECT DISTINCT user_id FROM events WHERE value > 280), b AS (SELECT DISTINCT user_id FROM events WHERE value < 2)
SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS n_both, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS n_left_only, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS n_right_only""")
def set_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir)
    return census.set_comparison(df.where("value > 280"), df.where("value < 2"), ["user_id"])


@query("""
SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, NULL AS supplier FROM customer UNION ALL SELECT s_nationkey, s_acctbal, NULL, s_name FROM supplier""")
def union_of_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(c("c_nationkey").alias("nation"), c("c_acctbal").alias("balance"), c("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(c("s_nationkey").alias("nation"), c("s_acctbal").alias("balance"), c("s_name").alias("supplier"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""
SELECT event_id, round(avg(value) OVER w, 6) AS recent_mean, count(value) OVER w AS recent_n FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW)""")
def within_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ts.within_seconds(samples(spark, sf_dir), ["user_id"], "ts", "value", 86_400)
    return out.select("event_id", F.round("recent_mean", 6).alias("recent_mean"), "recent_n")


@query("""
WITH s AS (SELECT *, epoch_us(date_trunc('second', ts)) / 1e6 AS t, event_id * 5.0 AS e, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events)
SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'file' WHEN 1 THEN CASE WHEN max(e) OVER w > 1000 THEN 'elapsed' ELSE 'reconstructed' END ELSE 'reconstructed' END AS method,
       round(CASE user_id % 3 WHEN 0 THEN t - min(t) OVER w WHEN 1 THEN CASE WHEN max(e) OVER w > 1000 THEN (e - min(e) OVER w) / 1000 ELSE i / 4.0 END ELSE i / 4.0 END, 6) AS t_s
FROM s WINDOW w AS (PARTITION BY user_id)""")
def resolved_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = c("user_id") % 3
    df = samples(spark, sf_dir).withColumn("text", F.when(u == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("n/a")).withColumn("elapsed", F.when(u == 1, (c("event_id") * 5).cast("string")).otherwise("-1"))
    return ts.resolve_time(df, ["user_id"], "event_id", "text", "elapsed", 4.0).select("event_id", "method", F.round("t_s", 6).alias("t_s"))


@query("""
SELECT event_type, CASE WHEN max(x) > 1e11 THEN 'ms' WHEN max(x) > 1e7 THEN 's' ELSE 'index' END AS unit FROM (
  SELECT event_type, CASE event_type WHEN 'click' THEN epoch_us(ts) / 1e3 WHEN 'view' THEN epoch_us(ts) / 1e6 ELSE event_id END AS x FROM events) GROUP BY event_type""")
def time_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ts.micros(c("ts"))
    x = F.when(c("event_type") == "click", m / 1e3).when(c("event_type") == "view", m / 1e6).otherwise(c("event_id"))
    return samples(spark, sf_dir).groupBy("event_type").agg(ts.time_unit(F.max(x)).alias("unit"))
