"""Queries on where files belong, units, labels and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators import learning, placement, rules, stats
from pulsegrid.operators import timeseries as ts
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples
from pulsegrid.session import table

c = F.col
#: Paths of the classifier's query, by page: project, folders, name.
_SHAPES = (
    "P/Database/RawData/{n}/infinity/case_{n}.csv", "P/Database/{n}/ECG monitor/2026-01-05/x.bin", "P/Patient 7/BIS/trend.spa", "P/Documents/ethics/{n}.pdf", "P/infinity/loose.csv", "P/Patient 9/filtered/infinity_{n}.csv",
    "P/Patient 3/BIS/infinity_2026-02-03.csv", "P/x/unknown.dat",
)
_RULES = [placement.NameRule(r"^infinity", "Infinity", "EXTRACTED"), placement.NameRule(r"\.spa$", "BIS", "RAW"), placement.NameRule(r"^case_", "Infinity", "RAW", "low"), placement.NameRule(r"master", None, "METADATA", "medium")]
_WANT = (  # source, evidence, stage, confidence, subject, session_date, canonical path, notes
    ("Infinity", "both", "RAW", "low", "#", None, "P/Database/RawData/#/Infinity/case_@.csv", ""),
    ("Monitor", "folder", "RAW", "low", "#", "2026-01-05", "P/Database/RawData/#/Monitor/2026-01-05/x.bin", ""),
    ("BIS", "both", "RAW", "high", "7", None, "P/Database/RawData/7/BIS/trend.spa", ""),
    (None, "none", "IGNORE", "none", "#", None, None, ""),
    ("Infinity", "folder", "RAW", "low", None, None, "P/Database/RawData/_unassigned/Infinity/loose.csv", "subject not found in path"),
    ("Infinity", "filename", "DERIVED", "high", "9", None, "P/Database/AnalyzedData/9/Infinity/filtered/infinity_@.csv", ""),
    ("Infinity", "conflict", "EXTRACTED", "high", "3", "2026-02-03", "P/Database/ExtractedData/3/Infinity/infinity_2026-02-03.csv", "folder says BIS, name says Infinity"),
    (None, "none", "UNKNOWN", "none", None, None, None, "subject not found in path"),
)


def _want(i: int) -> str:
    def one(v):
        if v is None:
            return "NULL"
        parts = v.replace("@", "#").split("#")
        return " || n || ".join(f"'{p}'" for p in parts) if len(parts) > 1 else f"'{v}'"

    return "CASE k " + " ".join(f"WHEN {k} THEN {one(w[i])}" for k, w in enumerate(_WANT)) + " END"


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.get(F.array(*map(F.lit, _SHAPES)), (c("page_id") % len(_SHAPES)).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", F.replace(shape, F.lit("{n}"), c("page_id").cast("string")).alias("path"))


@query(f"""
WITH p AS (SELECT page_id, page_id % {len(_SHAPES)} AS k, page_id::VARCHAR AS n FROM pages)
SELECT page_id, {_want(0)} AS source, {_want(1)} AS evidence, {_want(2)} AS stage, {_want(3)} AS confidence, {_want(4)} AS subject, {_want(5)} AS session_date, {_want(6)} AS canonical_path, {_want(7)} AS notes FROM p""")
def placed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source, subject, stage and place of files; the SQL states what each shape of path must give."""
    aliases = {"infinity": "Infinity", "ecg monitor": "Monitor", "bis": "BIS"}
    out = placement.classify(_paths(spark, sf_dir), "path", _RULES, aliases, r"^(?i:patient |p)?0*([0-9]{1,6})$", ignored=("documents",), derived=("filtered",))
    return out.select("page_id", "source", "evidence", "stage", "confidence", "subject", "session_date", "canonical_path", "notes")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'layout not confirmed' WHEN o_orderpriority LIKE '1%' THEN 'subject not found' WHEN o_orderpriority LIKE '2%' AND o_orderstatus <> 'F' THEN 'source unknown' WHEN o_orderpriority LIKE '3%' THEN 'no rule' END AS reason FROM orders""")
def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = c("o_orderpriority"), c("o_orderstatus")
    status = F.when(s == "P", "review").otherwise("active")
    stage = F.when(p.startswith("3"), "UNKNOWN").when(s == "F", "DERIVED").otherwise("RAW")
    reason = placement.review_reason(status, F.when(~p.startswith("1"), "7"), F.when(~p.startswith("2"), "BIS"), stage)
    return table(spark, sf_dir, "orders").select("o_orderkey", reason.alias("reason"))


@query("""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM pages)
SELECT page_id, CASE WHEN NOT (starts_with(path, 'blog.') AND starts_with(path, 'blog.therst.example.net/') OR starts_with(path, 'm.tionsh.example.net/')) THEN 'out' WHEN list_contains(string_split(lower(path), '/'), 'de') THEN 'excluded' ELSE 'in' END AS scope,
       CASE WHEN string_split(path, '/')[2] IN ('fr') THEN 'exclude' WHEN string_split(path, '/')[2] IN ('en', 'de') THEN 'include' ELSE 'unknown' END AS decision FROM p""")
def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^https?://", "")
    decision = placement.folder_decision(F.get(F.split(path, "/"), F.lit(1)), ["en", "de"], ["fr"])
    return table(spark, sf_dir, "pages").select("page_id", placement.in_scope(path, ["blog.therst.example.net", "m.tionsh.example.net/"], ["DE"]).alias("scope"), decision.alias("decision"))


@query("""
SELECT DISTINCT upper(p_brand) || '/' || p_type AS path, p_brand || '/' || p_type AS wanted FROM part WHERE upper(p_brand) <> p_brand""")
def case_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    have = part.select(F.concat_ws("/", F.upper("p_brand"), "p_type").alias("path"))
    return placement.case_renames(have, "path", part.select(F.concat_ws("/", "p_brand", "p_type").alias("w")), "w")


@query("""
WITH f AS (SELECT DISTINCT c_nationkey AS study, CASE WHEN c_custkey % 4 = 0 THEN 'Amendment ' || (c_custkey % 7) ELSE 'amendment of ' || c_mktsegment END AS folder FROM customer),
s AS (SELECT *, CASE WHEN folder LIKE 'Amendment %' THEN replace(folder, 'Amendment ', '')::INT END AS said FROM f),
m AS (SELECT *, coalesce(max(said) OVER (PARTITION BY study), 0) AS top, row_number() OVER (PARTITION BY study, said IS NULL ORDER BY folder) AS place FROM s)
SELECT study, folder, coalesce(said, top + place) AS "number" FROM m""")
def amendment_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    folder = F.when(k % 4 == 0, F.concat(F.lit("Amendment "), k % 7)).otherwise(F.concat(F.lit("amendment of "), "c_mktsegment"))
    return placement.numbered(table(spark, sf_dir, "customer").select(c("c_nationkey").alias("study"), folder.alias("folder")), "study", "folder", r"amendment ([0-9])$")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN ['P/' || o_custkey, 'P/Database/RawData/' || o_custkey] ELSE ['P/other/' || o_custkey] END::VARCHAR AS places FROM orders""")
def earlier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = F.concat(F.when(c("o_orderkey") % 2 == 0, "Database/RawData/").otherwise("other/"), c("o_custkey"))
    out = placement.earlier_places(F.lit("P"), rel)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("["), F.array_join(out, ", "), F.lit("]")).alias("places"))


@query("""
WITH s AS (SELECT DISTINCT regexp_replace(url, '^https?://', '') AS path FROM pages WHERE url LIKE '%/de/%'),
p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS path FROM pages)
SELECT page_id, CASE WHEN s.path IS NOT NULL THEN 'S' ELSE coalesce(nullif(regexp_extract(p.path, '/en/([0-9]+)', 1), ''), nullif(regexp_extract(p.path, '([0-9]+)', 1), '')) END AS subject FROM p LEFT JOIN s USING (path)""")
def subjects_of_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    blobs = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^https?://", "").alias("path"))
    state = blobs.where("path like '%/de/%'").select("path", F.lit("S").alias("subject"))
    return placement.with_subjects(blobs, "path", state, "/en/([0-9]+)").select("page_id", "subject")


@query("SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS seconds FROM events")
def seconds_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).select("event_id", placement.seconds_of_day(c("ts")).cast("long").alias("seconds"))


@query("""
WITH f AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'P/Master list.xlsx' WHEN 1 THEN 'P/Database/Metadata/demographics.csv' WHEN 2 THEN 'P/a/b/patients.ods' WHEN 3 THEN 'P/a/notes.txt' ELSE 'P/participant.pdf' END AS path FROM part)
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'root' WHEN 1 THEN 'metadata' WHEN 2 THEN 'elsewhere' END AS kind FROM f""")
def demographic_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["P/Master list.xlsx", "P/Database/Metadata/demographics.csv", "P/a/b/patients.ods", "P/a/notes.txt", "P/participant.pdf"]
    path = F.get(F.array(*map(F.lit, names)), (c("p_partkey") % 5).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", placement.workbook_kind(path).alias("kind"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Ethics/protocol.pdf' WHEN p_partkey % 3 = 1 THEN 'Archive/x.doc' END AS target FROM part""")
def document_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.get(F.array(F.lit("S/CER/Protocol/protocol.pdf"), F.lit("S/Old versions/ethics/x.doc"), F.lit("S/misc/y.txt")), (c("p_partkey") % 3).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", placement.document_place(path, [("old version", "Archive"), ("cer|ethic", "Ethics")]).alias("target"))


@query("""
SELECT string_split(regexp_replace(url, '^https?://', ''), '/')[1] AS project, count(DISTINCT string_split(regexp_replace(url, '^https?://', ''), '/')[2]) AS n_patients, count(*) AS n_files FROM pages GROUP BY ALL""")
def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split(F.regexp_replace("url", "^https?://", ""), "/")
    rows = table(spark, sf_dir, "pages").select(F.get(parts, F.lit(0)).alias("project"), F.get(parts, F.lit(1)).alias("patient"))
    return rows.groupBy("project").agg(F.countDistinct("patient").alias("n_patients"), F.count("*").alias("n_files"))


@query("""
WITH r AS (SELECT c_nationkey AS project, c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey)
SELECT project, count(DISTINCT c_custkey) AS n_patients, count(o_orderkey) AS n_recordings, count(DISTINCT c_custkey) FILTER (o_orderkey IS NOT NULL) AS n_with_data, round(sum(o_totalprice), 2) AS total FROM r GROUP BY project""")
def project_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), c("o_custkey") == c("c_custkey"), "left")
    return r.groupBy(c("c_nationkey").alias("project")).agg(
        F.countDistinct("c_custkey").alias("n_patients"), F.count("o_orderkey").alias("n_recordings"), F.countDistinct(F.when(c("o_orderkey").isNotNull(), c("c_custkey"))).alias("n_with_data"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("""
WITH q AS (SELECT user_id, CASE WHEN value > 200 THEN 'SATURATED' WHEN value < 10 THEN 'FLAT' ELSE 'VALID' END AS qc, value FROM events)
SELECT user_id, qc, count(*) AS n, round(avg(value), 8) AS mean, round(stddev_pop(value), 8) AS sd, min(value) AS low, max(value) AS high FROM q GROUP BY ALL""")
def segment_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the samples under each label, with the population's deviation."""
    v = c("value")
    rows = samples(spark, sf_dir).withColumn("qc", F.when(v > 200, "SATURATED").when(v < 10, "FLAT").otherwise("VALID"))
    return rows.groupBy("user_id", "qc").agg(F.count("*").alias("n"), F.round(F.avg(v), 8).alias("mean"), F.round(F.stddev_pop(v), 8).alias("sd"), F.min(v).alias("low"), F.max(v).alias("high"))


@query("""
WITH w AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 30 AS w, event_id, event_type, value FROM events),
m AS (SELECT user_id, w, avg(value) FILTER (event_type = 'click') AS mve, avg(value) FILTER (event_type = 'view') AS vt, avg(value) FILTER (event_type = 'purchase') AS rr, avg(value) FILTER (event_type = 'error') AS pip, avg(value) FILTER (event_type = 'signup') AS peep FROM w GROUP BY ALL)
SELECT user_id, w, round(abs(mve - vt * rr / 1000) / nullif(abs(vt * rr / 1000), 0), 6) AS volume_error, coalesce(pip < peep, false) AS order_broken FROM m""")
def ventilation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of the minute volume and broken pressure order per window of 30 samples."""
    w = F.floor((F.row_number().over(ts.series(["user_id"], "event_id")) - 1) / 30)
    names = {"click": "mve", "view": "vt", "purchase": "rr", "error": "pip", "signup": "peep"}
    rows = samples(spark, sf_dir).withColumn("w", w)
    m = rows.groupBy("user_id", "w").agg(*[F.avg(F.when(c("event_type") == k, c("value"))).alias(v) for k, v in names.items()])
    out = learning.ventilation(m)
    return out.select("user_id", "w", F.round("volume_error", 6).alias("volume_error"), "order_broken")


@query("""
WITH b AS (SELECT user_id, floor(epoch_us(ts) / 86400000000)::BIGINT AS day, avg(value) FILTER (event_type = 'click') AS hr, avg(value) FILTER (event_type = 'view') AS spo2 FROM events GROUP BY ALL)
SELECT user_id, count(*) FILTER (hr IS NOT NULL AND spo2 IS NOT NULL) AS n, round(corr(hr, spo2), 6) AS r FROM b GROUP BY user_id HAVING count(*) FILTER (hr IS NOT NULL AND spo2 IS NOT NULL) > 2""")
def rate_saturation_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.floor(ts.micros(c("ts")) / 86_400_000_000)
    b = samples(spark, sf_dir).groupBy("user_id", day.alias("day")).agg(*[F.avg(F.when(c("event_type") == k, c("value"))).alias(v) for k, v in (("click", "hr"), ("view", "spo2"))])
    out = b.groupBy("user_id").agg(F.count_if(c("hr").isNotNull() & c("spo2").isNotNull()).alias("n"), F.round(stats.correlation(c("hr"), c("spo2")), 6).alias("r"))
    return out.where("n > 2")


@query("""
WITH l AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'UNKNOWN' WHEN 'error' THEN 'ARTIFACT' ELSE 'VALID' END AS label FROM events)
SELECT user_id, count(*) AS n_labels, count(*) FILTER (label = 'ARTIFACT') AS n_artifact, count(*) >= 50 AND count(*) > 40 AS retrain FROM l WHERE label <> 'UNKNOWN' GROUP BY user_id""")
def retraining_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human labels but for unknown ones; fifty new ones, and more than last time, start a training."""
    label = F.when(c("event_type") == "signup", "UNKNOWN").when(c("event_type") == "error", "ARTIFACT").otherwise("VALID")
    rows = samples(spark, sf_dir).withColumn("label", label).withColumn("before", F.lit(40))
    return learning.retraining(rows, "user_id", "label", "before")


@query("""
WITH s AS (SELECT user_id, event_type, CASE WHEN value >= 20 THEN value END AS v FROM events)
SELECT user_id, event_type, round(avg(v), 8) AS mean, round(stddev_samp(v), 8) AS sd, min(v) AS low, max(v) AS high, round(median(v), 8) AS median, round(1 - count(v) / count(*), 6) AS missing FROM s GROUP BY ALL HAVING count(v) >= 10""")
def patient_features_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each patient's variables with ten values at least."""
    df = samples(spark, sf_dir).withColumn("v", F.when(c("value") >= 20, c("value")))
    out = learning.unit_features(df, ["user_id", "event_type"], "v")
    return out.withColumns({**{x: F.round(x, 8) for x in ("mean", "sd", "median")}, "missing": F.round("missing", 6)})


@query()
def patient_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients by the statistics of two variables: sizes of the clusters."""
    df = learning.unit_features(samples(spark, sf_dir), ["user_id", "event_type"], "value", least=1)
    wide = df.groupBy("user_id").pivot("event_type", ["click", "view"]).agg(F.first("mean").alias("mean"), F.first("sd").alias("sd"), F.first("low").alias("low"), F.first("high").alias("high"))
    names = [x for x in wide.columns if x != "user_id"]
    return learning.clusters(wide.na.drop(), names, k=3).groupBy("cluster").agg(F.count("*").alias("n"))


@query("""
WITH d AS (SELECT source, text FROM documents), t AS (SELECT source, count(*) AS n, count(*) FILTER (regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS n_hits FROM d GROUP BY source)
SELECT source, n, n_hits, n_hits > 0 AS needs_review FROM t""")
def identifier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file (a source): rows that hold an e-mail address, and whether it needs a look."""
    out = stats.identifier_scan(table(spark, sf_dir, "documents"), ["source"], "text", {"email": stats.IDENTIFIERS["email"]})
    return out.select("source", "n", c("n_email").alias("n_hits"), (c("n_email") > 0).alias("needs_review"))


@query("""
WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY sha256(event_id::VARCHAR), event_id) AS k FROM events),
g AS (SELECT *, row_number() OVER (ORDER BY k, sha256(event_id::VARCHAR), event_id) AS place FROM r WHERE k <= 7) SELECT user_id, event_id FROM g WHERE place <= 500""")
def capped_sample_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most seven samples per file and 500 in all, the first of every file before the second of any."""
    h = F.sha2(c("event_id").cast("string"), 256)
    rows = samples(spark, sf_dir).withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy(h, "event_id"))).where("k <= 7")
    return rows.orderBy("k", h, "event_id").limit(500).select("user_id", "event_id")


@query("""
WITH q AS (SELECT event_type, CASE WHEN value > 250 THEN 'x' END AS raw, value FROM events)
SELECT event_type, CASE WHEN count(TRY_CAST(coalesce(raw, value::VARCHAR) AS DOUBLE)) / count(*) > 0.5 THEN 'number' ELSE 'event' END AS kind, count(*) AS n FROM q GROUP BY event_type""")
def kinds_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns over half of whose texts are numbers are numbers, the others events."""
    text = F.when(c("value") > 250, "x").otherwise(c("value").cast("string"))
    out = samples(spark, sf_dir).groupBy("event_type").agg(F.count(text.try_cast("double")).alias("k"), F.count("*").alias("n"))
    return out.select("event_type", F.when(c("k") / c("n") > 0.5, "number").otherwise("event").alias("kind"), "n")
