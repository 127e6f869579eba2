"""Further queries: places in names, fingerprints, books, skipped recordings, issues, labels, joins of verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C
from pulsegrid.operators import quality, validation
from pulsegrid.operators import timeseries as ts
from pulsegrid.plans.files import scratch
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples
from pulsegrid.session import table
from pulsegrid.sources import readers, sinks

c = F.col


@query("""
WITH p AS (SELECT page_id, lower(string_split(url, '/')[-1]) AS name FROM pages)
SELECT page_id, CASE WHEN regexp_matches(name, '^1') THEN 'theatre' WHEN regexp_matches(name, 'utm') THEN 'recovery' END AS location FROM p""")
def located_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.located(table(spark, sf_dir, "pages"), "url", [("^1", "theatre"), ("utm", "recovery")]).select("page_id", "location")


@query("SELECT * FROM (VALUES ('org.apache.spark.sql.parquet.row.metadata'), ('org.apache.spark.version')) t(\"key\")")
def read_footer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "pairs")
    table(spark, sf_dir, "nation").write.parquet(path)
    return readers.footer_pairs(spark, path).where("key like 'org.apache.spark.%'").select("key").distinct()


@query("""
WITH l AS (SELECT user_id, sum(length(event_type)) + count(*) - 1 AS n FROM events GROUP BY user_id)
SELECT user_id, CASE user_id % 4 WHEN 1 THEN 2 * n + 2 WHEN 3 THEN n + 2 ELSE n END::BIGINT AS length, CASE user_id % 4 WHEN 3 THEN 'gzip' ELSE 'unknown' END AS kind,
       CASE user_id % 4 WHEN 2 THEN 'zeros' WHEN 3 THEN 'gzip' ELSE 'text' END AS class, CASE user_id % 4 WHEN 1 THEN 'utf-16-be' ELSE '' END AS bom FROM l""")
def read_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each user's kinds of events: as text, as text of two-byte characters, as zeros, and behind another kind's
    first bytes."""
    path, c = scratch(spark, "prints"), F.col
    text = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.collect_list("event_type"), "\n").alias("t"))
    kind = c("user_id") % 4
    zeros, gzip = F.unhex(F.repeat(F.lit("00"), F.length("t"))), F.concat(F.unhex(F.lit("1F8B")), F.encode("t", "UTF-8"))
    content = F.when(kind == 1, F.encode("t", "UTF-16")).when(kind == 2, zeros).when(kind == 3, gzip).otherwise(F.encode("t", "UTF-8"))
    sinks.raw_files(text.select(F.concat(c("user_id").cast("string"), F.lit(".bin")).alias("name"), content.alias("content")), path)
    found = readers.fingerprints(spark, path)
    return found.select(F.regexp_extract("path", r"([0-9]+)\.bin$", 1).cast("long").alias("user_id"), "length", "kind", "class", "bom")


@query("SELECT n_name, n_regionkey FROM nation")
def statistics_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sheets, one of them read back."""
    path = scratch(spark, "book")
    sinks.statistics_book({"nations": table(spark, sf_dir, "nation").select("n_name", "n_regionkey"), "regions": table(spark, sf_dir, "region")}, path)
    return spark.read.csv(f"{path}/nations", header=True, schema="n_name string, n_regionkey int")


@query("""
SELECT user_id, count(*) AS n_rows, count(DISTINCT event_type) FILTER (event_type IN ('click', 'view')) AS n_known,
       CASE WHEN count(*) < 60 THEN 'TOO_SHORT' WHEN count(DISTINCT event_type) FILTER (event_type IN ('click', 'view')) < 2 THEN 'TOO_FEW_VARIABLES' END AS skipped FROM events GROUP BY user_id""")
def skipped_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.usable(samples(spark, sf_dir), "user_id", "event_type", ["click", "view"], least_rows=60)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders")
def french_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in French and read again."""
    names = ["Janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]
    d = c("o_orderdate")
    text = F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.get(F.array(*map(F.lit, names)), F.month(d) - 1), F.year(d).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", C.french_date(text).cast("string").alias("day"))


@query("""
WITH r AS (SELECT user_id, event_type, CASE WHEN max(value) > 280 THEN 'FAIL' WHEN max(value) > 240 THEN 'WARNING' ELSE 'PASS' END AS r FROM events GROUP BY ALL),
b AS (SELECT user_id, event_type || ':' || r AS i, row_number() OVER (PARTITION BY user_id ORDER BY event_type || ':' || r) AS k FROM r WHERE r <> 'PASS'),
f AS (SELECT user_id, count(*) AS n, array_to_string(list(i ORDER BY i) FILTER (k <= 2), ',') AS l FROM b GROUP BY user_id)
SELECT u.user_id, coalesce(n, 0) AS n_issues, coalesce(l, '') AS issues FROM (SELECT DISTINCT user_id FROM r) u LEFT JOIN f USING (user_id)""")
def issues_of_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = samples(spark, sf_dir).groupBy("user_id", "event_type").agg(F.max("value").alias("m"))
    r = r.withColumn("r", F.when(c("m") > 280, "FAIL").when(c("m") > 240, "WARNING").otherwise("PASS"))
    return validation.issues(r, "user_id", "event_type", "r", most=2).withColumn("issues", F.array_join("issues", ","))


@query("""
WITH s AS (SELECT user_id, event_id, ts, value AS raw, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN value + 25 ELSE value + 5 END AS clean FROM events),
l AS (SELECT *, clean IS NULL OR abs(raw - clean) > 20 AS artifact FROM s),
c AS (SELECT *, CASE WHEN lag(artifact) OVER w = artifact THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM c)
SELECT user_id, min(event_id) AS "first", max(event_id) AS "last", count(*) AS n FROM r WHERE artifact GROUP BY user_id, run""")
def artifact_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of artifacts by what cleaning took away or changed."""
    e = c("event_type")
    df = samples(spark, sf_dir).withColumn("clean", F.when(e == "click", c("value") + 25).when(e != "error", c("value") + 5))
    runs = ts.runs_of(validation.artifact_labels(df, "value", "clean"), ["user_id"], "event_id", c("artifact"))
    return runs.where("flag").select("user_id", "first", "last", "n")


@query("""
WITH w AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS w, event_type, value FROM events),
m AS (SELECT user_id, w, avg(value) FILTER (event_type = 'click') AS a, avg(value) FILTER (event_type = 'view') AS b, avg(value) FILTER (event_type = 'purchase') AS d, avg(value) FILTER (event_type = 'error') AS e FROM w GROUP BY ALL)
SELECT user_id, w, coalesce(abs(a - b * d / 1000) / nullif(abs(b * d / 1000), 0) <= 0.3, true) AS minute_volume_ok, coalesce(a >= b, true) AND coalesce(b >= e, true) AS pressure_order_ok,
       coalesce(abs(a / 100 * (b / 100) - 1) <= 0.5, true) AS compliance_ok, coalesce(abs(d - (a / 2 + b / 2)) / nullif(abs(a / 2 + b / 2), 0) <= 0.25, true) AS rate_ok FROM m
WHERE a IS NOT NULL AND b IS NOT NULL AND d IS NOT NULL AND e IS NOT NULL""")
def consistency_of_four(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four cross-checks over windows of 20 samples, with the variables' means in the places of the ventilator's."""
    w = F.floor((F.row_number().over(ts.series(["user_id"], "event_id")) - 1) / 20)
    names = {"click": "a", "view": "b", "purchase": "d", "error": "e"}
    m = samples(spark, sf_dir).withColumn("w", w).groupBy("user_id", "w").agg(*[F.avg(F.when(c("event_type") == k, c("value"))).alias(v) for k, v in names.items()]).na.drop()
    m = m.select(
        "user_id", "w", c("a").alias("mve"), c("b").alias("vt"), c("d").alias("rr"), c("a").alias("pip"), c("b").alias("pplat"), c("e").alias("peep"),
        (c("a") / 100).alias("elastance"), (c("b") / 100).alias("compliance"), (c("a") / 2).alias("rr_mand"), (c("b") / 2).alias("rr_spon"),
    )
    return quality.consistency(m).select("user_id", "w", "minute_volume_ok", "pressure_order_ok", "compliance_ok", "rate_ok")


@query("""
WITH v AS (SELECT user_id, CASE WHEN max(value) > 290 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM events GROUP BY user_id), q AS (SELECT user_id, count(*) FILTER (value > 200) AS n_bad FROM events GROUP BY user_id)
SELECT c_custkey, c_mktsegment, verdict, n_bad FROM customer JOIN v ON c_custkey = v.user_id JOIN q ON c_custkey = q.user_id""")
def verdicts_of_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and quality of the recordings that the catalogue has."""
    g = samples(spark, sf_dir).groupBy(c("user_id").alias("c_custkey"))
    v = g.agg(F.when(F.max("value") > 290, "FAIL").otherwise("PASS").alias("verdict"))
    q = g.agg(F.count_if(c("value") > 200).alias("n_bad"))
    return table(spark, sf_dir, "customer").join(v, "c_custkey").join(q, "c_custkey").select("c_custkey", "c_mktsegment", "verdict", "n_bad")


@query("""
WITH k AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS i FROM events)
SELECT user_id, count(*) FILTER (i <= 50) AS n, count(DISTINCT event_type) AS n_files FROM k GROUP BY user_id""")
def measured_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look at the first 50 rows of every variable's file."""
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    rows = samples(spark, sf_dir).withColumn("i", F.row_number().over(w))
    return rows.groupBy("user_id").agg(F.count_if(c("i") <= 50).alias("n"), F.countDistinct("event_type").alias("n_files"))
