"""Queries on names, paths, histories and feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C
from pulsegrid.operators import dictionary
from pulsegrid.operators.timeseries import micros, seconds
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples
from pulsegrid.session import table

_PATH = "regexp_replace(url, '^https?://', '')"


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "^https?://", "").alias("path"))


@query(f"""
SELECT page_id, CASE WHEN regexp_full_match({_PATH}, '.*[13579]') THEN 'C' WHEN regexp_full_match({_PATH}, '.*/.*[02]') THEN 'A' WHEN regexp_full_match({_PATH}, '.*4') THEN 'B' END AS tier FROM pages""")
def path_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("page_id", dictionary.tier(F.col("path"), ["*[13579]"], ["*/*[02]"], ["*4"]).alias("tier"))


@query(f"""
SELECT page_id, list_filter(string_split({_PATH}, '/'), lambda s: regexp_matches(s, '[0-9]'))[1] AS part, array_to_string(list_transform(string_split({_PATH}, '/'), lambda s: regexp_replace(regexp_replace(s, '[A-Za-z]', 'a', 'g'), '[0-9]', '#', 'g')), '/') AS shape FROM pages""")
def path_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("page_id", dictionary.path_part(F.col("path"), "[0-9]").alias("part"), C.redacted(F.col("path"), ["none"]).alias("shape"))


@query(f"""
SELECT array_to_string(string_split({_PATH}, '/')[1:2], '/') AS pattern, count(*) AS n FROM pages GROUP BY ALL""")
def folder_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.array_join(F.slice(F.split("path", "/"), 1, 2), "/")
    return _paths(spark, sf_dir).groupBy(first.alias("pattern")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pattern")


_ALIASES = {"CLICK_RATE": ["click", "click rate"], "VIEWS": ["view"], "SALE": ["purchase (usd)"]}


@query("""
WITH n AS (SELECT DISTINCT CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type) || ' (mmHg)' WHEN 2 THEN event_type || '.' || (event_id % 3) ELSE '"' || event_type || '"' END AS name FROM events),
a(alias, v) AS (VALUES ('click_rate', 'CLICK_RATE'), ('click', 'CLICK_RATE'), ('click rate', 'CLICK_RATE'), ('views', 'VIEWS'), ('view', 'VIEWS'), ('sale', 'SALE'), ('purchase (usd)', 'SALE')),
k AS (SELECT name, lower(trim(regexp_replace(regexp_replace(name, '["'']', '', 'g'), '\\s+', ' ', 'g'))) AS e FROM n),
b AS (SELECT *, lower(trim(upper(regexp_replace(regexp_replace(e, '(\\.[0-9]+)+$', ''), '\\(.*$', '')))) AS base FROM k),
m AS (SELECT name, x.v AS ve, y.v AS vb, CASE WHEN regexp_matches(base, '^sign') THEN 'account' WHEN regexp_matches(base, 'err') THEN 'fault' END AS kind FROM b LEFT JOIN a x ON b.e = x.alias LEFT JOIN a y ON b.base = y.alias)
SELECT name, coalesce(ve, vb, kind) AS variable, CASE WHEN ve IS NOT NULL THEN 'alias_exact' WHEN vb IS NOT NULL THEN 'alias_base' WHEN kind IS NOT NULL THEN 'classified' ELSE 'review' END AS tier FROM m""")
def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, e = F.col("event_id"), F.col("event_type")
    name = F.when(i % 4 == 0, e).when(i % 4 == 1, F.concat(F.upper(e), F.lit(" (mmHg)"))).when(i % 4 == 2, F.concat(e, F.lit("."), i % 3)).otherwise(F.concat(F.lit('"'), e, F.lit('"')))
    names = samples(spark, sf_dir).select(name.alias("name")).distinct()
    return dictionary.map_columns(names, "name", dictionary.alias_table(spark, _ALIASES), [("^sign", "account"), ("err", "fault")])


@query("""
SELECT doc_id, source || '/d' || doc_id || '.v2-' || left(sha256(text), 8) || '.txt' AS key, left(sha256(source), 8) AS token FROM documents""")
def versioned_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key = F.concat(F.col("source"), F.lit("/d"), F.col("doc_id"), F.lit(".txt"))
    return docs.select("doc_id", C.versioned_key(key, F.sha2("text", 256)).alias("key"), C.short_hash(F.col("source")).alias("token"))


@query("""
WITH m AS (SELECT user_id, event_type, max(value) - min(value) AS x, count(*) AS n FROM events GROUP BY ALL),
a AS (SELECT user_id % 10 AS project, event_type, list_sort(list(x)) AS xs, sum(n) AS n FROM m GROUP BY ALL)
SELECT project, event_type, round(xs[len(xs) // 2 + 1], 6) AS upper_median, n::BIGINT AS n, round(n * 1.5 / 200 / 3600, 9) AS hours FROM a""")
def archive_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from sampled rows, and the upper median of a per-file figure."""
    m = samples(spark, sf_dir).groupBy("user_id", "event_type").agg((F.max("value") - F.min("value")).alias("x"), F.count("*").alias("n"))
    # One figure per user: a project's list is as long as its files are many.
    a = m.groupBy((F.col("user_id") % 10).alias("project"), "event_type").agg(F.array_sort(F.collect_list("x")).alias("xs"), F.sum("n").alias("n"))
    middle = F.get("xs", F.floor(F.size("xs") / 2).cast("int"))
    return a.select("project", "event_type", F.round(middle, 6).alias("upper_median"), "n", F.round(F.col("n") * 1.5 / 200 / 3600, 9).alias("hours"))


@query("""
WITH d AS (SELECT user_id % 25 AS project, floor(epoch_us(ts) / 86400000000)::BIGINT AS day, count(*) FILTER (value > 300) AS ok FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY day DESC) AS back FROM d),
s AS (SELECT project, min(back) FILTER (ok > 0) AS first_ok, count(*) AS n FROM r GROUP BY project)
SELECT project, coalesce(first_ok - 1, n) AS idle_runs, coalesce(first_ok - 1, n) >= 2 AS stalled FROM s""")
def stalled_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the latest runs in a row brought nothing; two or more are a stall."""
    rows = samples(spark, sf_dir).select((F.col("user_id") % 25).alias("project"), F.floor(micros(F.col("ts")) / 86_400_000_000).alias("day"), "value")
    runs = rows.groupBy("project", "day").agg(F.count_if(F.col("value") > 300).alias("ok"))
    back = F.row_number().over(Window.partitionBy("project").orderBy(F.desc("day")))
    out = runs.withColumn("back", back).groupBy("project").agg(F.min(F.when(F.col("ok") > 0, F.col("back"))).alias("first"), F.count("*").alias("n"))
    idle = F.coalesce(F.col("first") - 1, F.col("n")).cast("long")
    return out.select("project", idle.alias("idle_runs"), (idle >= 2).alias("stalled"))


@query("""
SELECT user_id, round(avg(value) FILTER (event_type = 'click'), 6) AS click_mean, round(stddev_pop(value) FILTER (event_type = 'click'), 6) AS click_sd,
       round(avg(value) FILTER (event_type = 'view'), 6) AS view_mean, round(stddev_pop(value) FILTER (event_type = 'view'), 6) AS view_sd
FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE n >= 10 AND event_type IN ('click', 'view') GROUP BY user_id""")
def patient_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per patient with ten values at least, statistics per variable side by side."""
    rows = samples(spark, sf_dir).withColumn("n", F.count("*").over(Window.partitionBy("user_id"))).where("n >= 10")
    wide = rows.groupBy("user_id").pivot("event_type", ["click", "view"]).agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("sd"))
    return wide.where("click_mean is not null or view_mean is not null")


@query("""
WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY sha256(event_id::VARCHAR), event_id) AS k FROM events)
SELECT user_id, event_id FROM r WHERE k <= 7""")
def capped_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most seven samples per file, in an order by hash that stays the same."""
    w = Window.partitionBy("user_id").orderBy(F.sha2(F.col("event_id").cast("string"), 256), "event_id")
    return samples(spark, sf_dir).withColumn("k", F.row_number().over(w)).where("k <= 7").select("user_id", "event_id")


@query("""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS decision, count(*) AS n_decisions, arg_max(event_type, (ts, event_id)) NOT IN ('view', 'click', 'signup') AS is_artifact
FROM events WHERE event_type <> 'signup' GROUP BY user_id""")
def review_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest decision per recording; unknown ones never count."""
    rows = samples(spark, sf_dir).where("event_type <> 'signup'")
    out = rows.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("decision"), F.count("*").alias("n_decisions"))
    return out.withColumn("is_artifact", ~F.col("decision").isin("view", "click", "signup"))


@query("""
WITH p AS (SELECT c_nationkey, c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_nationkey, count(*) FILTER (n > 0) || ' of ' || count(*) || ' patients, ' || sum(n)::BIGINT || ' recordings' AS sentence FROM p GROUP BY c_nationkey""")
def coverage_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    per = rows.groupBy("c_nationkey", "c_custkey").agg(F.count("o_orderkey").alias("n"))
    text = F.format_string("%d of %d patients, %d recordings", F.count_if(F.col("n") > 0), F.count("*"), F.sum("n"))
    return per.groupBy("c_nationkey").agg(text.alias("sentence"))


@query("""
WITH s AS (SELECT event_id AS id, user_id, epoch_us(ts) / 1e6 AS t, value FROM events),
n AS (SELECT event_id, s.t - e.t AS d, s.value, row_number() OVER (PARTITION BY event_id ORDER BY s.t DESC, s.id DESC) AS k FROM (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS t FROM events WHERE event_type = 'purchase') e
      JOIN s ON s.user_id = e.user_id AND s.t < e.t AND s.t >= e.t - 172800)
SELECT event_id, round(-d, 6) AS age_s, value FROM n WHERE k = 1""")
def latest_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of alignment: the last earlier sample before each purchase within two days, by one sorted pass and no join."""
    df = samples(spark, sf_dir).withColumn("t", seconds(F.col("ts")))
    before = Window.partitionBy("user_id").orderBy(micros(F.col("ts"))).rangeBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("was", F.max(F.struct("t", "event_id", "value")).over(before)).withColumn("age_s", F.col("t") - F.col("was.t")).withColumn("last", F.col("was.value"))
    return out.where("event_type = 'purchase' and age_s <= 172800").select("event_id", F.round("age_s", 6).alias("age_s"), F.col("last").alias("value"))


@query("""
SELECT conv_id, count(*) AS n_turns, count(DISTINCT role) AS n_roles, bool_or(role = 'assistant') AS has_answer, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles,
       count(DISTINCT role) = 2 AS complete FROM conversations GROUP BY conv_id""")
def unit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per unit with conditional counts and sets."""
    g = table(spark, sf_dir, "conversations").groupBy("conv_id")
    out = g.agg(F.count("*").alias("n_turns"), F.countDistinct("role").alias("n_roles"), F.bool_or(F.col("role") == "assistant").alias("has_answer"), F.array_sort(F.collect_set("role")).alias("r"))
    return out.select("conv_id", "n_turns", "n_roles", "has_answer", F.array_join("r", ",").alias("roles"), (F.col("n_roles") == 2).alias("complete"))


@query("""
WITH x AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 100), u AS (SELECT DISTINCT user_id FROM events), t AS (SELECT DISTINCT event_type FROM events)
SELECT user_id, event_type FROM u, t EXCEPT SELECT user_id, event_type FROM x""")
def absent_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected labels that a patient lacks: expectation is every patient times the few labels there are."""
    df = samples(spark, sf_dir)
    labels = df.select("event_type").distinct().agg(F.collect_set("event_type").alias("l"))  # one small row
    expected = df.select("user_id").distinct().join(F.broadcast(labels)).select("user_id", F.explode("l").alias("event_type"))
    return expected.join(df.where("value > 100").select("user_id", "event_type").distinct(), ["user_id", "event_type"], "left_anti")
