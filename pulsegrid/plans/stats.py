"""Queries on statistics, privacy, joins and catalogue work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators import catalog, quality, stats
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import KEYS, samples, with_missing
from pulsegrid.session import table


@query("""
SELECT event_type, count(v) AS n, round_even(avg(v), 1) AS mean, round_even(stddev_samp(v), 1) AS sd, round_even(quantile_cont(v, 0.5), 1) AS median,
       round_even(quantile_cont(v, 0.25), 1) AS p25, round_even(quantile_cont(v, 0.75), 1) AS p75, round_even(min(v), 1) AS min, round_even(max(v), 1) AS max,
       round_even((1 - count(v) / count(*)) * 100, 1) AS missing_pct
FROM (SELECT event_type, CASE WHEN value >= 100 THEN value END AS v FROM events) GROUP BY event_type""")
def describe_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.describe(with_missing(samples(spark, sf_dir)), ["event_type"], "v")


@query("""
SELECT user_id, event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(quantile_cont(value, 0.5), 6) AS median,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.75), 6) AS p75, min(value) AS min, max(value) AS max, 0.0::DOUBLE AS missing_pct
FROM events GROUP BY ALL""")
def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.describe(samples(spark, sf_dir), KEYS, "value", rounded=False)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "sd", "median", "p25", "p75")})


_SHARES = [0.001, 0.01, 0.05, 0.5, 0.95, 0.99, 0.999]


@query(f"""
SELECT event_type, s::DOUBLE AS share, round(quantile_cont(value, {_SHARES})[i], 6) AS value
FROM events, (SELECT unnest({_SHARES}) AS s, unnest(range(1, {len(_SHARES) + 1})) AS i) GROUP BY event_type, s, i""")
def extreme_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.extreme_quantiles(samples(spark, sf_dir), ["event_type"], "value", _SHARES)
    return out.withColumn("value", F.round("value", 6))


@query("""
WITH v AS (SELECT c_mktsegment AS g, round(c_acctbal) AS x FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
r AS (SELECT g, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS mr FROM v)
SELECT g, round(sum(mr), 3) AS rank_sum, count(*) AS n FROM r GROUP BY g""")
def rank_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    rows = rows.select(F.col("c_mktsegment").alias("g"), F.round("c_acctbal").alias("x"))
    return stats.midranks(rows, "x").groupBy("g").agg(F.round(F.sum("midrank"), 3).alias("rank_sum"), F.count("*").alias("n"))


@query("""
WITH v AS (SELECT event_type, user_id % 3 AS g, round(value) AS x FROM events),
r AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY x) + (count(*) OVER (PARTITION BY event_type, x) - 1) / 2 AS mr FROM v),
t AS (SELECT event_type, sum(t * t * t - t) AS ties FROM (SELECT event_type, x, count(*)::DOUBLE AS t FROM v GROUP BY ALL) GROUP BY event_type),
g AS (SELECT event_type, g, count(*) AS m, sum(mr) AS r FROM r GROUP BY ALL),
s AS (SELECT event_type, count(*) AS n_groups, sum(m)::BIGINT AS n, sum(r * r / m) AS s FROM g GROUP BY event_type)
SELECT event_type, n_groups, n, round((12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (n::DOUBLE * n * n - n)), 6) AS h FROM s JOIN t USING (event_type)""")
def kruskal_wallis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).select("event_type", (F.col("user_id") % 3).alias("g"), F.round("value").alias("x"))
    return stats.rank_test(rows, "g", "x", ["event_type"]).select("event_type", "n_groups", "n", F.round("h", 6).alias("h"))


@query("""
WITH s AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS w, event_id % 2 AS g, value AS v FROM events),
z AS (SELECT user_id, w, g, count(*) AS m FROM s GROUP BY ALL HAVING count(*) >= 3),
r AS (SELECT *, rank() OVER o + (count(*) OVER (PARTITION BY user_id, w, v) - 1) / 2 AS rank, count(*) OVER (PARTITION BY user_id, w, v) > 1 AS tied FROM s JOIN z USING (user_id, w, g) WINDOW o AS (PARTITION BY user_id, w ORDER BY v)),
t AS (SELECT user_id, w, count(DISTINCT g) AS n_groups, count(*) AS n, arg_min(m, g)::BIGINT AS m1, sum(rank) FILTER (g = 0) AS r1, bool_or(tied) AS ties FROM r GROUP BY ALL),
u AS (SELECT *, CASE WHEN n_groups = 2 THEN r1 - m1 * (m1 + 1) / 2 END AS u, n_groups = 2 AND NOT ties AS exact FROM t),
f AS (SELECT n, m1, sum_ FROM (SELECT DISTINCT n, m1 FROM u WHERE exact) d, LATERAL (SELECT list_sum(list_transform(range(d.n), lambda k: ((mask >> k) & 1) * (k + 1))) AS sum_ FROM range((1::BIGINT << d.n)) x(mask) WHERE bit_count(mask) = d.m1)),
p AS (SELECT user_id, w, least(1.0, 2 * avg((sum_ - u.m1 * (u.m1 + 1) / 2 <= least(u, u.m1 * (u.n - u.m1) - u))::INT)) AS p FROM u JOIN f USING (n, m1) WHERE exact GROUP BY user_id, w)
SELECT user_id, w, n_groups, n, u, CASE WHEN exact THEN 'exact' WHEN n_groups = 2 THEN 'normal' END AS method, round(p, 9) AS p FROM u LEFT JOIN p USING (user_id, w)""")
def exact_rank_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even against odd samples in windows of ten: p-values are exact where no two values are equal."""
    rows = samples(spark, sf_dir).withColumn("w", F.floor((F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1) / 10))
    out = stats.rank_test(rows.withColumn("g", F.col("event_id") % 2), "g", "value", ["user_id", "w"])
    return out.select("user_id", "w", "n_groups", "n", "u", "method", F.round(F.when(F.col("method") == "exact", F.col("p")), 9).alias("p"))


@query()
def rank_test_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-values of two and of three groups; tested against known tables."""
    rows = samples(spark, sf_dir).select("event_type", (F.col("user_id") % 2).alias("g"), "value")
    three = samples(spark, sf_dir).select(F.concat("event_type", F.lit("/3")).alias("event_type"), (F.col("user_id") % 3).alias("g"), "value")
    return stats.rank_test(rows.unionByName(three), "g", "value", ["event_type"])


@query("""
SELECT event_type, d AS day, count(DISTINCT user_id) AS n_units, CASE WHEN count(*) >= 5 THEN count(*) END AS n_rows, round(avg(value), 9) AS mean
FROM (SELECT *, CAST(ts AS DATE) AS dt, epoch_us(ts) // 86400000000 AS d FROM events) GROUP BY event_type, d HAVING count(DISTINCT user_id) >= 5""")
def k_anonymous_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsegrid.operators.timeseries import micros

    rows = samples(spark, sf_dir).withColumn("day", F.floor(micros(F.col("ts")) / 86_400_000_000))
    out = stats.k_anonymous(rows, ["event_type", "day"], "user_id", "value")
    return out.withColumn("mean", F.round("mean", 9))


@query("""
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_units, round_even(count(DISTINCT o_custkey) / (SELECT count(DISTINCT o_custkey) FROM orders), 3) AS prevalence,
       CASE WHEN round_even(count(DISTINCT o_custkey) / (SELECT count(DISTINCT o_custkey) FROM orders), 3) >= 0.9 THEN 'expected' ELSE 'optional' END AS status
FROM orders GROUP BY o_orderpriority""")
def modality_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.prevalence(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey", 0.9)


_SEVERITY = {"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1}


@query("""
WITH s AS (SELECT o_custkey, o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END AS s FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY s DESC, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n_checks FROM s)
SELECT o_custkey, o_orderpriority AS worst, n_checks FROM r WHERE k = 1""")
def worst_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.worst_first(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", _SEVERITY, "o_orderkey")


@query("""
WITH r(event_type, ref_mean, ref_sd, low, high) AS (VALUES ('click', 45.0, 20.0, 1.0, 200.0), ('view', 150.0, 10.0, 1.0, 200.0), ('purchase', 80.0, 20.0, 1.0, 100.0)),
a AS (SELECT event_type, avg(value) AS mean, stddev_samp(value) AS sd, quantile_cont(value, 0.05) AS p5, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95,
             avg((value NOT BETWEEN low AND high)::INT) * 100 AS out_pct, any_value(ref_mean) AS rm, any_value(ref_sd) AS rs FROM events JOIN r USING (event_type) GROUP BY event_type)
SELECT event_type, round(mean, 6) AS mean, round(sd, 6) AS sd, round(p5, 6) AS p5, round(p50, 6) AS p50, round(p95, 6) AS p95, round(out_pct, 6) AS out_pct, round((mean - rm) / rs, 6) AS z,
       CASE WHEN abs((mean - rm) / rs) > 3 THEN 'DIFFERENT' WHEN abs((mean - rm) / rs) > 2 OR out_pct > 5 THEN 'CHECK' ELSE 'CONSISTENT' END AS verdict FROM a""")
def external_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = spark.createDataFrame(
        [("click", 45.0, 20.0, 1.0, 200.0), ("view", 150.0, 10.0, 1.0, 200.0), ("purchase", 80.0, 20.0, 1.0, 100.0)],
        "event_type string, ref_mean double, ref_sd double, low double, high double",
    )
    out = stats.external_validation(samples(spark, sf_dir), ["event_type"], "value", reference)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "sd", "p5", "p50", "p95", "out_pct", "z")})


@query("""
WITH l(event_type, warn_pct, critical_pct, exempt) AS (VALUES ('click', 30.0, 70.0, false), ('view', 60.0, 80.0, false), ('error', 10.0, 20.0, true)),
a AS (SELECT user_id, event_type, (1 - count(CASE WHEN value >= 100 THEN value END) / count(*)) * 100 AS p FROM events GROUP BY ALL)
SELECT a.user_id, a.event_type, round(p, 6) AS null_pct, CASE WHEN coalesce(exempt, false) THEN 'EXEMPT' WHEN p > 90 THEN 'CRITICAL_EMPTY' WHEN p >= critical_pct THEN 'CRITICAL'
       WHEN p >= warn_pct THEN 'WARNING' ELSE 'OK' END AS status FROM a LEFT JOIN l USING (event_type)""")
def overfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = spark.createDataFrame(
        [("click", 30.0, 70.0, False), ("view", 60.0, 80.0, False), ("error", 10.0, 20.0, True)], "event_type string, warn_pct double, critical_pct double, exempt boolean"
    )
    out = stats.overfilter(with_missing(samples(spark, sf_dir)), ["user_id"], "v", "event_type", limits)
    return out.withColumn("null_pct", F.round("null_pct", 6))


_SCAN = ", ".join(f"count(*) FILTER (regexp_matches(text, '{p}')) AS n_{k}" for k, p in stats.IDENTIFIERS.items())


@query(f"""
SELECT lang, count(text) AS n, {_SCAN}, count(DISTINCT text) AS n_distinct, round(avg(length(text)), 6) AS mean_length,
       count(DISTINCT text) > greatest(10, count(text) / 2) AND avg(length(text)) > 20 AS free_text FROM documents GROUP BY lang""")
def identifier_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.identifier_scan(table(spark, sf_dir, "documents"), ["lang"], "text")
    return out.withColumn("mean_length", F.round("mean_length", 6))


@query(f"""
SELECT role, count(text) AS n, {_SCAN}, count(DISTINCT text) AS n_distinct, round(avg(length(text)), 6) AS mean_length,
       count(DISTINCT text) > greatest(10, count(text) / 2) AND avg(length(text)) > 20 AS free_text FROM conversations GROUP BY role""")
def identifier_scan_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.identifier_scan(table(spark, sf_dir, "conversations"), ["role"], "text")
    return out.withColumn("mean_length", F.round("mean_length", 6))


@query("""
WITH r AS (SELECT user_id % 10 AS project, floor(epoch_us(ts) / 86400000000)::BIGINT AS day, count(*) FILTER (event_type = 'error') AS failed, count(*) AS total FROM events GROUP BY ALL),
p AS (SELECT *, failed / nullif(total, 0) AS rate, list_sort(list(failed / nullif(total, 0)) OVER (PARTITION BY project ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS past FROM r),
b AS (SELECT *, past[len(past) // 2 + 1] AS baseline FROM p)
SELECT project, day, failed, total, round(rate, 6) AS rate, round(baseline, 6) AS baseline,
       coalesce(failed >= 2 AND rate >= 0.25 AND rate > 3 * coalesce(baseline, 0) + 0.05, false) AS spike FROM b""")
def failure_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsegrid.operators.timeseries import micros

    rows = samples(spark, sf_dir).select((F.col("user_id") % 10).alias("project"), F.floor(micros(F.col("ts")) / 86_400_000_000).alias("day"), "event_type")
    runs = rows.groupBy("project", "day").agg(F.count_if(F.col("event_type") == "error").alias("failed"), F.count("*").alias("total"))
    out = stats.failure_spikes(runs, "project", "day", "failed", "total", least=2)
    return out.withColumn("rate", F.round("rate", 6)).withColumn("baseline", F.round("baseline", 6))


# Joins and aggregates over the relational core.


@query("""
SELECT n_name, c_mktsegment, count(*) FILTER (o_orderstatus = 'F') AS n_done, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, customer, orders = (table(spark, sf_dir, t) for t in ("nation", "customer", "orders"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name", "c_mktsegment").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_done"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).orderBy("o_orderstatus", "o_orderpriority")


@query("SELECT c_nationkey, count(*) AS n, count(DISTINCT c_mktsegment) AS n_segments FROM customer GROUP BY c_nationkey")
def count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.countDistinct("c_mktsegment").alias("n_segments"))


@query("""
SELECT count(*) FILTER (l_returnflag = 'R') AS n_returned, count(*) FILTER (l_discount = 0) AS n_full_price, count(*) FILTER (l_shipdate IS NULL) AS n_undated, count(*) AS n FROM lineitem""")
def provenance_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").agg(
        F.count_if(c("l_returnflag") == "R").alias("n_returned"), F.count_if(c("l_discount") == 0).alias("n_full_price"), F.count_if(c("l_shipdate").isNull()).alias("n_undated"), F.count("*").alias("n")
    )


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) > 30")
def duplicates_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).where("n > 30").orderBy(F.desc("n"), "l_partkey")


@query("SELECT (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM events) AS n_events")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = [table(spark, sf_dir, t).agg(F.count("*").alias(n)) for t, n in (("orders", "n_orders"), ("customer", "n_customers"), ("events", "n_events"))]
    return one[0].crossJoin(one[1]).crossJoin(one[2])  # one row each


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return catalog.orphans(table(spark, sf_dir, "customer"), urgent, "c_custkey", "o_custkey").select("c_custkey")


@query("""
SELECT c_custkey, coalesce(o_orderpriority, 'none') AS priority, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY ALL""")
def left_join_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    rows = table(spark, sf_dir, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy("c_custkey", F.coalesce("o_orderpriority", F.lit("none")).alias("priority")).agg(F.count("o_orderkey").alias("n"))


@query("""
SELECT user_id, event_type, count(*) AS n FROM events e WHERE EXISTS (SELECT 1 FROM events x WHERE x.event_type = 'purchase' AND x.value > 150 AND x.user_id = e.user_id) GROUP BY ALL""")
def cohort_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    cohort = rows.where("event_type = 'purchase' and value > 150").select("user_id").distinct()
    return rows.join(cohort, "user_id", "left_semi").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("""
WITH e AS (SELECT user_id, CASE WHEN value >= 20 THEN event_type END AS k FROM events),
x AS (SELECT user_id, CASE WHEN value > 200 THEN NULL WHEN value < 50 THEN 'old ' || event_type ELSE event_type END AS k FROM events)
SELECT user_id, k, count(*) AS n FROM e WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.user_id = e.user_id AND x.k IS NOT DISTINCT FROM e.k) GROUP BY ALL""")
def idempotent_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples under keys of which some are null, beside a table that has all of them under its own names."""
    df, v = samples(spark, sf_dir), F.col("value")
    rows = df.select("user_id", F.when(v >= 20, F.col("event_type")).alias("k"))
    there = df.select("user_id", F.when(v > 200, None).when(v < 50, F.concat(F.lit("old "), "event_type")).otherwise(F.col("event_type")).alias("k"))
    return catalog.new_rows(rows, there, ["user_id", "k"]).groupBy("user_id", "k").agg(F.count("*").alias("n"))


_FILES_A = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' ELSE 'p' END || doc_id AS path, n_chars AS size, sha256(text) AS h FROM documents"
_FILES_B = "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'b' WHEN doc_id % 5 = 0 THEN 'q' ELSE 'p' END || doc_id AS path, CASE WHEN doc_id % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS size, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'x' ELSE sha256(text) END AS h FROM documents"


def _mirrors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents as files of two mirrors, which name some differently and differ in some sizes and hashes."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("size"), F.sha2("text", 256).alias("h"))
    i = F.col("doc_id")
    a = d.withColumn("path", F.concat(F.when(i % 3 == 0, "a").otherwise("p"), i))
    b = d.withColumn("path", F.concat(F.when(i % 4 == 0, "b").when(i % 5 == 0, "q").otherwise("p"), i))
    b = b.withColumn("size", F.when(i % 7 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return a, b.withColumn("h", F.when(i % 11 == 0, None).when(i % 13 == 0, "x").otherwise(F.col("h")))


@query(f"""
WITH a AS ({_FILES_A}), b AS ({_FILES_B}),
c AS (SELECT h, size, min(path) AS cp FROM b GROUP BY ALL),
m AS (SELECT a.path, coalesce(cp, b.path) AS target_path, CASE WHEN cp IS NOT NULL THEN 'MATCHED' WHEN b.path IS NULL THEN 'MISSING' WHEN b.size = a.size AND (b.h IS NULL OR a.h IS NULL) THEN 'MATCHED_SIZE' ELSE 'CONFLICT' END AS status
      FROM a LEFT JOIN c ON a.h = c.h AND a.size = c.size LEFT JOIN b ON a.path = b.path),
u AS (SELECT * FROM m UNION ALL SELECT path, path, 'TARGET_ONLY' FROM b WHERE path NOT IN (SELECT target_path FROM m WHERE target_path IS NOT NULL))
SELECT path, target_path, status, CASE status WHEN 'MISSING' THEN 'upload' WHEN 'CONFLICT' THEN 'conflict' WHEN 'TARGET_ONLY' THEN 'review' ELSE 'none' END AS action FROM u""")
def reconcile_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.reconcile(*_mirrors(spark, sf_dir), "path", "size", "h")


@query(f"""
WITH a AS ({_FILES_A}), b AS ({_FILES_B})
SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.size IS NULL THEN 'ONLY_IN_MAIN' WHEN a.size IS NULL THEN 'ONLY_IN_NESTED' WHEN a.size <> b.size THEN 'SIZE_MISMATCH'
       WHEN a.h <> b.h THEN 'HASH_MISMATCH' ELSE 'IDENTICAL' END AS status FROM a FULL JOIN b ON a.path = b.path""")
def mirror_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.mirror_status(*_mirrors(spark, sf_dir), "path", "size", "h")


@query("""
WITH d AS (SELECT doc_id, sha256(text) AS h FROM documents)
SELECT doc_id, nullif(min(doc_id) OVER (PARTITION BY h), doc_id) AS duplicate_of FROM d""")
def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return catalog.content_duplicates(d, "doc_id", "h").select("doc_id", "duplicate_of")


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey FROM r WHERE k = 1""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = catalog.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_partkey")])
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT conv_id, count(*) AS n_slices, sha256(string_agg(h, '' ORDER BY h)) AS chain_sha256 FROM (SELECT conv_id, sha256(text) AS h FROM conversations) GROUP BY conv_id""")
def chain_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.sha2("text", 256).alias("h"))
    return catalog.chain_hash(turns, "conv_id", "h")


@query("""
WITH m AS (SELECT doc_id, source || '/' || (doc_id % 50) AS target, sha256(text) AS h FROM documents)
SELECT doc_id, CASE WHEN min(h) OVER (PARTITION BY target) <> max(h) OVER (PARTITION BY target) THEN 'conflict'
       WHEN row_number() OVER (PARTITION BY target ORDER BY doc_id) = 1 THEN 'move' ELSE 'duplicate' END AS status FROM m""")
def plan_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", (F.col("doc_id") % 50).cast("string")).alias("target"), F.sha2("text", 256).alias("h"))
    return catalog.plan_collisions(m, "target", "h", "doc_id").select("doc_id", "status")


@query("""
SELECT l_linenumber AS item, CASE WHEN count(*) FILTER (l_returnflag = 'A') > 0 THEN 'YES' ELSE '' END AS "A", CASE WHEN count(*) FILTER (l_returnflag = 'N') > 0 THEN 'YES' ELSE '' END AS "N",
       CASE WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN 'YES' ELSE '' END AS "R" FROM lineitem GROUP BY l_linenumber""")
def presence_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("item"), "l_returnflag")
    return catalog.presence_pivot(rows, "item", "l_returnflag", ["A", "N", "R"])


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, sum(o_totalprice) OVER w AS running, row_number() OVER w AS k FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, o_orderkey FROM r WHERE running <= 300000 OR k = 1""")
def budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.budget_prefix(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice", 300000).select("o_custkey", "o_orderkey")


@query("""
WITH RECURSIVE s AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
c AS (SELECT conv_id, turn, k, size, size AS used, 0 AS chunk FROM s WHERE k = 1
      UNION ALL SELECT s.conv_id, s.turn, s.k, s.size, CASE WHEN used + s.size > 600 THEN s.size ELSE used + s.size END, CASE WHEN used + s.size > 600 THEN chunk + 1 ELSE chunk END
      FROM c JOIN s ON s.conv_id = c.conv_id AND s.k = c.k + 1)
SELECT conv_id, turn, chunk FROM c""")
def size_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return catalog.size_chunks(turns, ["conv_id"], "turn", "size", 600).select("conv_id", "turn", "chunk")


@query("SELECT o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS chunk FROM orders")
def chunk_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.chunk_matrix(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", 5).select("o_orderkey", "chunk")


@query("""
WITH r AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT event_id, user_id FROM r WHERE i % (CASE WHEN n > 60 THEN ceil(n / 20)::BIGINT ELSE 1 END) = 0""")
def decimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.decimate(samples(spark, sf_dir), ["user_id"], "ts", 60, 20).select("event_id", "user_id")


@query("""
WITH r AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer)
SELECT c_custkey, c_nationkey FROM r WHERE k <= 3""")
def group_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.group_cap(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).select("c_custkey", "c_nationkey")


@query("""
SELECT event_id, CASE WHEN p BETWEEN 0.2 AND 0.7 THEN 'uncertain' ELSE 'spot_check' END AS reason, round(abs(p - 0.5), 6) AS distance
FROM (SELECT event_id, value / 500 AS p FROM events) WHERE p BETWEEN 0.2 AND 0.7 OR (p > 0.7 AND event_id % 20 = 0)""")
def uncertainty_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).select("event_id", (F.col("value") / 500).alias("p"))
    return catalog.uncertainty_queue(df, "p", "event_id").select("event_id", "reason", F.round("distance", 6).alias("distance"))


@query("""
WITH p AS (SELECT string_split(regexp_replace(url, '^https?://', ''), '/') AS s FROM pages),
x AS (SELECT array_to_string(s[1:n], '/') AS folder FROM (SELECT s, unnest(range(1, len(s))) AS n FROM p))
SELECT folder, count(*) AS n_files FROM x GROUP BY folder""")
def folder_tree_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("path"))
    return catalog.tree_counts(pages, "path")


@query("""
SELECT event_type, count(DISTINCT user_id) AS n_units, round(count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events WHERE value >= 120), 6) AS stability,
       count(DISTINCT user_id) < (SELECT count(DISTINCT user_id) FROM events WHERE value >= 120) AS drift FROM events WHERE value >= 120 GROUP BY event_type""")
def schema_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = catalog.schema_census(samples(spark, sf_dir).where("value >= 120"), "user_id", "event_type")
    return out.withColumn("stability", F.round("stability", 6))


@query("""
WITH s AS (SELECT event_type AS path, user_id % 4 AS revision, CASE user_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'failed' ELSE 'unsupported' END AS status, user_id FROM events),
l AS (SELECT path || '/' || user_id || CASE WHEN user_id % 5 = 0 THEN '/old' ELSE '' END AS path, max(revision) AS revision, max(status) AS status FROM s GROUP BY ALL),
f AS (SELECT DISTINCT path || '/' || user_id AS path, CASE WHEN user_id % 7 = 0 THEN 9 ELSE user_id % 4 END AS revision FROM s)
SELECT f.path, f.revision FROM f LEFT JOIN l ON f.path = l.path WHERE NOT coalesce(l.revision IS NOT DISTINCT FROM f.revision AND l.status IN ('ok', 'unsupported'), false)""")
def incremental_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    rows = samples(spark, sf_dir).select("user_id", F.concat_ws("/", "event_type", u.cast("string")).alias("path")).distinct()
    status = F.when(u % 3 == 0, "ok").when(u % 3 == 1, "failed").otherwise("unsupported")
    known = F.concat("path", F.when(u % 5 == 0, "/old").otherwise(""))
    state = rows.select(known.alias("path"), (u % 4).alias("revision"), status.alias("status"))
    files = rows.select("path", F.when(u % 7 == 0, 9).otherwise(u % 4).alias("revision"))
    return catalog.to_process(files, state, "path", "revision").select("path", "revision")


@query("""
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS k FROM events) WHERE k = 1""")
def latest_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.latest(samples(spark, sf_dir), ["user_id"], "ts").select("user_id", "event_id", "event_type", "value")


@query(f"""
WITH a AS ({_FILES_A}), b AS ({_FILES_B})
SELECT a.path, CASE WHEN b.path IS NULL THEN 'new' WHEN b.h = a.h THEN 'skip' ELSE 'version' END AS action FROM a LEFT JOIN b ON a.path = b.path""")
def sync_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _mirrors(spark, sf_dir)
    return catalog.sync_action(a, b, "path", "h").select("path", "action")


@query("""
WITH c AS (SELECT DISTINCT lower(regexp_replace(url, '^https?://[^/]*/?', '')) AS name FROM pages)
SELECT name, CASE WHEN list_has_any(regexp_split_to_array(name, '[^a-z0-9]+'), ['id', 'user', 'page']) THEN 'identifier' WHEN list_has_any(regexp_split_to_array(name, '[^a-z0-9]+'), ['html', 'htm', 'index']) THEN 'metadata' ELSE 'unknown' END AS kind FROM c""")
def column_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "pages").select(F.lower(F.regexp_replace("url", "^https?://[^/]*/?", "")).alias("name")).distinct()
    rules = [("identifier", ["id", "user", "page"]), ("metadata", ["html", "htm", "index"])]
    return names.select("name", quality.column_class(F.col("name"), rules).alias("kind"))
