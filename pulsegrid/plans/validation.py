"""Queries on checks, verdicts and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import validation
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import KEYS, samples, with_missing
from pulsegrid.session import table

_ORDER = ("FAIL", "WARNING", "PASS")


@query("""
WITH c AS (
  SELECT c_custkey, 'balance' AS c, CASE WHEN c_acctbal >= 0 THEN 'PASS' ELSE 'FAIL' END AS r, 0 AS p FROM customer UNION ALL
  SELECT c_custkey, 'nation', CASE WHEN c_nationkey <> 7 THEN 'PASS' ELSE 'WARNING' END, 1 FROM customer UNION ALL
  SELECT c_custkey, 'rich', CASE WHEN c_acctbal < 9000 THEN 'PASS' ELSE 'WARNING' END, 2 FROM customer
),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY CASE r WHEN 'FAIL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, p) AS k, count(*) FILTER (r <> 'PASS') OVER (PARTITION BY c_custkey) AS n_failed FROM c)
SELECT c_custkey, r AS verdict, CASE WHEN r <> 'PASS' THEN c END AS because, n_failed FROM r WHERE k = 1""")
def file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rules = [("balance", c("c_acctbal") >= 0, "FAIL", c("c_acctbal")), ("nation", c("c_nationkey") != 7, "WARNING", c("c_nationkey")), ("rich", c("c_acctbal") < 9000, "WARNING", c("c_acctbal"))]
    return validation.verdict(validation.checks(table(spark, sf_dir, "customer"), ["c_custkey"], rules), ["c_custkey"], _ORDER)


@query("""
WITH s AS (SELECT user_id, ts, CASE WHEN value >= 60 THEN floor(value / 40) END AS v, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
o AS (SELECT *, abs(dt - median(dt) OVER x) > 0.5 * median(dt) OVER x AS odd FROM s WINDOW x AS (PARTITION BY user_id)),
a AS (SELECT user_id, count(v) AS n, epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6 AS duration, avg(odd::INT) AS odd, max(dt) AS gap, 1 - count(v) / count(*) AS missing, avg((v NOT BETWEEN 1 AND 6)::INT) AS outside FROM o GROUP BY user_id),
c AS (SELECT user_id, ts, CASE WHEN lag(v) OVER w = v THEN 0 ELSE 1 END AS new FROM s WHERE v IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM c),
l AS (SELECT user_id, max(n) AS longest FROM (SELECT user_id, run, count(*) - 1 AS n FROM r GROUP BY ALL) GROUP BY user_id),
f AS (
  SELECT user_id, 'RECORDING_TOO_SHORT' AS flag, 'error' AS severity, duration AS measured FROM a WHERE duration < 2500000 UNION ALL
  SELECT user_id, 'SAMPLING_IRREGULAR', 'warning', odd FROM a WHERE odd > 0.5 UNION ALL SELECT user_id, 'TIMESTAMP_GAP', 'warning', gap FROM a WHERE gap > 200000 UNION ALL
  SELECT user_id, 'MISSING_DATA_HIGH', 'warning', missing FROM a WHERE missing > 0.6 UNION ALL SELECT user_id, 'SIGNAL_FLAT', 'warning', longest FROM l WHERE longest >= 3 UNION ALL
  SELECT user_id, 'RANGE_WARNING', 'warning', outside FROM a WHERE outside > 0.05 UNION ALL SELECT user_id, 'NO_DATA', 'error', n FROM a WHERE n = 0)
SELECT user_id, flag, severity, round(measured, 4) AS measured FROM f""")
def recording_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir).withColumn("v", F.when(F.col("value") >= 60, F.floor(F.col("value") / 40)).cast("double"))
    out = validation.recording_flags(df, "user_id", "ts", "v", 2_500_000, 200_000, 0.6, 1, 6, 3)
    return out.withColumn("measured", F.round("measured", 4))


@query("""
SELECT u.user_id, count(f.user_id) AS n_flags, CASE WHEN count(f.user_id) > 0 THEN 'REVIEW' ELSE 'PASS' END AS verdict
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT user_id FROM events WHERE value > 320) f ON u.user_id = f.user_id GROUP BY u.user_id""")
def review_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = samples(spark, sf_dir)
    return validation.review_verdict(df, df.where("value > 320"), "user_id")


@query("""
WITH q AS (SELECT user_id, event_type, CASE WHEN value < 20 THEN 'MISSING' WHEN value > 200 THEN 'SPIKE' WHEN value > 180 THEN 'FLATLINE' ELSE 'VALID' END AS qc FROM events),
a AS (SELECT user_id, event_type, count(*) AS n, count(*) FILTER (qc IN ('SPIKE', 'FLATLINE')) AS n_artifact, count(*) FILTER (qc = 'MISSING') AS n_missing FROM q GROUP BY ALL)
SELECT user_id, event_type, n, n_artifact, n_missing, round(coalesce(n_artifact / nullif(n - n_missing, 0), 0), 6) AS artifact_rate, round(n_missing / n, 6) AS missing_rate,
       concat_ws(',', CASE WHEN coalesce(n_artifact / nullif(n - n_missing, 0), 0) > 0.1 THEN 'ARTIFACTS' END, CASE WHEN n_missing / n > 0.5 THEN 'MISSING' END) AS finding FROM a""")
def qc_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    qc = F.when(v < 20, "MISSING").when(v > 200, "SPIKE").when(v > 180, "FLATLINE").otherwise("VALID")
    out = validation.qc_rates(samples(spark, sf_dir).withColumn("qc", qc), KEYS, "qc", ["SPIKE", "FLATLINE"], ["MISSING"])
    return out.withColumns({c: F.round(c, 6) for c in ("artifact_rate", "missing_rate")})


@query("""
WITH e AS (SELECT DISTINCT c_nationkey AS nation, c_mktsegment AS segment, floor(c_acctbal / 500)::BIGINT AS class FROM customer), o AS (SELECT DISTINCT c_nationkey AS nation, c_mktsegment AS segment, floor((c_acctbal + 100) / 500)::BIGINT AS class FROM customer)
SELECT *, 'MISSING' AS status FROM (SELECT * FROM e EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'UNEXPECTED' FROM (SELECT * FROM o EXCEPT SELECT * FROM e)""")
def template_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of balances that customers are expected in, and those they are in after a payment."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    side = lambda paid: c.withColumn("class", F.floor((F.col("c_acctbal") + paid) / 500)).drop("c_acctbal")
    return validation.template_audit(side(0), side(100), ["nation", "segment", "class"])


@query("""
WITH r AS (SELECT user_id, event_type, CASE WHEN value > 150 THEN 'FAIL' WHEN value > 80 THEN 'WARNING' ELSE 'PASS' END AS r FROM events),
w AS (SELECT user_id, event_type, min(CASE r WHEN 'FAIL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END) AS k FROM r GROUP BY ALL),
n AS (SELECT user_id, event_type, ['FAIL', 'WARNING', 'PASS'][k] AS r FROM w)
SELECT user_id, coalesce(max(r) FILTER (event_type = 'click'), 'ABSENT') AS click, coalesce(max(r) FILTER (event_type = 'purchase'), 'ABSENT') AS purchase FROM n GROUP BY user_id""")
def device_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    df = samples(spark, sf_dir).withColumn("r", F.when(v > 150, "FAIL").when(v > 80, "WARNING").otherwise("PASS"))
    return validation.checklist(df, "user_id", "event_type", "r", ["click", "purchase"], _ORDER)


@query("SELECT l_returnflag, count(*) FILTER (l_quantity NOT BETWEEN 2 AND 48 OR l_discount NOT BETWEEN 0.01 AND 0.09) AS n_artifact, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def out_of_any_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = validation.out_of_any_range(table(spark, sf_dir, "lineitem"), {"l_quantity": (2, 48), "l_discount": (0.01, 0.09)})
    return df.groupBy("l_returnflag").agg(F.count_if("artifact").alias("n_artifact"), F.count("*").alias("n"))


@query("""
WITH s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
f AS (SELECT user_id, min(i) FILTER (value BETWEEN 100 AND 200) AS first FROM s GROUP BY user_id)
SELECT s.user_id, event_id FROM s JOIN f USING (user_id) WHERE i BETWEEN first AND first + 9""")
def data_rich_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.rich_part(samples(spark, sf_dir), ["user_id"], "ts", "value", 100, 200, 10).select("user_id", "event_id")


@query("""
WITH m AS (SELECT user_id, event_type, CASE WHEN count(*) FILTER (value >= 100) = 0 THEN 'gone' WHEN count(*) FILTER (value < 100) = 0 THEN 'complete' ELSE 'gappy' END AS kind FROM events GROUP BY ALL)
SELECT user_id, CASE WHEN bool_or(kind = 'gone') THEN 'gone' WHEN bool_or(kind = 'gappy') THEN 'gappy' ELSE 'complete' END AS worst_kind,
       count(*) FILTER (kind = 'gone') AS n_gone, count(*) FILTER (kind = 'gappy') AS n_gappy, count(*) FILTER (kind = 'complete') AS n_complete FROM m GROUP BY user_id""")
def missingness_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = with_missing(samples(spark, sf_dir)).groupBy(*KEYS).agg(F.count("v").alias("have"), F.count("*").alias("n"))
    kind = F.when(F.col("have") == 0, "gone").when(F.col("have") == F.col("n"), "complete").otherwise("gappy")
    return validation.worst_kind(m.withColumn("kind", kind), ["user_id"], "kind", ("gone", "gappy", "complete"))


@query("""
WITH r AS (SELECT event_type, user_id, max(value) AS f1 FROM events GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY f1 DESC, user_id) AS k, count(*) OVER (PARTITION BY event_type) AS n_versions FROM r)
SELECT event_type, user_id, f1, n_versions FROM b WHERE k = 1""")
def champion_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = samples(spark, sf_dir).groupBy("event_type", "user_id").agg(F.max("value").alias("f1"))
    return validation.champion(registry, "event_type", "f1", "user_id")
