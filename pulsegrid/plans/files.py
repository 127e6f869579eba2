"""Queries on readers, writers and streams: tables are written as files to the shared folder and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples
from pulsegrid.session import table
from pulsegrid.sources import readers, sinks, tables
from pulsegrid.streaming import incremental

c = F.col


def scratch(spark: SparkSession, label: str) -> str:
    """A new place in the folder that driver and executors share; a local one only where they are one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir isn't set")
        base = f"file://{tempfile.gettempdir()}/pulsegrid-files"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@query("""
SELECT strftime(TIMESTAMP '2026-01-01' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S') AS t, event_type AS variable, value FROM events WHERE value <> 0 AND event_type <> 'signup'""")
def read_monitor_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as monitor exports, a column per variable; the missing code and zeros where they can't be go, empty cells too."""
    path = scratch(spark, "monitor")
    df = samples(spark, sf_dir)
    at = F.date_format(F.timestamp_seconds(F.lit(1_767_225_600) + c("event_id")), "yyyyMMddHHmmss")
    cell = lambda t: F.when(c("event_type") == t, F.when(c("value") == 0, "-1401").otherwise(c("value").cast("string")))
    df.select(at.alias("OBSERVATION_DATETIME"), *[cell(t).alias(t) for t in ("click", "view", "purchase", "error")]).write.option("header", True).option("sep", ";").csv(path)
    got = readers.monitor_csv(spark, path, "OBSERVATION_DATETIME", {}, [-1401.0])
    return got.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "variable", "value")


@query("""
SELECT 'event_id' AS "column", count(event_id) > 0 AS has_values FROM events UNION ALL SELECT 'value', count(value) > 0 FROM events
UNION ALL SELECT 'high', count(CASE WHEN value > 400 THEN value END) > 0 FROM events UNION ALL SELECT 'none', count(CASE WHEN value < 0 THEN value END) > 0 FROM events""")
def read_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "footers")
    only = lambda keep: F.when(keep, c("value"))
    samples(spark, sf_dir).select("event_id", "value", only(c("value") > 400).alias("high"), only(c("value") < 0).alias("none")).write.parquet(path)
    return readers.footer_census(spark, path).groupBy("column").agg(F.bool_or("has_values").alias("has_values"))


@query("SELECT n_nationkey::VARCHAR AS project, n_name AS patient, 'HR' AS signal, n_regionkey * 1.5::DOUBLE AS start_s, n_regionkey + 10.0::DOUBLE AS end_s, n_nationkey % 2 AS label FROM nation")
def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "labels")
    n = table(spark, sf_dir, "nation")
    n.select("n_nationkey", "n_name", F.lit("HR"), c("n_regionkey") * 1.5, c("n_regionkey") + 10.0, c("n_nationkey") % 2).write.option("header", True).csv(path)
    return readers.label_csv(spark, path)


@query("SELECT event_id, event_type, value FROM events")
def read_catalog_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue for each user: one JSON array over many lines."""
    path = scratch(spark, "catalog")
    entries = samples(spark, sf_dir).groupBy("user_id").agg(F.collect_list(F.struct("event_id", "event_type", "value")).alias("e"))
    text = F.replace(F.to_json("e"), F.lit("},{"), F.lit("},\n  {"))
    sinks.raw_files(entries.select(F.concat(c("user_id").cast("string"), F.lit(".json")).alias("name"), F.encode(text, "UTF-8").alias("content")), path)
    return readers.json_catalog(spark, path).select("event_id", "event_type", "value")


@query("SELECT 1 AS run, count(*) AS given, count(*) AS written FROM events UNION ALL SELECT 2, count(*), 0 FROM events UNION ALL SELECT 3, count(*), count(*) FILTER (event_type = 'view') FROM events WHERE event_type IN ('view', 'click')")
def signal_table_thrice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples into the signal table: again nothing is written; the third time the views have a new name."""
    path = scratch(spark, "signals")
    long = samples(spark, sf_dir).select(c("user_id").cast("string").alias("recording_id"), F.timestamp_micros(F.unix_micros(c("ts").cast("timestamp"))).alias("ts"), F.concat_ws("-", "event_type", "event_id").alias("variable"), "value", "event_type")
    third = long.where("event_type in ('view', 'click')").withColumn("variable", F.when(c("event_type") == "view", F.concat(c("variable"), F.lit("b"))).otherwise(c("variable")))
    rows = [(i + 1, *sinks.signal_table(x.drop("event_type"), path)) for i, x in enumerate((long, long, third))]
    return spark.createDataFrame(rows, "run int, given long, written long")


@query("""
SELECT 'kept' AS place, count(*) AS n FROM events WHERE value >= 10 UNION ALL SELECT 'quarantine', count(*) FROM events WHERE value < 10""")
def quarantined_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows go to the quarantine, once, however often it is repeated."""
    path = scratch(spark, "quarantine")
    df = samples(spark, sf_dir)
    for _ in range(2):
        kept = sinks.quarantine(df, c("value") < 10, "too low", path)
    return kept.agg(F.lit("kept").alias("place"), F.count("*").alias("n")).unionByName(spark.read.parquet(path).agg(F.lit("quarantine").alias("place"), F.count("*").alias("n")))


@query("""
WITH k AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) SELECT c_nationkey, c_mktsegment, row_number() OVER (ORDER BY c_nationkey, c_mktsegment) AS id FROM k""")
def ids_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are made once: a second call finds them."""
    path = scratch(spark, "ids")
    names = table(spark, sf_dir, "customer")
    sinks.get_or_create(names, path, ["c_nationkey", "c_mktsegment"], "id")
    return sinks.get_or_create(names, path, ["c_nationkey", "c_mktsegment"], "id")


@query("SELECT user_id::VARCHAR AS exam, event_type AS sensor, count(*) AS n FROM events GROUP BY ALL")
def exam_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "exams")
    df = samples(spark, sf_dir).select(c("user_id").cast("string").alias("exam"), c("event_type").alias("sensor"), F.lit("x").alias("signal"), c("event_id").cast("double").alias("local_time"), "value", F.lit("free").alias("annotation"))
    for _ in range(2):
        sinks.exam_table(df, path)
    return spark.read.parquet(path).groupBy("exam", "sensor").agg(F.count("*").alias("n"))


_EVENTS = "event_id long, user_id long, event_type string, ts timestamp, value double"


def _stream_source(spark: SparkSession, sf_dir: str, parts: int) -> tuple[str, list[DataFrame]]:
    df = samples(spark, sf_dir).withColumn("ts", c("ts").cast("timestamp"))
    h = F.pmod(F.xxhash64("event_id"), F.lit(parts))
    return scratch(spark, "stream"), [df.where(h == i) for i in range(parts)]


@query("SELECT event_id, value FROM events")
def stream_of_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in two lots are each processed once by two runs of one stream."""
    path, parts = _stream_source(spark, sf_dir, 2)
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        incremental.run_available(incremental.files(spark, f"{path}/in", _EVENTS), f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select("event_id", "value")


@query("""
WITH w AS (SELECT event_type, floor(epoch_us(ts) / 3600000000)::BIGINT AS hour, value FROM events), t AS (SELECT max(epoch_us(ts)) - 1000000 AS mark FROM events)
SELECT event_type, hour, count(*) AS n, round(avg(value), 8) AS mean FROM w, t WHERE (hour + 1) * 3600000000 <= mark GROUP BY ALL""")
def stream_of_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows that the watermark has closed."""
    path, (part,) = _stream_source(spark, sf_dir, 1)
    part.write.parquet(f"{path}/in")
    df = incremental.windowed(incremental.files(spark, f"{path}/in", _EVENTS), ["event_type"], "ts", "value", "1 hour")
    incremental.run_available(df, f"{path}/out", f"{path}/checkpoint")
    hour = F.floor(F.unix_micros("w_start") / 3_600_000_000)
    return spark.read.parquet(f"{path}/out").select("event_type", hour.alias("hour"), "n", F.round("mean", 8).alias("mean"))


@query("""
WITH s AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1e6 AS d FROM events) SELECT user_id, count(*) AS n, round(sum(d), 3) AS gap_s FROM s WHERE d > 40000 GROUP BY user_id""")
def stream_of_gap_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pauses of over 40,000 seconds, found with state."""
    path, (part,) = _stream_source(spark, sf_dir, 1)
    part.write.parquet(f"{path}/in")
    df = incremental.gap_alarms(incremental.files(spark, f"{path}/in", _EVENTS), "user_id", "ts", 40_000)
    incremental.run_available(df, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("gap_s"), 3).alias("gap_s"))


@query("SELECT user_id, min(event_id) IS NOT NULL AS seen FROM events GROUP BY user_id")
def stream_once_per_exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each exam within the watermark's reach (which holds all here)."""
    path, (part,) = _stream_source(spark, sf_dir, 1)
    part.write.parquet(f"{path}/in")
    df = incremental.once_per_exam(incremental.files(spark, f"{path}/in", _EVENTS), "user_id", "ts", "400 days")
    incremental.run_available(df, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select("user_id", c("event_id").isNotNull().alias("seen"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'click' THEN value + 1000 ELSE value END AS value, CASE WHEN event_type = 'click' THEN 2 ELSE 1 END AS run FROM events
UNION ALL SELECT -event_id, strftime(ts, '%Y-%m-%d'), value, 2 FROM events WHERE event_type = 'view'""")
def replaced_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table by day, in which a second write replaces the clicks and adds a row for each view."""
    path = scratch(spark, "replaced")
    df = samples(spark, sf_dir).select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value", F.lit(1).alias("run"), "event_type")
    tables.replace(df.drop("event_type"), path, ["event_id"], "day")
    clicks = df.where("event_type = 'click'").withColumn("value", c("value") + 1000)
    views = df.where("event_type = 'view'").withColumn("event_id", -c("event_id"))
    tables.replace(clicks.unionByName(views).withColumn("run", F.lit(2)).drop("event_type"), path, ["event_id"], "day")
    return tables.read(spark, path)


@query("""
WITH e AS (SELECT c_mktsegment AS project, o_custkey AS patient, o_orderpriority AS device, sha256(o_orderkey::VARCHAR) AS sha256, CASE WHEN o_orderkey % 3 = 0 THEN 'parsed' WHEN o_orderkey % 3 = 1 THEN 'pending' ELSE 'failed' END AS parse_status
           FROM orders JOIN customer ON c_custkey = o_custkey),
p AS (SELECT *, dense_rank() OVER (ORDER BY project) AS project_id FROM e)
SELECT dense_rank() OVER (ORDER BY sha256) AS recording_id, dense_rank() OVER (ORDER BY project_id, patient) AS participant_id, dense_rank() OVER (ORDER BY device) AS device_id, sha256, parse_status, 'RECEIVED' AS status FROM p""")
def registered_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as recordings of their customers' segments: registered as pending, then with their status, then as duplicates."""
    path = scratch(spark, "registered")
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), c("c_custkey") == c("o_custkey"))
    rest = c("o_orderkey") % 3
    status = F.when(rest == 0, "parsed").when(rest == 1, F.lit(None)).otherwise("failed")
    rows = o.select(c("c_mktsegment").alias("project"), c("o_custkey").alias("patient"), c("o_orderpriority").alias("device"), F.sha2(c("o_orderkey").cast("string"), 256).alias("sha256"), status.alias("parse_status"))
    sinks.register(rows.withColumn("parse_status", F.lit("pending")), path)
    sinks.register(rows, path)
    return sinks.register(rows.withColumn("parse_status", F.lit("duplicate")), path)


@query("""
WITH r AS (SELECT user_id, epoch_us(ts) AS us, sha256(concat_ws('|', event_type, value::VARCHAR)) AS h FROM events),
g AS (SELECT user_id, us // 3600000000 AS hour, sha256(string_agg(h, '' ORDER BY us, h)) AS h FROM r GROUP BY ALL)
SELECT user_id, sha256(string_agg(h, '' ORDER BY hour, h)) AS sha256 FROM g GROUP BY user_id""")
def hashes_of_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.content_hashes(samples(spark, sf_dir), "user_id", "ts", ["event_type", "value"])


_RECORDINGS = """
WITH t AS (SELECT user_id, epoch_us(ts) AS us FROM events), w AS (SELECT (max(us) // 1000 - 1000) * 1000 AS mark FROM t),
l AS (SELECT user_id, max(us) AS last, count(*) AS n FROM t GROUP BY user_id), s AS (SELECT user_id, us, lag(us) OVER (PARTITION BY user_id ORDER BY us) AS before FROM t)"""


@query(f"""{_RECORDINGS}
SELECT user_id, 'gap' AS kind, count(*) AS n, round(sum((us - before) / 1e6), 3) AS gap_s FROM s WHERE us - before > 40000000000 GROUP BY user_id
UNION ALL SELECT user_id, 'ended', 1, NULL FROM l, w WHERE ceil(last / 1000)::BIGINT + 21600000 <= mark // 1000""")
def stream_of_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pauses of over 40,000 seconds, and recordings that had ended six hours before the last sample of all."""
    path, (part,) = _stream_source(spark, sf_dir, 1)
    part.write.parquet(f"{path}/in")
    df = incremental.recordings(incremental.files(spark, f"{path}/in", _EVENTS), "user_id", "ts", 40_000, 21_600)
    incremental.run_available(df, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").groupBy("user_id", "kind").agg(F.count("*").alias("n"), F.round(F.sum("gap_s"), 3).alias("gap_s"))


@query(f"{_RECORDINGS} SELECT user_id, last, n FROM l, w WHERE ceil(last / 1000)::BIGINT + 21600000 > mark // 1000")
def states_of_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that is left: that of recordings that haven't ended."""
    path, (part,) = _stream_source(spark, sf_dir, 1)
    part.write.parquet(f"{path}/in")
    df = incremental.recordings(incremental.files(spark, f"{path}/in", _EVENTS), "user_id", "ts", 40_000, 21_600)
    incremental.run_available(df, f"{path}/out", f"{path}/checkpoint")
    return incremental.states(spark, f"{path}/checkpoint").withColumnRenamed("key", "user_id")


@query("""
WITH n AS (SELECT count(DISTINCT user_id) AS all_units, count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS first FROM events)
SELECT event_id, user_id, event_type, value, first, all_units - first AS later, first AS skipped FROM events, n""")
def exported_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with errors exported first, then all: the second export leaves the first one's files alone. All are read back."""
    path = scratch(spark, "export")
    df = samples(spark, sf_dir).select("event_id", "event_type", "value", "user_id")
    with_errors = df.join(df.where("event_type = 'error'").select("user_id").distinct(), "user_id", "left_semi")
    first, _ = sinks.csv_exports(with_errors, path, ["user_id"])
    later, skipped = sinks.csv_exports(df, path, ["user_id"])
    got = spark.read.csv(f"{path}/csv", header=True, schema="event_id long, event_type string, value double, user_id long")
    return got.select("event_id", "user_id", "event_type", "value", F.lit(first).alias("first"), F.lit(later).alias("later"), F.lit(skipped).alias("skipped"))
