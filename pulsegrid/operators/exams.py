"""Exams: checks against their footers, features by signal, feeds and what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.stats import suppressed
from pulsegrid.operators.timeseries import seconds

#: What a footer must hold.
FOOTER = ("exam_start_time", "exam_stop_time", "ett_version", "sampling_frequency", "signal_type")
SENTINEL = -32768.0


def without_sentinels(df: DataFrame, sensor: str, value: str, sensors: tuple[str, ...] = ("draeger",)) -> DataFrame:
    """Column ``was_sentinel``, and the value as null where it is: the sentinel counts for some sensors only."""
    hit = F.coalesce(F.lower(sensor).isin(*sensors) & (F.col(value) == SENTINEL), F.lit(False))
    return df.withColumn("was_sentinel", hit).withColumn(value, F.when(~F.col("was_sentinel"), F.col(value)))


def sentinel_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if("was_sentinel").alias("n_sentinel"), F.count("*").alias("n"))


def exam_checks(samples: DataFrame, footers: DataFrame, key: str, order: str, time: str, known_columns: list[str], most_off_s: float = 5.0) -> DataFrame:
    """One row per exam and check: identity_present, footer_complete, has_rows, time_sorted, duration_matches_footer,
    schema_drift, sentinels_nulled; result and detail.

    ``footers`` has a row per exam: key, exam_guid, session_guid, the FOOTER columns, recording_duration, columns (array).
    ``samples`` has was_sentinel. Rows stand in ``order``; ``time`` must not fall along it.
    """
    from pulsegrid.operators.timeseries import series

    t = samples.withColumn("__back", F.col(time) < F.lag(time).over(series([key], order)))
    a = t.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if("__back").alias("n_back"), (seconds(F.max(time)) - seconds(F.min(time))).alias("duration"), F.count_if("was_sentinel").alias("n_sentinel")
    )
    rows = footers.join(a, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    c = F.col
    missing = F.array_compact(F.array(*[F.when(c(f).isNull(), F.lit(f)) for f in FOOTER]))
    unexpected = F.array_sort(F.array_except(c("columns"), F.array(*[F.lit(x) for x in known_columns])))
    off = F.abs(c("duration") - c("recording_duration"))
    named = lambda name, result, detail: F.struct(F.lit(name).alias("check"), result.alias("result"), F.coalesce(detail, F.lit("")).alias("detail"))
    ok = lambda cond, other: F.when(cond, "PASS").otherwise(other)
    checks = F.array_compact(F.array(
        named("identity_present", ok(c("exam_guid").isNotNull() & c("session_guid").isNotNull(), "FAIL"), F.lit("")),
        named("footer_complete", ok(F.size(missing) == 0, "WARNING"), F.array_join(missing, ",")),
        F.when(c("n") == 0, named("has_rows", F.lit("FAIL"), F.lit(""))).otherwise(named("time_sorted", ok(c("n_back") == 0, "FAIL"), F.lit(""))),
        F.when(off.isNotNull(), named("duration_matches_footer", ok(off <= most_off_s, "WARNING"), F.lit(""))),
        named("schema_drift", ok(F.size(unexpected) == 0, "WARNING"), F.array_join(unexpected, ",")),
        named("sentinels_nulled", F.lit("PASS"), F.coalesce(c("n_sentinel"), F.lit(0)).cast("string")),
    ))
    return rows.select(key, F.explode(checks).alias("c")).select(key, "c.*")


def exam_verdict(checks: DataFrame, key: str) -> DataFrame:
    """FAIL before WARNING before PASS."""
    n = lambda r: F.count_if(F.col("result") == r)
    return checks.groupBy(key).agg(F.when(n("FAIL") > 0, "FAIL").when(n("WARNING") > 0, "WARNING").otherwise("PASS").alias("verdict"), F.count("*").alias("n_checks"))


def exam_features(samples: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Per exam and signal: n, n_null, mean, sd, min, max and duration in seconds."""
    return samples.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(F.col(value).isNull()).alias("n_null"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.min(value).alias("min"), F.max(value).alias("max"),
        (seconds(F.max(time)) - seconds(F.min(time))).alias("duration_s"),
    )


def state_feed(features: DataFrame, signal: str, exam: str, k: int = 5) -> DataFrame:
    """Per signal exams, hours and null share; all null for signals of fewer than ``k`` exams."""
    out = features.groupBy(signal).agg(
        F.countDistinct(exam).alias("n"), (F.sum("duration_s") / 3600).alias("hours"), (F.sum("n_null") / F.sum("n")).alias("null_share")
    )
    shown = F.col("n") >= k
    return out.select(signal, suppressed(F.col("n"), k).alias("n_exams"), *[F.when(shown, F.col(x)).alias(x) for x in ("hours", "null_share")])


def new_by_hash(incoming: DataFrame, mirrored: DataFrame, content_hash: str, order: str) -> DataFrame:
    """Exams whose hash the mirror doesn't hold, once each: of equal ones the first by ``order``."""
    new = incoming.join(mirrored.select(content_hash).distinct(), content_hash, "left_anti")
    first = new.groupBy(content_hash).agg(F.min(F.struct(order)).alias("__first"))
    return new.join(first, content_hash).where(F.col(order).eqNullSafe(F.col(f"__first.{order}"))).drop("__first").dropDuplicates([content_hash])


def project_by_prefix(path: Column, prefixes: list[tuple[str, str]]) -> Column:
    """The project of the longest prefix (of whole segments) that a path has; null: unmapped, to be quarantined."""
    out = F.lit(None).cast("string")
    for prefix, project in sorted(prefixes, key=lambda p: len(p[0])):
        p = prefix.strip("/")
        out = F.when((path == p) | path.startswith(p + "/"), project).otherwise(out)
    return out
