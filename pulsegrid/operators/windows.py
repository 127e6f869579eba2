"""Analysis windows, events and features per patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.timeseries import seconds, series


def windowize(df: DataFrame, keys: list[str], ts: str, value: str, valid: Column, window_s: float, by: list[str] | None = None) -> DataFrame:
    """Median of valid samples and their number per key and window; windows count from the first sample of ``by``.

    The origin is one per patient, so that devices share a grid.
    """
    by = by or keys
    origin = df.groupBy(*by).agg(F.min(seconds(F.col(ts))).alias("__t0"))
    rows = df.join(origin, by).withColumn("window", F.floor((seconds(F.col(ts)) - F.col("__t0")) / window_s))
    return rows.groupBy(*keys, "window").agg(F.median(F.when(valid, F.col(value))).alias("value"), F.count(F.when(valid, F.col(value))).alias("n_valid"))


def full_grid(windows: DataFrame, key: str, label: str, labels: list[str]) -> DataFrame:
    """One row per window of a patient from its first to its last, one column per label; empty windows are rows of nulls."""
    ends = windows.groupBy(key).agg(F.min("window").alias("a"), F.max("window").alias("b"))
    spine = ends.select(key, F.explode(F.sequence("a", "b")).alias("window"))
    wide = windows.groupBy(key, "window").pivot(label, labels).agg(F.first("value"))
    return spine.join(wide, [key, "window"], "left")


def unique_labels(df: DataFrame, label: str, device: str, scope: list[str]) -> Column:
    """Labels that several devices of a scope have get the device as suffix."""
    w = Window.partitionBy(*scope, label)
    several = F.min(device).over(w) != F.max(device).over(w)
    return F.when(several, F.concat_ws("__", label, device)).otherwise(F.col(label))


def empty_stretches(grid: DataFrame, key: str, columns: list[str], window_s: float, least_s: float) -> DataFrame:
    """Runs of windows without any value that last ``least_s`` at least, also at the end: key, first, last, n."""
    w = Window.partitionBy(key).orderBy("window")
    rows = grid.withColumn("empty", F.coalesce(*[F.col(c) for c in columns]).isNull())
    rows = rows.withColumn("run", F.sum(F.when(F.col("empty").eqNullSafe(F.lag("empty").over(w)), 0).otherwise(1)).over(w))
    runs = rows.where("empty").groupBy(key, "run").agg(F.min("window").alias("first"), F.max("window").alias("last"), F.count("*").alias("n"))
    return runs.where(F.col("n") * window_s >= least_s).drop("run")


def dose_steps(df: DataFrame, keys: list[str], order: str, value: str, share: float = 0.25, hold: int = 3) -> DataFrame:
    """The first step per series of more than ``share`` of its median non-zero level that lasts ``hold`` windows."""
    w = series(keys, order)
    level = F.median(F.when(F.col(value) > 0, F.col(value))).over(Window.partitionBy(*keys))
    before = F.lag(value).over(w)
    limit = F.col("__level") * share
    rows = df.withColumn("__level", level).withColumn("step", F.col(value) - before)
    held = F.abs(F.col("step")) > limit
    for k in range(1, hold):
        held = held & (F.abs(F.lead(value, k).over(w) - before) > limit)
    rows = rows.withColumn("__held", F.coalesce(held, F.lit(False))).where("__held")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) == 1
    return rows.withColumn("__first", first).where("__first").drop("__level", "__held", "__first")


def event_response(events: DataFrame, samples: DataFrame, key: str, event_id: str, at: str, time: str, value: str, span: float, lowest: Column) -> DataFrame:
    """Response of a value to each event: baseline median of [t - span, t), peak of (t, t + span] and their difference.

    The peak is the minimum where ``lowest`` (a condition on the event) holds, else the maximum. Both sides meet by key
    and coarse time bin, so that an event sees only samples of its own bins.
    """
    bins = events.withColumn("__bin", F.explode(F.sequence(F.floor((F.col(at) - span) / span), F.floor((F.col(at) + span) / span))))
    own = samples.select(F.col(key).alias("__key"), F.col(time).alias("__t"), F.col(value).alias("__v"), F.floor(F.col(time) / span).alias("__tbin"))
    pairs = bins.join(own, (F.col(key) == F.col("__key")) & (F.col("__bin") == F.col("__tbin")), "left")
    t = F.col("__t") - F.col(at)
    before = F.when((t >= -span) & (t < 0), F.col("__v"))
    after = F.when((t > 0) & (t <= span), F.col("__v"))
    out = pairs.withColumn("__lowest", lowest).groupBy(key, event_id, "__lowest").agg(
        F.median(before).alias("baseline"), F.min(after).alias("__low"), F.max(after).alias("__high")
    )
    out = out.withColumn("peak", F.when(F.col("__lowest"), F.col("__low")).otherwise(F.col("__high")))
    return out.withColumn("delta", F.col("peak") - F.col("baseline")).drop("__lowest", "__low", "__high")


def segment_votes(segments: DataFrame, windows: DataFrame, key: str, width: float) -> DataFrame:
    """Label of each window by the labelled time that overlaps it; a tie is an artifact, windows without overlap go.

    segments: key, start_s, end_s, label; windows: key, w_start, w_end. Both sides meet by key and time bin.
    """
    s = segments.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("start_s") / width), F.floor(F.col("end_s") / width))))
    w = windows.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("w_start") / width), F.floor(F.col("w_end") / width))))
    low = F.greatest(F.col("start_s"), F.col("w_start"), F.col("__bin") * width)
    high = F.least(F.col("end_s"), F.col("w_end"), (F.col("__bin") + 1) * width)
    pairs = w.join(s, [key, "__bin"]).withColumn("__overlap", high - low).where("__overlap > 0")
    out = pairs.groupBy(key, "w_start", "w_end").agg(
        F.sum(F.when(F.col("label") == 1, F.col("__overlap")).otherwise(0.0)).alias("artifact_s"),
        F.sum(F.when(F.col("label") == 0, F.col("__overlap")).otherwise(0.0)).alias("clean_s"),
    )
    return out.withColumn("label", (F.col("artifact_s") >= F.col("clean_s")).cast("int"))


def patient_features(df: DataFrame, keys: list[str], order: str, value: str, window_s: float, threshold: float, zero_missing: bool = True) -> DataFrame:
    """Mean, population deviation, valid share, area under the curve, share over a threshold, total, largest change.

    The area and the total count missing windows as 0 unless ``zero_missing`` is off.
    """
    w = series(keys, order)
    x = F.coalesce(F.col(value), F.lit(0.0)) if zero_missing else F.col(value)
    rows = df.withColumn("__x", x).withColumn("__trap", (F.col("__x") + F.lag("__x").over(w)) / 2 * window_s)
    rows = rows.withColumn("__change", F.abs(F.col(value) - F.lag(value).over(w)))
    return rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("sd"),
        (F.count(value) / F.count("*") * 100).alias("valid_pct"),
        F.coalesce(F.sum("__trap"), F.lit(0.0)).alias("auc"),
        (F.avg(F.when(F.col(value).isNotNull(), (F.col(value) > threshold).cast("double"))) * 100).alias("over_pct"),
        (F.sum("__x") * window_s).alias("total"),
        F.max("__change").alias("max_change"),
    )


def fuller_column(df: DataFrame, keys: list[str], column: str, value: str) -> DataFrame:
    """Of columns with one label per device the one with most values stays (the first name of equals)."""
    best = df.groupBy(*keys, column).agg(F.count(value).alias("n")).where("n > 0")
    best = best.groupBy(*keys).agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias("__best"))
    return df.join(best, keys).where(F.col(column) == F.col("__best")).drop("__best")


def sliding_features(df: DataFrame, keys: list[str], order: str, value: str, size: int = 100, stride: int = 50, least: int = 10) -> DataFrame:
    """Eight statistics of overlapping windows of ``size`` rows every ``stride``; the last full window counts.

    Means add values in the order of the rows, so that one near a threshold doesn't depend on how rows were dealt.
    """
    rows = df.withColumn("__i", F.row_number().over(series(keys, order)) - 1)
    rows = rows.withColumn("__d", F.abs(F.col(value) - F.lag(value).over(series(keys, order))))
    n = F.count("*").over(Window.partitionBy(*keys))
    rows = rows.withColumn("__n", n)
    first = F.greatest(F.ceil((F.col("__i") - size + 1) / stride), F.lit(0))
    last = F.least(F.floor(F.col("__i") / stride), F.floor((F.col("__n") - size) / stride))
    rows = rows.where(first <= last).withColumn("window", F.explode(F.sequence(first, last)))
    # A change counts in a window that holds both its samples.
    change = F.when(F.col("__i") > F.col("window") * stride, F.col("__d"))
    ordered = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("__i", F.col(value).cast("double").alias("v")))))
    total = F.aggregate(ordered, F.lit(0.0), lambda a, x: a + x["v"])
    out = rows.groupBy(*keys, "window").agg(
        F.count(value).alias("n"),
        (total / F.nullif(F.count(value), F.lit(0))).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.max(value) - F.min(value)).alias("range"),
        F.median(value).alias("median"),
        F.max(change).alias("max_change"),
        F.countDistinct(F.round(value, 2)).alias("n_unique"),
    )
    return out.where(F.col("n") >= least)


def trend_features(df: DataFrame, keys: list[str], value: str, index: str, jump: float) -> DataFrame:
    """Mean, sd, extremes, slope over the index, median absolute deviation, missing share and jumps per window."""
    middle = df.groupBy(*keys).agg(F.median(value).alias("__mid"))
    rows = df.join(middle, keys).withColumn("__dev", F.abs(F.col(value) - F.col("__mid")))
    rows = rows.withColumn("__jump", F.abs(F.col(value) - F.lag(value).over(series(keys, index))) > jump)
    return rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.regr_slope(F.col(value), F.col(index).cast("double")).alias("slope"),
        F.median("__dev").alias("mad"),
        (1 - F.count(value) / F.count("*")).alias("missing"),
        F.count_if("__jump").alias("n_jumps"),
    )
