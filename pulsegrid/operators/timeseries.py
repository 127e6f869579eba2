"""Ordered operators per recording and variable: runs, moving statistics, time bases.

All take the keys of a series, its order column and its value column. Moving statistics use row frames, so partitions by
key are sorted once and every operator that follows reuses them. Where recordings are too long to be sorted by one task
each, ``size`` makes an operator work on stretches of so many rows (see ``scans``), with the same result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.columns import micros
from pulsegrid.operators import scans
from pulsegrid.operators.scans import in_stretches


def seconds(ts: Column) -> Column:
    return micros(ts) / 1e6


def step_s(ts: str, w) -> Column:
    """Seconds since the row before, exact to the microsecond."""
    return (micros(F.col(ts)) - F.lag(micros(F.col(ts))).over(w)) / 1e6


def series(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def centred(keys: list[str], order: str, n: int):
    """The frame of a centred rolling window of n rows; of an even n the later half is the shorter."""
    off = (n - 1) // 2
    return series(keys, order).rowsBetween(off - n + 1, off)


def run_id(changed: Column, keys: list[str], order: str) -> Column:
    """Number of the run that a row is in; a run begins where ``changed`` holds."""
    return F.sum(F.when(changed, 1).otherwise(0)).over(series(keys, order))


def runs_of(df: DataFrame, keys: list[str], order: str, flag: Column, size: int | None = None) -> DataFrame:
    """Maximal runs of rows on which ``flag`` is equal: keys, flag, first and last order value, n rows."""
    rows = df.withColumn("flag", flag)
    if size is None:
        previous = F.lag("flag").over(series(keys, order))
        rows = rows.withColumn("run", run_id(~F.col("flag").eqNullSafe(previous), keys, order))
    else:
        rows = scans.with_changes(rows, keys, order, lambda before: ~F.col("flag").eqNullSafe(before("flag")), size).withColumnRenamed("__run", "run")
    return rows.groupBy(*keys, "run", "flag").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


@in_stretches(lambda least: (least, least))
def flag_long_runs(df: DataFrame, keys: list[str], order: str, flag: Column, least: int, name: str) -> DataFrame:
    """``name`` is true on rows of runs of at least ``least`` rows on which ``flag`` holds."""
    rows = df.withColumn("__flag", F.coalesce(flag, F.lit(False)))
    changed = ~F.col("__flag").eqNullSafe(F.lag("__flag").over(series(keys, order)))
    rows = rows.withColumn("__run", run_id(changed, keys, order))
    long = F.count("*").over(Window.partitionBy(*keys, "__run")) >= least
    return rows.withColumn(name, F.col("__flag") & long).drop("__flag", "__run")


def saturation(df: DataFrame, keys: list[str], order: str, value: str, least: int = 5, size: int | None = None) -> DataFrame:
    """Runs of at least ``least`` samples at the series' minimum or maximum, as column ``saturated``."""
    if size is None:
        whole = Window.partitionBy(*keys)
        low, high = F.min(value).over(whole), F.max(value).over(whole)
        rows = df.withColumn("__at", F.when((F.col(value) == low) | (F.col(value) == high), F.col(value)))
    else:
        ends = df.groupBy(*keys).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
        at = (F.col(value) == F.col("__low")) | (F.col(value) == F.col("__high"))
        rows = scans.join_on(df, ends, keys).withColumn("__at", F.when(at, F.col(value))).drop("__low", "__high")
    return _held_at(rows, keys, order, least, size=size)


@in_stretches(lambda least: (least, least))
def _held_at(rows: DataFrame, keys: list[str], order: str, least: int) -> DataFrame:
    rows = rows.withColumn("__run", run_id(~F.col("__at").eqNullSafe(F.lag("__at").over(series(keys, order))), keys, order))
    n = F.count("*").over(Window.partitionBy(*keys, "__run"))
    return rows.withColumn("saturated", F.col("__at").isNotNull() & (n >= least)).drop("__at", "__run")


def longest_unchanged(df: DataFrame, keys: list[str], order: str, value: str, size: int | None = None) -> DataFrame:
    """Per series the longest run of equal non-null samples, counted in repeats of the first."""
    rows = df.where(F.col(value).isNotNull())
    if size is None:
        previous = F.lag(value).over(series(keys, order))
        rows = rows.withColumn("__run", run_id(previous.isNull() | (F.col(value) != previous), keys, order))
    else:
        rows = scans.with_changes(rows, keys, order, lambda before: before(value).isNull() | (F.col(value) != before(value)), size)
    runs = rows.groupBy(*keys, "__run").agg((F.count("*") - 1).alias("n"))
    return runs.groupBy(*keys).agg(F.max("n").alias("longest"))


def held_channel(df: DataFrame, keys: list[str], order: str, value: str, interval_s: float, limit_s: float) -> DataFrame:
    """How long a channel holds its value: the median gap between changes, in samples times the interval.

    Fewer than three changes is an error, a longer hold than the limit a warning.
    """
    w = series(keys, order)
    rows = df.where(F.col(value).isNotNull()).withColumn("__pos", F.row_number().over(w))
    previous = F.lag(value).over(w)
    rows = rows.withColumn("__changed", previous.isNull() | (F.col(value) != previous))
    changes = rows.where("__changed").withColumn("__gap", F.col("__pos") - F.lag("__pos").over(Window.partitionBy(*keys).orderBy("__pos")))
    out = changes.groupBy(*keys).agg(F.count("*").alias("n_changes"), (F.median("__gap") * interval_s).alias("hold_s"))
    status = F.when(F.col("n_changes") < 3, "ERROR").when(F.col("hold_s") > limit_s, "WARNING").otherwise("OK")
    return out.withColumn("status", status)


@in_stretches(lambda window: (max(window, 3), max(window, 3)))
def flatline(df: DataFrame, keys: list[str], order: str, value: str, window: int, eps: float = 1e-12) -> DataFrame:
    """Column ``flatline``: the variance of a full centred window is under ``eps``."""
    n = max(window, 3)
    w = centred(keys, order, n)
    return df.withColumn("flatline", F.coalesce((F.count(value).over(w) == n) & (F.var_samp(value).over(w) < eps), F.lit(False)))


def _median_over(value: str | Column, w) -> Column:
    return F.percentile(value, F.lit(0.5)).over(w)


@in_stretches(lambda window: (2 * window, 2 * window))
def mad_score(df: DataFrame, keys: list[str], order: str, value: str, window: int, full: bool = True) -> DataFrame:
    """Columns local_median and mad of centred windows; with ``full`` both need full windows."""
    w = centred(keys, order, window)
    guard = lambda c, x: F.when(F.count(c).over(w) == window, x) if full else x
    rows = df.withColumn("local_median", guard(value, _median_over(value, w)))
    rows = rows.withColumn("__dev", F.abs(F.col(value) - F.col("local_median")))
    return rows.withColumn("mad", guard("__dev", _median_over("__dev", w)))


@in_stretches(lambda window: (2 * window, 2 * window))
def spikes(df: DataFrame, keys: list[str], order: str, value: str, window: int, n_sigma: float = 5.0) -> DataFrame:
    """Column ``spike``: further from the local median than ``n_sigma`` scaled deviations; a zero deviation never hits."""
    rows = mad_score(df, keys, order, value, window)
    z = F.col("__dev") / (F.lit(1.4826) * F.nullif(F.col("mad"), F.lit(0.0)))
    return rows.withColumn("spike", F.coalesce(z > n_sigma, F.lit(False))).drop("__dev", "local_median", "mad")


@in_stretches(lambda window: (2 * window, 2 * window))
def robust_smooth(df: DataFrame, keys: list[str], order: str, value: str, window: int, n_sigma: float = 3.0) -> DataFrame:
    """Column ``smoothed``: outliers replaced by the local median; windows may be partial, deviations are 1e-9 at least."""
    rows = mad_score(df, keys, order, value, window, full=False)
    z = F.col("__dev") / (F.lit(1.4826) * F.greatest(F.col("mad"), F.lit(1e-9)))
    return rows.withColumn("smoothed", F.when(z > n_sigma, F.col("local_median")).otherwise(F.col(value))).drop("__dev", "local_median", "mad")


def ontology_scalar(df: DataFrame, keys: list[str], order: str, value: str, window: int = 10, jump: float = 0.5) -> DataFrame:
    """Column ``qc``: MISSING, FLATLINE (trailing window of equal samples) or SPIKE (jump against the series' median).

    Statistics are over non-null samples; a flat line outranks a spike.
    """
    rows = df.where(F.col(value).isNotNull())
    w = series(keys, order)
    back = w.rowsBetween(-(window - 1), 0)
    middle = F.abs(F.median(value).over(Window.partitionBy(*keys)))
    flat = (F.count(value).over(back) == window) & (F.stddev_samp(value).over(back) == 0)
    spike = F.abs(F.col(value) - F.lag(value).over(w)) / F.nullif(middle, F.lit(0.0)) > jump
    rows = rows.withColumn("qc", F.when(flat, "FLATLINE").when(spike, "SPIKE").otherwise("VALID"))
    return rows.unionByName(df.where(F.col(value).isNull()).withColumn("qc", F.lit("MISSING")))


@in_stretches(lambda: (1, 0))
def counter(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Columns increment and qc of a counter: a fall is SUSPICIOUS (a reset), a negative value INVALID."""
    rows = df.withColumn("increment", F.col(value) - F.lag(value).over(series(keys, order)))
    qc = F.when(F.col(value).isNull(), "MISSING").when(F.col(value) < 0, "INVALID").when(F.col("increment") < 0, "SUSPICIOUS")
    return rows.withColumn("qc", qc.otherwise("VALID"))


@in_stretches(lambda: (1, 0))
def step_rule(df: DataFrame, keys: list[str], order: str, value: str, most: float, zero_is_artifact: bool = False) -> DataFrame:
    """Column ``step``: the change from the sample before is over ``most``, or the value is 0 where that is no reading."""
    hit = F.abs(F.col(value) - F.lag(value).over(series(keys, order))) > most
    hit = hit | (F.col(value) == 0) if zero_is_artifact else hit
    return df.withColumn("step", F.coalesce(hit, F.lit(False)))


@in_stretches(lambda window: (window, window))
def ratio_rule(df: DataFrame, keys: list[str], order: str, value: str, window: int, high: float = 1.8, low: float = 0.55) -> DataFrame:
    """Column ``off_ratio``: the ratio to the centred median is outside low to high."""
    ratio = F.col(value) / F.nullif(_median_over(value, centred(keys, order, window)), F.lit(0.0))
    return df.withColumn("off_ratio", F.coalesce((ratio > high) | (ratio < low), F.lit(False)))


@in_stretches(lambda span: (2 * span, 2 * span))
def drop_rule(df: DataFrame, keys: list[str], order: str, value: str, span: int, most: float = 2.0) -> DataFrame:
    """Column ``in_drop``: the rows of every span over which the value falls by more than ``most``, all of them."""
    w = series(keys, order)
    rows = df.withColumn("__hit", F.coalesce((F.lag(value, span).over(w) - F.col(value) > most).cast("int"), F.lit(0)))
    return rows.withColumn("in_drop", F.max("__hit").over(w.rowsBetween(0, span)) == 1).drop("__hit")


@in_stretches(lambda before, after: (after, before))
def expand(df: DataFrame, keys: list[str], order: str, flag: str, before: int = 10, after: int = 10) -> DataFrame:
    """Column ``near``: within ``before`` rows before or ``after`` rows after a flagged one."""
    w = series(keys, order).rowsBetween(-after, before)
    return df.withColumn("near", F.max(F.col(flag).cast("int")).over(w) == 1)


def gap_segments(df: DataFrame, keys: list[str], ts: str, value: str, max_gap_s: float, size: int | None = None) -> DataFrame:
    """Column ``segment``: number of the stretch of valid samples without a pause of more than ``max_gap_s``."""
    rows = df.where(F.col(value).isNotNull())
    if size is not None:
        at = rows.withColumn("__us", micros(F.col(ts)))
        rows = scans.with_changes(at, keys, ts, lambda before: (F.col("__us") - before("__us")) / 1e6 > max_gap_s, size)
        return rows.withColumnRenamed("__run", "segment").drop("__us", "__changed", "__i", "__stretch")
    gap = step_s(ts, series(keys, ts))
    return rows.withColumn("segment", run_id(F.coalesce(gap > max_gap_s, F.lit(False)), keys, ts))


def describe_recording(df: DataFrame, keys: list[str], ts: str, variable: str | None = None) -> DataFrame:
    """Per recording: n_rows, t_start, t_end, duration_s, median_dt_s, fs_hz and, if given, the sorted variables."""
    rows = df.withColumn("__dt", step_s(ts, series(keys, ts)))
    aggregates = [
        F.count("*").alias("n_rows"),
        F.min(ts).alias("t_start"),
        F.max(ts).alias("t_end"),
        F.median("__dt").alias("median_dt_s"),
    ]
    if variable:
        aggregates.append(F.array_sort(F.collect_set(variable)).alias("variables"))
    out = rows.groupBy(*keys).agg(*aggregates)
    out = out.withColumn("duration_s", seconds(F.col("t_end")) - seconds(F.col("t_start")))
    return out.withColumn("fs_hz", F.when(F.col("median_dt_s") > 0, 1 / F.col("median_dt_s")))


def rates(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Sampling from positive steps only: median, least and greatest step and the estimated rate."""
    rows = df.withColumn("__dt", step_s(ts, series(keys, ts))).where("__dt > 0")
    out = rows.groupBy(*keys).agg(F.median("__dt").alias("median_s"), F.min("__dt").alias("min_s"), F.max("__dt").alias("max_s"))
    return out.withColumn("estimated_hz", 1 / F.col("median_s"))


def time_base(df: DataFrame, keys: list[str], position: str, ts: str) -> DataFrame:
    """Rate, irregularity, disorder and gaps of time stamps in their order of arrival.

    Steps count as irregular if off the median by more than half of it, as gaps if over ten times it.
    """
    step = step_s(ts, series(keys, position))
    rows = df.select(*keys, step.alias("dt")).where("dt is not null")
    middle = rows.where("dt > 0").groupBy(*keys).agg(F.median("dt").alias("med"))
    rows = rows.join(middle, keys)
    share = lambda c: F.avg(c.cast("int"))
    return rows.groupBy(*keys).agg(
        F.first("med").alias("median_s"),
        (1 / F.first("med")).alias("nominal_hz"),
        share(F.abs(F.col("dt") - F.col("med")) > 0.5 * F.col("med")).alias("irregular"),
        share(F.col("dt") <= 0).alias("disorder"),
        share(F.col("dt") > 10 * F.col("med")).alias("gap_fraction"),
        F.coalesce(F.sum(F.when(F.col("dt") > 10 * F.col("med"), F.col("dt"))), F.lit(0.0)).alias("gap_s"),
    )


def gap_check(df: DataFrame, keys: list[str], ts: str, limit_s: float) -> DataFrame:
    """Per recording the worst step between time stamps and how many are over the limit."""
    rows = df.withColumn("__dt", step_s(ts, series(keys, ts)))
    return rows.groupBy(*keys).agg(F.max("__dt").alias("worst_gap_s"), F.count_if(F.col("__dt") > limit_s).alias("n_gaps"))


def missingness(df: DataFrame, keys: list[str], order: str, value: str, size: int | None = None) -> DataFrame:
    """Share of nulls, longest run of them and the kind: complete, sparse_isolated, gappy, high_missing, entirely_missing.

    A series without any value has no longest run.
    """
    null_runs = runs_of(df, keys, order, F.col(value).isNull(), size)
    out = null_runs.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("flag"), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.coalesce(F.max(F.when(F.col("flag"), F.col("n"))), F.lit(0)).alias("longest"),
    )
    share = F.col("n_missing") / F.col("n")
    out = out.withColumn("missing_fraction", share)
    out = out.withColumn("longest", F.when(F.col("n_missing") == F.col("n"), 0).otherwise(F.col("longest")))
    kind = (
        F.when(F.col("n_missing") == 0, "complete")
        .when(F.col("n_missing") == F.col("n"), "entirely_missing")
        .when(share > 0.5, "high_missing")
        .when(F.col("longest") >= 10, "gappy")
        .otherwise("sparse_isolated")
    )
    return out.withColumn("kind", kind)


def flat_runs(df: DataFrame, keys: list[str], ts: str, value: str, min_seconds: float, size: int | None = None) -> DataFrame:
    """Column ``flat``: samples that repeat the one before in a run that lasts at least ``min_seconds``; not the first."""
    if size is not None:
        rows = scans.with_changes(df, keys, ts, lambda before: ~F.col(value).eqNullSafe(before(value)) | F.col(value).isNull() | (F.col("__i") == 0), size)
        at = seconds(F.col(ts))
        rows = scans.of_runs(rows, keys, __from=(F.min, at), __to=(F.max, at))
        flat = F.col(value).isNotNull() & ~F.col("__changed") & (F.col("__to") - F.col("__from") >= min_seconds)
        return rows.withColumn("flat", flat).drop("__from", "__to", "__changed", "__run", "__i", "__stretch")
    w = series(keys, ts)
    previous = F.lag(value).over(w)
    rows = df.withColumn("__run", run_id(~F.col(value).eqNullSafe(previous) | F.col(value).isNull(), keys, ts))
    whole = Window.partitionBy(*keys, "__run")
    lasts = F.max(seconds(F.col(ts))).over(whole) - F.min(seconds(F.col(ts))).over(whole)
    first = F.row_number().over(whole.orderBy(ts)) == 1
    return rows.withColumn("flat", F.col(value).isNotNull() & ~first & (lasts >= min_seconds)).drop("__run")


def missing_gaps(df: DataFrame, keys: list[str], order: str, value: str, least: int, size: int | None = None) -> DataFrame:
    """Column ``qc``: GAP on runs of at least ``least`` nulls, MISSING on other nulls, else VALID."""
    rows = flag_long_runs(df, keys, order, F.col(value).isNull(), least, "__gap", size=size)
    return rows.withColumn("qc", F.when(F.col("__gap"), "GAP").when(F.col(value).isNull(), "MISSING").otherwise("VALID")).drop("__gap")


def label_segments(df: DataFrame, keys: list[str], ts: str, label: Column, size: int | None = None) -> DataFrame:
    """Runs of equal labels as segments start_s, end_s, label, n; seconds from the series' first sample."""
    runs = runs_of(df, keys, ts, label, size)
    origin = F.min("first").over(Window.partitionBy(*keys))
    return runs.select(
        *keys,
        (seconds(F.col("first")) - seconds(origin)).alias("start_s"),
        (seconds(F.col("last")) - seconds(origin)).alias("end_s"),
        F.col("flag").alias("label"),
        "n",
    )


def any_of(*flags: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags])


def time_unit(value: Column) -> Column:
    """What a numeric time column counts, by its greatest value: ms, s or index."""
    return F.when(value > 1e11, "ms").when(value > 1e7, "s").otherwise("index")


def resolve_time(df: DataFrame, keys: list[str], order: str, text: str, elapsed: str, fs: float, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Columns t_s (seconds from the recording's start) and method, decided per recording.

    ``file``: over half of the texts are times; ``elapsed``: over half of the elapsed values are numbers, none negative,
    and over a second in all (milliseconds); else ``reconstructed``: the row's place over the sampling rate.
    """
    rows = df.withColumn("__t", F.unix_micros(F.try_to_timestamp(text, F.lit(fmt))) / 1e6).withColumn("__e", F.col(elapsed).try_cast("double"))
    whole = Window.partitionBy(*keys)
    half = F.count("*").over(whole) * 0.5
    method = (
        F.when(F.count("__t").over(whole) > half, "file")
        .when((F.count("__e").over(whole) > half) & (F.min("__e").over(whole) >= 0) & (F.max("__e").over(whole) > 1000), "elapsed")
        .otherwise("reconstructed")
    )
    rows = rows.withColumn("method", method).withColumn("__i", F.row_number().over(series(keys, order)) - 1)
    t = (
        F.when(F.col("method") == "file", F.col("__t") - F.min("__t").over(whole))
        .when(F.col("method") == "elapsed", (F.col("__e") - F.min("__e").over(whole)) / 1000)
        .otherwise(F.col("__i") / fs)
    )
    return rows.withColumn("t_s", t).drop("__t", "__e", "__i")


def within_seconds(df: DataFrame, keys: list[str], time: str, value: str, before_s: float) -> DataFrame:
    """Column ``recent_mean`` over the samples of the last ``before_s`` seconds, by a range frame over whole microseconds."""
    w = Window.partitionBy(*keys).orderBy(micros(F.col(time))).rangeBetween(-int(before_s * 1e6), 0)
    return df.withColumn("recent_mean", F.avg(value).over(w)).withColumn("recent_n", F.count(value).over(w))
