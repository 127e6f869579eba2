"""Checks of files, recordings and exams, and the verdicts that follow from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators import timeseries as ts


def checks(df: DataFrame, keys: list[str], rules: list[tuple[str, Column, str, Column]]) -> DataFrame:
    """One row per unit and check: check, result (PASS or the rule's severity) and what was measured.

    rules: (name, condition that passes, severity otherwise, measured value). A condition that can't be judged passes.
    """
    parts = [
        F.struct(F.lit(n).alias("check"), F.when(F.coalesce(ok, F.lit(True)), "PASS").otherwise(severity).alias("result"), measured.cast("double").alias("measured"), F.lit(i).alias("position"))
        for i, (n, ok, severity, measured) in enumerate(rules)
    ]
    return df.select(*keys, F.explode(F.array(*parts)).alias("c")).select(*keys, "c.*")


def _rank(result: Column, order: tuple[str, ...]) -> Column:
    place = F.array_position(F.array(*[F.lit(o) for o in order]), result)
    return F.when(place == 0, len(order) + 1).otherwise(place)


def verdict(found: DataFrame, keys: list[str], order: tuple[str, ...]) -> DataFrame:
    """The worst result per unit by ``order`` (worst first); of equally bad checks the first names it."""
    rank = _rank(F.col("result"), order)
    worst = F.min_by(F.struct("result", "check"), F.struct(rank, F.col("position")))
    return found.groupBy(*keys).agg(worst.alias("w"), F.count_if(F.col("result") != "PASS").alias("n_failed")).select(*keys, F.col("w.result").alias("verdict"), F.when(F.col("w.result") != "PASS", F.col("w.check")).alias("because"), "n_failed")


def recording_flags(df: DataFrame, key: str, time: str, value: str, least_s: float, gap_s: float, most_missing: float, low: float, high: float, flat: int) -> DataFrame:
    """Flags of a recording: NO_DATA, RECORDING_TOO_SHORT, SAMPLING_IRREGULAR, TIMESTAMP_GAP, MISSING_DATA_HIGH,
    SIGNAL_FLAT, RANGE_WARNING; one row per flag with what was measured."""
    w = ts.series([key], time)
    rows = df.withColumn("__dt", ts.step_s(time, w))
    middle = F.median("__dt").over(Window.partitionBy(key))
    rows = rows.withColumn("__odd", F.abs(F.col("__dt") - middle) > 0.5 * middle)
    a = rows.groupBy(key).agg(
        F.count(value).alias("n"),
        (ts.seconds(F.max(time)) - ts.seconds(F.min(time))).alias("duration"),
        F.avg(F.col("__odd").cast("int")).alias("odd"),
        F.max("__dt").alias("gap"),
        (1 - F.count(value) / F.count("*")).alias("missing"),
        F.avg((~F.col(value).between(low, high)).cast("int")).alias("outside"),
    )
    a = a.join(ts.longest_unchanged(df, [key], time, value), key, "left")
    c = F.col
    rules = [
        ("NO_DATA", c("n") > 0, "error", c("n")),
        ("RECORDING_TOO_SHORT", c("duration") >= least_s, "error", c("duration")),
        ("SAMPLING_IRREGULAR", c("odd") <= 0.5, "warning", c("odd")),
        ("TIMESTAMP_GAP", c("gap") <= gap_s, "warning", c("gap")),
        ("MISSING_DATA_HIGH", c("missing") <= most_missing, "warning", c("missing")),
        ("SIGNAL_FLAT", c("longest") < flat, "warning", c("longest")),
        ("RANGE_WARNING", c("outside") <= 0.05, "warning", c("outside")),
    ]
    found = checks(a, [key], rules)
    return found.where("result <> 'PASS'").select(key, F.col("check").alias("flag"), F.col("result").alias("severity"), "measured")


def review_verdict(units: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """PASS without any flag, else REVIEW; every unit has a row."""
    n = flags.groupBy(key).agg(F.count("*").alias("n_flags"))
    return units.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n_flags", F.lit(0)).alias("n_flags"), F.when(F.col("n_flags") > 0, "REVIEW").otherwise("PASS").alias("verdict"))


def qc_rates(qc: DataFrame, keys: list[str], label: str, artifacts: list[str], missing: list[str], most_artifact: float = 0.1, most_missing: float = 0.5) -> DataFrame:
    """Artifact share of what was observed and missing share of all, with findings over the limits."""
    a = qc.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col(label).isin(artifacts)).alias("n_artifact"), F.count_if(F.col(label).isin(missing)).alias("n_missing"))
    rate = F.coalesce(F.col("n_artifact") / F.nullif(F.col("n") - F.col("n_missing"), F.lit(0)), F.lit(0.0))
    out = a.withColumn("artifact_rate", rate).withColumn("missing_rate", F.col("n_missing") / F.col("n"))
    finding = F.concat_ws(",", F.when(F.col("artifact_rate") > most_artifact, "ARTIFACTS"), F.when(F.col("missing_rate") > most_missing, "MISSING"))
    return out.withColumn("finding", finding)


def template_audit(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """What a template expects and isn't there, and what is there unexpectedly."""
    e, o = expected.select(*keys).distinct(), observed.select(*keys).distinct()
    return e.join(o, keys, "left_anti").withColumn("status", F.lit("MISSING")).unionByName(o.join(e, keys, "left_anti").withColumn("status", F.lit("UNEXPECTED")))


def checklist(results: DataFrame, key: str, device: str, result: str, devices: list[str], order: tuple[str, ...]) -> DataFrame:
    """The worst result per unit and expected device as columns; ABSENT where there is none. Results that ``order`` lacks
    are the least bad."""
    rank = _rank(F.col(result), order)
    wide = results.groupBy(key).pivot(device, devices).agg(F.min_by(result, rank))
    return wide.fillna("ABSENT", devices)


def out_of_any_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Column ``artifact``: any of the row's signals is outside its range; nulls are not."""
    hits = [F.coalesce(~F.col(c).between(lo, hi), F.lit(False)) for c, (lo, hi) in ranges.items()]
    return df.withColumn("artifact", reduce(lambda a, b: a | b, hits))


def rich_part(df: DataFrame, keys: list[str], order: str, value: str, low: float, high: float, size: int) -> DataFrame:
    """The ``size`` rows from the first value within range on."""
    rows = df.withColumn("__i", F.row_number().over(ts.series(keys, order)))
    first = F.min(F.when(F.col(value).between(low, high), F.col("__i"))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("__first", first)
    return rows.where(F.col("__i").between(F.col("__first"), F.col("__first") + size - 1)).drop("__i", "__first")


def worst_kind(df: DataFrame, keys: list[str], kind: str, order: tuple[str, ...]) -> DataFrame:
    """Counts per kind and the worst kind per key; ``order`` has the worst first; kinds that it lacks come last."""
    rank = _rank(F.col(kind), order)
    return df.groupBy(*keys).agg(F.min_by(kind, rank).alias("worst_kind"), *[F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in order])


def champion(registry: DataFrame, name: str, score: str, version: str) -> DataFrame:
    """The best version of every model; of equals the first; one without a score only if no version has one."""
    best = F.min_by(F.struct(version, score), F.struct(F.col(score).isNull(), -F.col(score), F.col(version)))
    return registry.groupBy(name).agg(best.alias("b"), F.count("*").alias("n_versions")).select(name, f"b.{version}", f"b.{score}", "n_versions")


def numeric_if_mostly(df: DataFrame, columns: list[str], least: float = 0.5) -> DataFrame:
    """Text columns become numbers if more than ``least`` of their values are; one pass decides for all columns."""
    shares = df.agg(*[(F.count(F.col(c).try_cast("double")) / F.nullif(F.count(c), F.lit(0))).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if (shares[c] or 0) > least})


def usable(df: DataFrame, key: str, variable: str, known: list[str], least_rows: int = 10, least_variables: int = 2) -> DataFrame:
    """Per recording its rows, its known variables, and why it is skipped: TOO_SHORT, TOO_FEW_VARIABLES or null."""
    out = df.groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct(F.when(F.col(variable).isin(*known), F.col(variable))).alias("n_known"))
    return out.withColumn("skipped", F.when(F.col("n_rows") < least_rows, "TOO_SHORT").when(F.col("n_known") < least_variables, "TOO_FEW_VARIABLES"))


def issues(results: DataFrame, key: str, device: str, result: str, good: str = "PASS", most: int = 8) -> DataFrame:
    """Per unit the number of results that aren't good and the first ``most`` of them as device:result."""
    bad = results.where(F.col(result) != good).select(key, F.concat_ws(":", device, result).alias("__i")).distinct()
    rows = bad.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy("__i")))
    found = rows.groupBy(key).agg(F.count("*").alias("n_issues"), F.array_sort(F.collect_list(F.when(F.col("__k") <= most, F.col("__i")))).alias("issues"))
    out = results.select(key).distinct().join(found, key, "left")
    return out.select(key, F.coalesce("n_issues", F.lit(0)).alias("n_issues"), F.coalesce("issues", F.array().cast("array<string>")).alias("issues"))


def artifact_labels(df: DataFrame, raw: str, clean: str, most: float = 20.0) -> DataFrame:
    """Column ``artifact``: the clean value is missing where the raw one isn't, or differs from it by more than ``most``."""
    return df.withColumn("artifact", F.col(raw).isNotNull() & (F.col(clean).isNull() | F.coalesce(F.abs(F.col(raw) - F.col(clean)) > most, F.lit(False))))
