"""Validity rules: samples are flagged, never deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.timeseries import series

DICTIONARY_SCHEMA = "variable string, low double, high double, zero_is_valid boolean, fallback boolean"


def dictionary(spark, rows: list[tuple]) -> DataFrame:
    """A variable dictionary (variable, low, high, zero_is_valid, fallback) as a small table."""
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def missing_rules(df: DataFrame, value: str, variable: str, spec: DataFrame, codes: list[float]) -> DataFrame:
    """Missing codes, and zeros where a variable can't be zero, become null; variables without a spec keep both."""
    spec = spec.select(F.col("variable").alias("__variable"), "zero_is_valid")
    rows = df.join(spec, F.col(variable) == F.col("__variable"), "left")
    gone = F.col(value).isin(codes) | ((F.col(value) == 0) & ~F.coalesce("zero_is_valid", F.lit(True)))
    return rows.withColumn(value, F.when(~F.coalesce(gone, F.lit(False)), F.col(value))).drop("__variable", "zero_is_valid")


def validity(df: DataFrame, value: str, variable: str, spec: DataFrame, codes: list[float]) -> DataFrame:
    """Columns qc and clean: MISSING, INVALID_RANGE (only if both bounds exist), LOW_QUALITY (bounds are a fallback),
    UNREVIEWED (no spec) or VALID. clean is the value where it stands; unreviewed values are kept.
    """
    small = spec.select(F.col("variable").alias("__variable"), "low", "high", "zero_is_valid", "fallback")
    rows = df.join(small, F.col(variable) == F.col("__variable"), "left")
    x = F.col(value)
    bounded = F.col("low").isNotNull() & F.col("high").isNotNull()
    bad = bounded & (((x == 0) & ~F.col("zero_is_valid")) | (x < F.col("low")) | (x > F.col("high")))
    qc = (
        F.when(x.isNull() | x.isin(codes), "MISSING")
        .when(F.col("__variable").isNull(), "UNREVIEWED")
        .when(bad, "INVALID_RANGE")
        .when(F.col("fallback"), "LOW_QUALITY")
        .otherwise("VALID")
    )
    rows = rows.withColumn("qc", qc).withColumn("clean", F.when(~F.col("qc").isin("MISSING", "INVALID_RANGE"), x))
    return rows.drop("__variable", "low", "high", "zero_is_valid", "fallback")


def safety_rails(df: DataFrame, keys: list[str], value: str, artifact: Column, warn: float = 0.5, wipe: float = 0.99) -> DataFrame:
    """Columns qc and kept: artifacts are removed unless that would take too much of a series.

    Over ``warn`` of its valid samples: all are kept for review; from ``wipe`` on: kept as critical.
    """
    whole = Window.partitionBy(*keys)
    hit = F.coalesce(artifact, F.lit(False)) & F.col(value).isNotNull()
    rows = df.withColumn("__hit", hit)
    share = F.sum(F.col("__hit").cast("int")).over(whole) / F.nullif(F.count(value).over(whole), F.lit(0))
    qc = (
        F.when(F.col(value).isNull(), "MISSING")
        .when(~F.col("__hit"), "VALID")
        .when(F.col("__share") >= wipe, "KEPT_WOULD_WIPE")
        .when(F.col("__share") > warn, "KEPT_OVERFILTER_REVIEW")
        .otherwise("ARTIFACT")
    )
    rows = rows.withColumn("__share", share).withColumn("qc", qc)
    return rows.withColumn("kept", F.when(F.col("qc") != "ARTIFACT", F.col(value))).drop("__hit", "__share")


def never_resurrect(df: DataFrame, clean: str, filtered: str) -> DataFrame:
    """``filtered`` is null wherever ``clean`` is."""
    return df.withColumn(filtered, F.when(F.col(clean).isNotNull(), F.col(filtered)))


def by_class(df: DataFrame, value: str, kind: str) -> DataFrame:
    """Column ``qc`` by processing class: settings are VALID or MISSING, events always VALID, scalars need a number."""
    number = F.col(value).try_cast("double")
    qc = (
        F.when(F.col(kind) == "event", "VALID")
        .when(F.col(value).isNull() | (F.trim(value) == ""), "MISSING")
        .when(F.col(kind) == "setting", "VALID")
        .when(number.isNull() | F.isnan(number), "INVALID")
        .otherwise("VALID")
    )
    return df.withColumn("qc", qc)


def consistency(df: DataFrame) -> DataFrame:
    """Cross-checks of ventilator variables, each true where it holds or can't be judged, and any_violation.

    mve ~ vt * rr / 1000 within 30 %, pip >= pplat >= peep, elastance * compliance ~ 1 within 50 %, rr ~ mandatory +
    spontaneous within 25 %. A missing column or value isn't a violation.
    """
    has = lambda *names: all(n in df.columns for n in names)
    near = lambda a, b, most: F.abs(a - b) / F.nullif(F.abs(b), F.lit(0.0)) <= most
    c = F.col
    checks = {
        "minute_volume_ok": near(c("mve"), c("vt") * c("rr") / 1000, 0.3) if has("mve", "vt", "rr") else None,
        "pressure_order_ok": (c("pip") >= c("pplat")) & (c("pplat") >= c("peep")) if has("pip", "pplat", "peep") else None,
        "compliance_ok": near(c("elastance") * c("compliance"), F.lit(1.0), 0.5) if has("elastance", "compliance") else None,
        "rate_ok": near(c("rr"), c("rr_mand") + c("rr_spon"), 0.25) if has("rr", "rr_mand", "rr_spon") else None,
    }
    out = df.withColumns({k: F.lit(True) if v is None else F.coalesce(v, F.lit(True)) for k, v in checks.items()})
    return out.withColumn("any_violation", ~(c("minute_volume_ok") & c("pressure_order_ok") & c("compliance_ok") & c("rate_ok")))


def pressure_gradient(df: DataFrame, invasive: str, cuff: str, high: float = 10.0) -> DataFrame:
    return df.withColumn("gradient", F.abs(F.col(invasive) - F.col(cuff))).withColumn("gradient_high", F.col("gradient") >= high)


def column_class(name: Column, rules: list[tuple[str, list[str]]], default: str = "unknown") -> Column:
    """The first class of the ordered rules one of whose tokens is among the name's tokens."""
    tokens = F.split(F.lower(name), "[^a-z0-9]+")
    out = None
    for kind, words in rules:
        hit = F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words]))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise(default)


def short_gap_examples(df: DataFrame, keys: list[str], order: str, value: str, low: float, high: float, least: int = 2, most: int = 10) -> DataFrame:
    """Gaps of ``least`` to ``most`` nulls between neighbours within the norm, with a linear correction per null."""
    w = series(keys, order)
    rows = df.withColumn("__pos", F.row_number().over(w))
    rows = rows.withColumn("__last", F.last(F.when(F.col(value).isNotNull(), F.struct("__pos", value)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("__next", F.first(F.when(F.col(value).isNotNull(), F.struct("__pos", value)), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    gap = F.col("__next.__pos") - F.col("__last.__pos") - 1
    a, b = F.col(f"__last.{value}"), F.col(f"__next.{value}")
    rows = rows.where(F.col(value).isNull() & gap.between(least, most) & a.between(low, high) & b.between(low, high))
    step = (F.col("__pos") - F.col("__last.__pos")) / (gap + 1)
    return rows.withColumn("gap", gap).withColumn("corrected", a + (b - a) * step).drop("__pos", "__last", "__next")
