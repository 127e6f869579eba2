"""Summaries, cohort statistics, rank tests, privacy and identifier scans."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def describe(df: DataFrame, keys: list[str], value: str, rounded: bool = True) -> DataFrame:
    """n, mean, sd (n - 1), median, p25, p75, min, max and missing share; rounded half-even to one decimal if asked."""
    quantiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        quantiles.alias("q"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        ((1 - F.count(value) / F.count("*")) * 100).alias("missing_pct"),
    )
    out = out.select(*keys, "n", "mean", "sd", F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(0)).alias("p25"), F.get("q", F.lit(2)).alias("p75"), "min", "max", "missing_pct")
    if not rounded:
        return out
    return out.withColumns({c: F.bround(c, 1) for c in ("mean", "sd", "median", "p25", "p75", "min", "max", "missing_pct")})


def correlation(a: Column, b: Column) -> Column:
    """Pearson's correlation of the rows that have both; NaN where one is constant, null where no row has both.

    ``F.corr`` divides by zero there, which is an error in ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return F.when(F.count_if(both) > 0, F.coalesce(F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)), F.lit(float("nan"))))


def extreme_quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """Exact quantiles far into both tails, one row per share."""
    q = df.groupBy(*keys).agg(F.percentile(value, F.array(*[F.lit(s) for s in shares])).alias("q"))
    return q.select(*keys, F.posexplode("q").alias("i", "value")).select(*keys, F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("i") + 1).alias("share"), "value")


def midranks(df: DataFrame, value: str, scope: list[str] | None = None) -> DataFrame:
    """Column ``midrank``: ranks with ties at their mean.

    Ranks come from counts per distinct value: a window orders the values of a scope, not its rows.
    """
    scope = scope or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*scope, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*(scope or [F.lit(0)])).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("midrank", F.sum("__n").over(w) - (F.col("__n") - 1) / 2)
    keys = [*scope, value]
    return df.join(counts.drop("__n"), keys)


def rank_test(df: DataFrame, group: str, value: str, scope: list[str] | None = None) -> DataFrame:
    """Per scope: the number of groups with three values at least, Mann-Whitney's U of the first of two groups, the
    Kruskal-Wallis H with tie correction, the two-sided p-value and its method: ``exact`` for two groups without ties of
    which one has at most EXACT values, ``normal`` (with continuity correction) for other two, ``chi2`` for more.
    """
    scope = scope or []
    rows = df.where(F.col(value).isNotNull())
    sizes = rows.groupBy(*scope, group).agg(F.count("*").alias("__m")).where("__m >= 3").drop("__m")
    rows = midranks(rows.join(sizes, [*scope, group]).select(*scope, group, value), value, scope)
    ties = rows.groupBy(*scope, value).agg(F.count("*").cast("double").alias("t"))
    ties = ties.groupBy(*scope).agg(F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("ties"))
    groups = rows.groupBy(*scope, group).agg(F.count("*").alias("m"), F.sum("midrank").alias("r"))
    part = F.col("r") * F.col("r") / F.col("m")
    first = F.min_by(F.struct("m", "r"), group)
    out = groups.groupBy(*scope).agg(F.count("*").alias("n_groups"), F.sum("m").alias("n"), F.sum(part).alias("__s"), first.alias("__f"))
    out = out.join(ties, scope) if scope else out.crossJoin(F.broadcast(ties))  # one row each
    n, m1 = F.col("n"), F.col("__f.m")
    m2 = n - m1
    u = F.col("__f.r") - m1 * (m1 + 1) / 2
    correction = 1 - F.col("ties") / (n * n * n - n)
    h = (12 / (n * (n + 1)) * F.col("__s") - 3 * (n + 1)) / F.nullif(correction, F.lit(0.0))
    sd = F.sqrt(m1 * m2 / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    z = (F.abs(u - m1 * m2 / 2) - 0.5) / F.nullif(sd, F.lit(0.0))
    small = (F.col("ties") == 0) & (F.least(m1, m2) <= EXACT)
    method = F.when(F.col("n_groups") == 2, F.when(small, "exact").otherwise("normal")).when(F.col("n_groups") > 2, "chi2")
    out = out.withColumns({"u": F.when(F.col("n_groups") == 2, u), "h": h, "__z": z, "method": method, "__m1": m1})

    @F.pandas_udf("double")
    def p_value(method: pd.Series, u: pd.Series, z: pd.Series, h: pd.Series, k: pd.Series, n: pd.Series, m1: pd.Series) -> pd.Series:
        def one(method, u, z, h, k, n, m1):
            if method == "exact":
                return exact_u(int(m1), int(n - m1), int(u))
            if method == "normal":
                return min(1.0, math.erfc(max(z, 0) / math.sqrt(2)))
            return chi2_tail(h, k - 1) if method == "chi2" else None

        return pd.Series([one(*row) for row in zip(method, u, z, h, k, n, m1, strict=True)], dtype="float64")

    return out.withColumn("p", p_value("method", "u", "__z", "h", "n_groups", "n", "__m1")).drop("__f", "__s", "ties", "__z", "__m1")


#: Up to so many values in the smaller of two groups without ties, p-values of ranks are exact.
EXACT = 8


def exact_u(m: int, n: int, u: int) -> float:
    """Two-sided p-value of U: the share of all splits of the ranks that lie as far out, twice.

    How many splits have a certain U are the coefficients of the product over i <= m of (1 - q^(n + i)) / (1 - q^i), in
    whole numbers, taken as far as the smaller tail reaches.
    """
    m, n = min(m, n), max(m, n)
    low = min(u, m * n - u)
    splits = [1] + [0] * low
    for i in range(1, m + 1):
        for k in range(low, n + i - 1, -1):
            splits[k] -= splits[k - n - i]
        for k in range(i, low + 1):
            splits[k] += splits[k - i]
    return min(1.0, 2 * sum(splits) / math.comb(m + n, m))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution, by the series of the lower incomplete gamma function."""
    if x is None or math.isnan(x) or x <= 0:
        return 1.0
    a, x = df / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return max(0.0, 1 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def suppressed(count: Column, k: int = 5) -> Column:
    """A count, or null where it is below ``k``."""
    return F.when(count >= k, count)


def k_anonymous(df: DataFrame, keys: list[str], unit: str, value: str, k: int = 5) -> DataFrame:
    """Groups with at least ``k`` distinct units; their row counts and hours below ``k`` are suppressed."""
    out = df.groupBy(*keys).agg(F.countDistinct(unit).alias("n_units"), F.count("*").alias("n_rows"), F.avg(value).alias("mean"))
    return out.where(F.col("n_units") >= k).withColumn("n_rows", suppressed(F.col("n_rows"), k))


def prevalence(df: DataFrame, item: str, unit: str, threshold: float = 0.6) -> DataFrame:
    """Share of units that have each item, and whether it is expected or optional."""
    total = df.agg(F.countDistinct(unit).alias("__total"))
    out = df.groupBy(item).agg(F.countDistinct(unit).alias("n_units")).crossJoin(F.broadcast(total))  # one row
    out = out.withColumn("prevalence", F.bround(F.col("n_units") / F.col("__total"), 3)).drop("__total")
    return out.withColumn("status", F.when(F.col("prevalence") >= threshold, "expected").otherwise("optional"))


def worst_first(df: DataFrame, keys: list[str], result: str, severity: dict[str, int], position: str) -> DataFrame:
    """The worst result per key; of equally severe ones the first."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in severity.items() for x in kv])[F.col(result)], F.lit(0))
    return df.groupBy(*keys).agg(F.min_by(result, F.struct(-rank, F.col(position))).alias("worst"), F.count("*").alias("n_checks"))


def external_validation(df: DataFrame, keys: list[str], value: str, reference: DataFrame) -> DataFrame:
    """Per variable mean, sd, p5/50/95, share outside plausible bounds and the distance from a published mean.

    reference: keys, ref_mean, ref_sd, low, high; a small table.
    """
    rows = df.join(reference, keys)
    out = rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.percentile(value, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("q"),
        (F.avg((~F.col(value).between(F.col("low"), F.col("high"))).cast("double")) * 100).alias("out_pct"),
        F.first("ref_mean").alias("ref_mean"),
        F.first("ref_sd").alias("ref_sd"),
    )
    out = out.withColumn("z", (F.col("mean") - F.col("ref_mean")) / F.col("ref_sd"))
    verdict = F.when(F.abs("z") > 3, "DIFFERENT").when((F.abs("z") > 2) | (F.col("out_pct") > 5), "CHECK").otherwise("CONSISTENT")
    parts = {f"p{n}": F.get("q", F.lit(i)) for i, n in enumerate((5, 50, 95))}
    return out.withColumns({**parts, "verdict": verdict}).drop("q", "ref_mean", "ref_sd")


def overfilter(df: DataFrame, keys: list[str], value: str, family: str, limits: DataFrame) -> DataFrame:
    """Share of nulls per series against its family's limits (family, warn_pct, critical_pct, exempt); under a tenth left is
    CRITICAL_EMPTY. limits is a small table."""
    out = df.groupBy(*keys, family).agg(((1 - F.count(value) / F.count("*")) * 100).alias("null_pct"))
    out = out.join(limits, family, "left")
    status = (
        F.when(F.coalesce("exempt", F.lit(False)), "EXEMPT")
        .when(F.col("null_pct") > 90, "CRITICAL_EMPTY")
        .when(F.col("null_pct") >= F.col("critical_pct"), "CRITICAL")
        .when(F.col("null_pct") >= F.col("warn_pct"), "WARNING")
        .otherwise("OK")
    )
    return out.withColumn("status", status).drop("warn_pct", "critical_pct", "exempt")


#: Patterns of values that identify people. Digits and word edges are ASCII's, in Spark as in SQL; only
#: the edges of names are spelt out, as an accented letter is none of ASCII's word characters.
IDENTIFIERS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?\d[\d .\-()]{7,}\d",
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}",
    "date": r"\b(19|20)\d{2}[-/.](0[1-9]|1[0-2])[-/.](0[1-9]|[12]\d|3[01])\b",
    "long_number": r"\d{6,}",
    "name": r"(^|[^A-Za-z0-9_À-ÿ])[A-ZÀ-Þ][a-zà-þ]+(?: [A-ZÀ-Þ][a-zà-þ]+){1,3}($|[^A-Za-z0-9_À-ÿ])",
}


def identifier_scan(df: DataFrame, keys: list[str], text: str, patterns: dict[str, str] = IDENTIFIERS) -> DataFrame:
    """Rows that each pattern hits, and whether the column looks like free text: many distinct, long values."""
    out = df.groupBy(*keys).agg(
        F.count(text).alias("n"),
        *[F.count_if(F.col(text).rlike(p)).alias(f"n_{k}") for k, p in patterns.items()],
        F.countDistinct(F.xxhash64(text), F.length(text)).alias("n_distinct"),
        F.avg(F.length(text)).alias("mean_length"),
    )
    return out.withColumn("free_text", (F.col("n_distinct") > F.greatest(F.lit(10), F.col("n") / 2)) & (F.col("mean_length") > 20))


def failure_spikes(runs: DataFrame, key: str, order: str, failed: str, total: str, least: int = 3, share: float = 0.25) -> DataFrame:
    """Runs whose failures are many in number, in share and against the upper median of the runs before."""
    rate = F.col(failed) / F.nullif(F.col(total), F.lit(0))
    w = Window.partitionBy(key).orderBy(order)
    rows = runs.withColumn("rate", rate).withColumn("__past", F.array_sort(F.collect_list("rate").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    rows = rows.withColumn("baseline", F.get("__past", F.floor(F.size("__past") / 2).cast("int"))).drop("__past")
    spike = (F.col(failed) >= least) & (F.col("rate") >= share) & (F.col("rate") > 3 * F.coalesce("baseline", F.lit(0.0)) + 0.05)
    return rows.withColumn("spike", F.coalesce(spike, F.lit(False)))
