"""Peaks of series: local maxima with a least distance and a least prominence, by built-in functions.

A peak is where a rise is followed by a fall, plateaus in between included; its place is the plateau's middle. Of peaks
closer than the distance the highest stay, the later one of equals, decided from the highest down. Peaks further apart
than the distance from their neighbours can't touch each other, so each chain of closer ones is decided by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def local_maxima(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """keys, at (place among the non-null samples from 0), height of every local maximum. Ends are none, nor are plateaus
    that reach one."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"), (F.row_number().over(w) - 1).alias("__i"))
    w = Window.partitionBy(*keys).orderBy("__i")
    rows = rows.withColumn("__before", F.lag("__x").over(w)).where(F.col("__x") != F.col("__before"))
    rows = rows.withColumn("__rises", F.col("__x") > F.col("__before"))
    rows = rows.withColumn("__from", F.lag("__i").over(w)).withColumn("__rose", F.lag("__rises").over(w))
    top = rows.where(F.col("__rose") & ~F.col("__rises"))
    return top.select(*keys, F.floor((F.col("__from") + F.col("__i") - 1) / 2).alias("at"), F.col("__before").alias("height"))


def apart(maxima: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """The maxima that stay where any two must be ``distance`` samples apart."""
    if distance <= 1:
        return maxima
    w = Window.partitionBy(*keys).orderBy("at")
    rows = maxima.withColumn("__far", F.coalesce(F.col("at") - F.lag("at").over(w) >= distance, F.lit(True)))
    rows = rows.withColumn("__chain", F.sum(F.col("__far").cast("int")).over(w))
    chain = F.sort_array(F.collect_list(F.struct("height", "at")), asc=False)
    chains = rows.groupBy(*keys, "__chain").agg(chain.alias("__all"))
    none = F.filter("__all", lambda p: F.lit(False))
    free = lambda kept, p: ~F.exists(kept, lambda k: F.abs(k["at"] - p["at"]) < distance)
    kept = F.aggregate("__all", none, lambda kept, p: F.when(free(kept, p), F.concat(kept, F.array(p))).otherwise(kept))
    return chains.select(*keys, F.explode(kept).alias("__p")).select(*keys, "__p.at", "__p.height")


def prominent(maxima: DataFrame, df: DataFrame, keys: list[str], order: str, value: str, least: Column) -> DataFrame:
    """The maxima that stand out by ``least`` from the higher of the lowest samples on both sides, each side up to the next
    higher sample or the end. Series (groups of ``keys``) must fit in a row; null keys match nothing."""
    samples = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, value))).alias("__s"))
    samples = samples.withColumn("__xs", F.transform("__s", lambda s: s[value])).drop("__s")
    rows = maxima.withColumn("__least", least).join(samples, keys)

    def base(side: Column) -> Column:
        start = F.struct(F.col("height").cast("double").alias("low"), F.lit(True).alias("on"))
        step = lambda a, x: F.struct(F.when(a["on"] & (x <= F.col("height")), F.least(a["low"], x)).otherwise(a["low"]).alias("low"), (a["on"] & (x <= F.col("height"))).alias("on"))
        return F.aggregate(side, start, step, lambda a: a["low"])

    n = F.size("__xs")
    at = F.col("at").cast("int")
    left = F.reverse(F.slice("__xs", F.lit(1), at))
    right = F.slice("__xs", at + 2, F.greatest(n - at - 1, F.lit(0)))
    rows = rows.withColumn("prominence", F.col("height") - F.greatest(base(left), base(right)))
    return rows.where(F.col("prominence") >= F.col("__least")).drop("__xs", "__least")


def peaks(df: DataFrame, keys: list[str], order: str, value: str, distance: int = 1, prominence: Column | None = None) -> DataFrame:
    """keys, at, height of the peaks; first the distance is kept, then the prominence."""
    found = apart(local_maxima(df, keys, order, value), keys, distance)
    return found if prominence is None else prominent(found, df, keys, order, value, prominence)


def pulse_features(df: DataFrame, keys: list[str], order: str, value: str, distance: int = 10, share: float = 0.1, least: int = 20) -> DataFrame:
    """Features of a pressure wave in each window (group of ``keys``) of ``least`` samples or more: highest, lowest, pulse
    (their difference), greatest and mean rise, beats (peaks ``distance`` apart that stand out by ``share`` of the pulse),
    mean and relative spread of their intervals, share of intervals of over 10 samples with another maximum (the notch),
    ratio of highest to lowest and area above the lowest. Windows with fewer samples have zeros."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.where(F.col(value).isNotNull()).withColumn("__d", F.col(value) - F.lag(value).over(w))
    rise = F.when(F.col("__d") > 0, F.col("__d"))
    # The area by trapezoids: the sum but for half of both ends.
    a = rows.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
        F.max(rise).alias("max_rise"),
        F.avg(rise).alias("mean_rise"),
        (F.sum(value) - (F.min_by(value, order) + F.max_by(value, order)) / 2).alias("__sum"),
    )
    a = a.withColumn("pulse", F.col("highest") - F.col("lowest"))
    maxima = local_maxima(df, keys, order, value)
    need = a.select(*keys, F.when(F.col("pulse") > 0, share * F.col("pulse")).otherwise(1.0).alias("__need"))
    beats = prominent(apart(maxima, keys, distance).join(need, keys), df, keys, order, value, F.col("__need")).select(*keys, "at", F.lit(True).alias("__beat"))
    by_place = Window.partitionBy(*keys).orderBy("at")
    all_ = maxima.select(*keys, "at").join(beats, [*keys, "at"], "left").withColumn("__beat", F.coalesce("__beat", F.lit(False)))
    # Maxima since the beat before, for each beat.
    all_ = all_.withColumn("__nth", F.sum(F.col("__beat").cast("int")).over(by_place)).withColumn("__place", F.row_number().over(by_place))
    only = all_.where("__beat").withColumn("__gap", F.col("at") - F.lag("at").over(by_place))
    only = only.withColumn("__between", F.col("__place") - F.lag("__place").over(by_place) - 1)
    b = only.groupBy(*keys).agg(
        F.count("*").alias("n_beats"),
        F.avg("__gap").alias("__gap"),
        F.stddev_pop("__gap").alias("__sd"),
        F.count_if((F.col("__gap") > 10) & (F.col("__between") > 0)).alias("__notches"),
    )
    out = a.join(b, keys, "left")
    enough, two = F.col("__n") >= least, F.col("n_beats") >= 2
    zero = lambda c: F.when(enough, F.coalesce(c.cast("double"), F.lit(0.0))).otherwise(0.0)
    return out.select(
        *keys,
        *[zero(F.col(c)).alias(c) for c in ("highest", "lowest", "pulse", "max_rise", "mean_rise", "n_beats")],
        zero(F.when(two, F.col("__gap"))).alias("interval"),
        zero(F.when(two, F.col("__sd") / (F.col("__gap") + 1e-6))).alias("interval_spread"),
        zero(F.when(two, F.col("__notches") / (F.col("n_beats") - 1))).alias("notch_share"),
        zero(F.col("highest") / (F.col("lowest") + 1e-6)).alias("high_to_low"),
        zero(F.col("__sum") - F.col("lowest") * (F.col("__n") - 1)).alias("area"),
    )
