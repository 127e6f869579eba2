"""Scans of long series in many tasks: positions, halos, prefix sums and runs across the splits of one recording.

A recording is dealt in ranges of its order. Each range is numbered and reduced by itself, the ranges' summaries are
scanned (a row for each), and what came before is added to each range. From exact positions follow stretches of equally
many rows, whose neighbours' rows come along as a halo: whatever looks a bounded number of rows back or ahead sees in a
stretch what it would see in the whole series, so no task sorts a whole recording.
"""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.columns import micros

#: Rows of a stretch unless said otherwise.
SIZE = 100_000


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys of which null equals null; the keys of ``right`` go."""
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    on = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(right, on, how).drop(*names.values())


def numbered(df: DataFrame, keys: list[str], order: str, size: int = SIZE) -> DataFrame:
    """Rows with __i, their place in their series from 0, and __stretch, __i over ``size``.

    Ranges are equal parts of a series' span, about one for each ``size`` rows; a range with a burst is longer.
    """
    at = micros(F.col(order)) if dict(df.dtypes)[order].startswith("timestamp") else F.col(order)
    at = at.cast("double")
    spans = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(at).alias("__low"), F.max(at).alias("__high"))
    spans = spans.select(*keys, "__low", F.nullif(F.col("__high") - F.col("__low"), F.lit(0.0)).alias("__span"), F.ceil(F.col("__n") / size).alias("__parts"))
    rows = join_on(df, spans, keys)
    part = F.floor((at - F.col("__low")) / F.col("__span") * F.col("__parts"))
    # Null orders come first, as they do where a window sorts them.
    rows = rows.withColumn("__range", F.coalesce(F.least(part, F.col("__parts") - 1), F.lit(0)).cast("int")).drop("__low", "__span", "__parts")
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
    sizes = sizes.select(*keys, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(order)) - 1
    rows = join_on(rows.withColumn("__own", own), sizes, [*keys, "__range"])
    i = F.col("__before") + F.col("__own")
    return rows.withColumn("__i", i).withColumn("__stretch", F.floor(i / size)).drop("__before", "__own", "__range")


def haloed(rows: DataFrame, size: int, before: int, after: int) -> DataFrame:
    """Numbered rows with copies: __stretch holds its own rows, the ``before`` rows ahead of them and ``after`` behind."""
    first, last = F.floor((F.col("__i") - after) / size), F.floor((F.col("__i") + before) / size)
    return rows.withColumn("__stretch", F.explode(F.sequence(F.greatest(first, F.lit(0)), last)))


def own_rows(rows: DataFrame, size: int) -> DataFrame:
    return rows.where(F.floor(F.col("__i") / size) == F.col("__stretch"))


def in_stretches(reach: Callable[..., tuple[int, int]]):
    """For detectors (df, keys, order, ...) that keep their rows and look at most ``reach`` rows back and ahead: with
    ``size`` they work on stretches of so many rows, with the same result. ``reach`` takes the detector's arguments by name."""

    def decorate(detect):
        names = inspect.signature(reach).parameters

        @functools.wraps(detect)
        def run(df: DataFrame, keys: list[str], order: str, *args, size: int | None = None, **options):
            if size is None:
                return detect(df, keys, order, *args, **options)
            given = inspect.signature(detect).bind(df, keys, order, *args, **options)
            given.apply_defaults()
            before, after = reach(**{n: given.arguments[n] for n in names})
            rows = haloed(numbered(df, keys, order, size), size, before, after)
            return own_rows(detect(rows, [*keys, "__stretch"], "__i", *args, **options), size).drop("__i", "__stretch")

        return run

    return decorate


def prefix_sum(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Column ``name``: the sum of ``value`` over the numbered rows of a series up to this one."""
    rows = rows.withColumn("__v", value)
    before = Window.partitionBy(*keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "__stretch").agg(F.sum("__v").alias("__s"))
    sums = sums.select(*keys, "__stretch", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__before"))
    own = F.sum("__v").over(Window.partitionBy(*keys, "__stretch").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0))
    rows = join_on(rows.withColumn("__own", F.coalesce(own, F.lit(0))), sums, [*keys, "__stretch"])
    return rows.withColumn(name, F.col("__before") + F.col("__own")).drop("__v", "__before", "__own")


def with_changes(df: DataFrame, keys: list[str], order: str, changed: Callable[[Callable[[str], Column]], Column], size: int) -> DataFrame:
    """Numbered rows with __changed and __run, the number of changes up to a row. ``changed`` is given a function that
    makes a column's value of the row before (null before the first)."""
    w = Window.partitionBy(*keys, "__stretch").orderBy("__i")
    rows = haloed(numbered(df, keys, order, size), size, 1, 0)
    rows = own_rows(rows.withColumn("__changed", F.coalesce(changed(lambda c: F.lag(c).over(w)), F.lit(False))), size)
    return prefix_sum(rows, keys, F.col("__changed").cast("long"), "__run")


def of_runs(rows: DataFrame, keys: list[str], **totals: tuple[Callable, Column]) -> DataFrame:
    """Rows of ``with_changes`` with aggregates over their whole run, however many stretches it covers.

    Each stretch gives one row a run, so a run of a whole recording meets as summaries only. ``totals``: name=(an aggregate
    that also merges its own results, column).
    """
    parts = rows.groupBy(*keys, "__run", "__stretch").agg(*[f(c).alias(n) for n, (f, c) in totals.items()])
    whole = Window.partitionBy(*keys, "__run")
    parts = parts.select(*keys, "__run", "__stretch", *[f(n).over(whole).alias(n) for n, (f, _) in totals.items()])
    return join_on(rows, parts, [*keys, "__run", "__stretch"])
