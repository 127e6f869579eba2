"""Rules by signal family, names and files: bounds, norms, predicates and the chain that flags a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.operators.peaks import peaks
from pulsegrid.operators.quality import safety_rails
from pulsegrid.operators.timeseries import series

# Bounds outside which a sample is always an artifact, and the usual range, by family.
BOUNDS = (
    ("HR", 15, 300, 30, 180),
    ("SPO2", 0, 100, 90, 100),
    ("ART_SYS", 20, 300, 70, 250),
    ("ART_DIA", 10, 250, 30, 150),
    ("ART_MEAN", 20, 250, 40, 180),
    ("NBP_SYS", 20, 300, 70, 250),
    ("NBP_DIA", 10, 250, 30, 150),
    ("NBP_MEAN", 20, 250, 40, 180),
    ("CVP", -5, 30, 0, 12),
    ("PA_SYS", 0, 80, 10, 40),
    ("PA_DIA", -5, 50, 0, 20),
    ("PA_MEAN", 0, 60, 5, 25),
    ("RR", 4, 60, 8, 30),
    ("ETCO2", 5, 80, 30, 50),
    ("BIS", 0, 100, 20, 80),
    ("NOL", 0, 100, 0, 100),
    ("TEMP", 30, 43, 35, 38),
    ("ST", -5, 5, -1, 1),
    ("PLS", 15, 300, 30, 180),
)
#: Waveforms: no rule of a trend applies to them.
WAVEFORMS = ("ECG", "PLETH")
# Fragments of names of drug columns.
DRUG_FRAGMENTS = (
    "rate", "infusion", "dose", "propofol", "remifentanil", "remi", "sevo", "desflurane", "fio2", "norepinephrine", "noradrenaline",
    "phenylephrine", "vasopressor", "atracurium", "rocuronium", "sufentanil", "fentanyl", "ketamine", "dexmedetomidine", "mac", "pump", "syringe",
)
# Kinds of files that never count as data.
DOCUMENT_EXTENSIONS = ("pdf", "doc", "docx", "odt", "rtf", "xls", "xlsx", "ods", "ppt", "pptx", "odp")
PHOTO_EXTENSIONS = ("jpg", "jpeg", "png", "gif", "bmp", "tiff", "tif", "heic", "heif", "webp")
JUNK_NAMES = (".ds_store", "thumbs.db", "desktop.ini")


def bounds_table(spark: SparkSession, rows=BOUNDS) -> DataFrame:
    """family, hard_low, hard_high, usual_low, usual_high."""
    rows = [(f, *map(float, r)) for f, *r in rows]
    return spark.createDataFrame(rows, "family string, hard_low double, hard_high double, usual_low double, usual_high double")


def by_family(family: Column, rows, i: int) -> Column:
    """Entry ``i`` of the family's row of a fixed table, as an expression: no join, whatever the size of the data."""
    out = None
    for r in rows:
        hit = family == r[0]
        out = F.when(hit, F.lit(float(r[i]))) if out is None else out.when(hit, F.lit(float(r[i])))
    return out


def hard_bounds(value: Column, family: Column, rows=BOUNDS) -> Column:
    """Whether a sample lies outside its family's hard bounds; never for nulls, waveforms and unknown families."""
    return F.coalesce((value < by_family(family, rows, 1)) | (value > by_family(family, rows, 2)), F.lit(False))


def norm_check(df: DataFrame, keys: list[str], value: str, family: str, rows=BOUNDS, most: float = 5.0) -> DataFrame:
    """Per series n, min, max, share outside the usual range in percent and status: EMPTY, NO_NORM, OK or WARN (from ``most`` on)."""
    low, high = by_family(F.col(family), rows, 3), by_family(F.col(family), rows, 4)
    outside = (F.col(value) < low) | (F.col(value) > high)
    out = df.groupBy(*keys, family).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), (F.avg(outside.cast("double")) * 100).alias("outside_pct"))
    status = F.when(F.col("n") == 0, "EMPTY").when(F.col("outside_pct").isNull(), "NO_NORM").when(F.col("outside_pct") < most, "OK").otherwise("WARN")
    return out.withColumn("status", status)


def is_drug(name: Column) -> Column:
    return F.coalesce(F.lower(name).rlike("|".join(DRUG_FRAGMENTS)), F.lit(False))


def extension(path: Column) -> Column:
    """The lower-cased extension of a path's last segment; empty without one."""
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r".\.([A-Za-z0-9]+)$", 1))


def file_kind(path: Column, excluded_folders: tuple[str, ...] = ("Photos",)) -> Column:
    """junk, excluded (inside an excluded folder, any case), photo, document or data, in this order."""
    parts = F.split(F.lower(path), "/")
    name = F.element_at(parts, -1)
    folders = F.array(*[F.lit(f.lower()) for f in excluded_folders]) if excluded_folders else F.array().cast("array<string>")
    return (
        F.when(name.isin(*JUNK_NAMES), "junk")
        .when(F.arrays_overlap(parts, folders), "excluded")
        .when(extension(path).isin(*PHOTO_EXTENSIONS), "photo")
        .when(extension(path).isin(*DOCUMENT_EXTENSIONS), "document")
        .otherwise("data")
    )


def signal_by_tokens(name: Column, signals: list[tuple[str, list[str]]]) -> Column:
    """The first signal all of whose tokens are among a name's; null without one."""
    tokens = F.split(F.lower(name), "[^a-z0-9]+")
    out = F.lit(None).cast("string")
    for label, need in reversed(signals):
        out = F.when(F.size(F.array_except(F.array(*[F.lit(x) for x in need]), tokens)) == 0, label).otherwise(out)
    return out


def without_identifying(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """A map column without identifying keys, whatever their case."""
    low = [k.lower() for k in keys]
    return df.withColumn(column, F.map_filter(column, lambda k, v: ~F.lower(k).isin(*low)))


def cohort(df: DataFrame, minutes: str, least_minutes: float, complete: str, review: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are complete, long enough and not under review; and how many each condition leaves, in turn."""
    steps = [("all", F.lit(True)), ("complete", F.col(complete)), ("long_enough", F.col(minutes) >= least_minutes), ("no_review", ~F.col(review))]
    held, counts = F.lit(True), []
    for _, ok in steps:
        held = held & F.coalesce(ok, F.lit(False))
        counts.append(held)
    # One pass counts all steps; their names are rows.
    left = df.agg(*[F.count_if(c).alias(n) for (n, _), c in zip(steps, counts, strict=True)])
    left = left.select(F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("condition"), F.col(n).alias("n")) for i, (n, _) in enumerate(steps)])).alias("x")).select("x.*")
    return df.where(held), left


def flag_chain(df: DataFrame, keys: list[str], order: str, value: str, family: str, codes: list[float], window: int = 15, threshold: float = 6.0, model: Column | None = None) -> DataFrame:
    """The whole chain over raw samples: columns qc, kept and reason.

    Missing codes become null; hard bounds of the family, spikes (distance from the centred moving median over
    ``threshold`` moving deviations), and what a model says, if given, are artifacts; the rails keep a series that this
    would mostly wipe. Samples are flagged, never deleted, and what is null stays null.
    """
    rows = df.withColumn("__x", F.when(~F.col(value).isin(*codes), F.col(value)) if codes else F.col(value))
    half = (window - 1) // 2
    w = series(keys, order).rowsBetween(half - window + 1, half)
    rows = rows.withColumn("__bound", hard_bounds(F.col("__x"), F.col(family)))
    rows = rows.withColumn("__mid", F.percentile("__x", F.lit(0.5)).over(w)).withColumn("__dev", F.abs(F.col("__x") - F.col("__mid")))
    rows = rows.withColumn("__mad", F.percentile("__dev", F.lit(0.5)).over(w))
    trend = ~F.col(family).isin(*WAVEFORMS)
    spike = trend & F.coalesce(F.col("__dev") > threshold * 1.4826 * F.greatest(F.col("__mad"), F.lit(1e-9)), F.lit(False))
    said = F.coalesce(model, F.lit(False)) if model is not None else F.lit(False)
    reason = F.when(F.col("__x").isNull(), "missing").when(F.col("__bound"), "hard_bounds").when(spike, "spike").when(said, "model")
    rows = rows.withColumn("reason", reason)
    out = safety_rails(rows, keys, "__x", F.col("reason").isin("hard_bounds", "spike", "model"))
    return out.drop("__x", "__bound", "__mid", "__dev", "__mad")


def windows_to_samples(df: DataFrame, keys: list[str], order: str, scored: DataFrame, size: int, step: int, flag: str) -> DataFrame:
    """Column ``flag`` of samples: whether any window over them is flagged. Window k holds samples k * step to k * step + size - 1.

    Every sample is joined with its few windows (size / step of them), so no group grows with a recording.
    """
    rows = df.withColumn("__i", F.row_number().over(series(keys, order)) - 1)
    first = F.greatest(F.floor((F.col("__i") - size) / step) + 1, F.lit(0))
    cover = rows.select(*keys, "__i", F.explode(F.sequence(first, F.floor(F.col("__i") / step))).alias("window"))
    hit = cover.join(scored.where(F.col(flag)).select(*keys, "window").distinct(), [*keys, "window"], "left_semi").select(*keys, "__i").distinct().withColumn(flag, F.lit(True))
    return rows.join(hit, [*keys, "__i"], "left").withColumn(flag, F.coalesce(flag, F.lit(False))).drop("__i")


def fixed_windows(df: DataFrame, keys: list[str], order: str, value: str, size: int = 30) -> DataFrame:
    """Windows of ``size`` rows one after another (the last may be shorter): n, mean, sd, share missing and the flag of a simple scorer."""
    rows = df.withColumn("window", F.floor((F.row_number().over(series(keys, order)) - 1) / size))
    out = rows.groupBy(*keys, "window").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), (1 - F.count(value) / F.count("*")).alias("missing"))
    return out.withColumn("suspect", (F.col("missing") > 0.2) | F.coalesce(F.col("sd") < 1e-6, F.lit(True)))


def normalised(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Column ``z``: distance from the window's mean in its standard deviations."""
    w = Window.partitionBy(*keys)
    return df.withColumn("z", (F.col(value) - F.avg(value).over(w)) / (F.stddev_pop(value).over(w) + 1e-6))


def window_shape(df: DataFrame, keys: list[str], order: str, value: str, low: float, high: float, least: int = 10) -> DataFrame:
    """Nineteen features per window (a group of ``keys``) with at least ``least`` values.

    Peaks are local maxima three samples apart (see ``peaks``). A flat run is one of steps under a ten-thousandth of the
    range. Spikes are steps over five times the median one.
    """
    w = series(keys, order)
    whole = Window.partitionBy(*keys)
    n_all = df.groupBy(*keys).agg(F.count("*").alias("__all"), F.count(value).alias("__n")).where(F.col("__n") >= least)
    v = df.where(F.col(value).isNotNull()).withColumn("__i", F.row_number().over(w))
    x = F.col(value)
    v = v.withColumn("__step", F.abs(x - F.lag(value).over(w)))
    v = v.withColumn("__bend", F.abs(x - 2 * F.lag(value).over(w) + F.lag(value, 2).over(w)))
    tops = peaks(df, keys, order, value, distance=3)
    gap = F.col("at") - F.lag("at").over(Window.partitionBy(*keys).orderBy("at"))
    tops = tops.withColumn("__gap", gap).groupBy(*keys).agg(F.count("*").alias("__peaks"), F.avg("__gap").alias("__gap_mean"), F.stddev_pop("__gap").alias("__gap_sd"))
    span = F.max(value).over(whole) - F.min(value).over(whole)
    v = v.withColumn("__flat", F.col("__step") < F.greatest(F.lit(1e-9), span * 1e-4))
    v = v.withColumn("__run", F.sum(F.when(F.col("__flat"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = v.where("__flat").groupBy(*keys, "__run").count().groupBy(*keys).agg(F.max("count").alias("__longest"))
    v = v.withColumn("__mid_step", F.median("__step").over(whole))
    a = v.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.median(value).alias("median"), F.min(value).alias("min"), F.max(value).alias("max"),
        (F.max(value) - F.min(value)).alias("range"),
        (F.percentile(value, F.lit(0.75)) - F.percentile(value, F.lit(0.25))).alias("iqr"),
        F.countDistinct(value).alias("__distinct"), F.max("__step").alias("max_step"),
        F.count_if(F.col("__step") > 5 * F.col("__mid_step") + 1e-9).alias("n_spikes"),
        F.avg("__bend").alias("__bend"), F.regr_slope(x, F.col("__i").cast("double")).alias("__slope"),
        F.avg(x.between(low, high).cast("double")).alias("in_norm"), F.avg((x == 0).cast("double")).alias("zero"), F.avg((x < 0).cast("double")).alias("negative"),
    )
    out = n_all.join(a, keys).join(runs, keys, "left").join(tops, keys, "left").withColumn("n_peaks", F.coalesce("__peaks", F.lit(0)))
    regular = F.when(F.col("n_peaks") >= 3, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("__gap_sd") / (F.col("__gap_mean") + 1e-9)))).otherwise(0.0)
    out = out.withColumns({
        "missing": 1 - F.col("__n") / F.col("__all"),
        "peak_regularity": regular,
        "flat": F.coalesce("__longest", F.lit(0)) / F.col("__n"),
        "unique": F.col("__distinct") / F.col("__n"),
        "smoothness": F.coalesce("__bend", F.lit(0.0)) / (F.col("range") + 1e-9),
        "trend": F.col("__slope") * 100 / (F.col("sd") + 1e-9),
    })
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def learned_normals(df: DataFrame, family: str, value: str, clean: Column) -> DataFrame:
    """Percentiles 1, 50 and 99 and the count of the clean samples of every family: what a validator compares with.

    Quantiles are taken over counts per value, so that a family's samples needn't meet in one task.
    """
    counts = df.where(clean & F.col(value).isNotNull()).groupBy(family, value).agg(F.count("*").alias("n"))
    q = F.percentile(value, F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99)), F.col("n"))
    out = counts.groupBy(family).agg(q.alias("q"), F.sum("n").alias("n_clean"))
    return out.select(family, "n_clean", *[F.get("q", F.lit(i)).alias(f"p{p:02d}") for i, p in enumerate((1, 50, 99))])
