"""Censuses of files and columns: reviews, drift, continuity, problems and what recovers a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.rules import extension


def unmapped(columns: DataFrame, keys: list[str], name: str, variable: str, most: int = 8) -> DataFrame:
    """Per source the number of columns without a variable, and the first ``most`` of their names."""
    rows = columns.where(F.trim(F.coalesce(F.col(variable), F.lit(""))) == "")
    place = Window.partitionBy(*keys).orderBy(name)
    rows = rows.withColumn("__k", F.row_number().over(place))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_unmapped"), F.array_sort(F.collect_list(F.when(F.col("__k") <= most, F.col(name)))).alias("examples"))


def most_repeated(files: DataFrame, keys: list[str], name: str, file: str, top: int = 15) -> DataFrame:
    """The ``top`` columns that stand more than once in one file, by the number of such files."""
    per = files.groupBy(*keys, name, file).agg(F.count("*").alias("__n")).where("__n > 1")
    out = per.groupBy(*keys, name).agg(F.count("*").alias("n_files"), F.max("__n").alias("most_in_one"))
    return out.orderBy(F.desc("n_files"), *keys, name).limit(top)


def in_one_unit(columns: DataFrame, keys: list[str], name: str, unit: str) -> DataFrame:
    """Per source the number of columns that exactly one unit has."""
    per = columns.groupBy(*keys, name).agg(F.countDistinct(unit).alias("__n")).where("__n = 1")
    return per.groupBy(*keys).agg(F.count("*").alias("n_single"))


def round_robin(files: DataFrame, keys: list[str], device: str, order: str, n: int) -> DataFrame:
    """``n`` files of every project, a device's turn at a time, so that every device is seen."""
    turn = F.row_number().over(Window.partitionBy(*keys, device).orderBy(order))
    rows = files.withColumn("__turn", turn)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("__turn", device, order))).where(F.col("place") <= n).drop("__turn")


def schema_drift(columns: DataFrame, keys: list[str], name: str, file: str) -> DataFrame:
    """Columns that not all files of a project have, with how many do."""
    total = columns.groupBy(*keys).agg(F.countDistinct(file).alias("n_files"))
    out = columns.groupBy(*keys, name).agg(F.countDistinct(file).alias("seen_in"))
    return out.join(total, keys).where("seen_in < n_files")


def continuity(ingested: DataFrame, processed: DataFrame, drawn: DataFrame, key: str, unit: str) -> DataFrame:
    """Per project: ingested, processed and drawn units, what is missing or extra, ratios, and whether the chain holds.

    processed has source_unit and n_rows: a unit whose source wasn't ingested, or that has no rows, breaks the chain.
    """
    i, p, d = (x.select(key, F.col(unit).alias("u")).distinct() for x in (ingested, processed, drawn))
    rows = i.withColumn("i", F.lit(1)).join(p.withColumn("p", F.lit(1)), [key, "u"], "full").join(d.withColumn("d", F.lit(1)), [key, "u"], "left")
    known = ingested.select(F.col(unit).alias("source_unit")).distinct().withColumn("known", F.lit(True))
    broken = processed.join(known, "source_unit", "left")
    broken = broken.groupBy(key).agg(F.count_if((F.col("source_unit").isNotNull() & F.col("known").isNull()) | (F.col("n_rows") == 0)).alias("n_broken"))
    out = rows.groupBy(key).agg(
        F.count("i").alias("n_ingested"), F.count("p").alias("n_processed"), F.count_if(F.col("i").isNotNull() & F.col("p").isNull()).alias("n_missing"),
        F.count_if(F.col("i").isNull() & F.col("p").isNotNull()).alias("n_extra"), F.count_if(F.col("p").isNotNull() & F.col("d").isNotNull()).alias("n_drawn"),
    )
    out = out.join(broken, key, "left").withColumn("n_broken", F.coalesce("n_broken", F.lit(0)))
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return out.withColumns({"preserved": share("n_processed", "n_ingested"), "drawn": share("n_drawn", "n_processed"), "ok": (F.col("n_missing") == 0) & (F.col("n_broken") == 0)})


def problems(status: DataFrame, rules: list[tuple[str, Column, str, Column]]) -> DataFrame:
    """One row per tool and problem: source, severity, detail. rules: (source, condition, severity, detail)."""
    found = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(s).alias("source"), F.lit(sev).alias("severity"), d.cast("string").alias("detail"))) for s, cond, sev, d in rules]))
    return status.select("*", F.explode(found).alias("__p")).select(*status.columns, "__p.*")


def worst_severity(found: DataFrame, keys: list[str], order: tuple[str, ...] = ("high", "medium", "low")) -> DataFrame:
    """Per key the number of problems of each severity, the worst one, and whether it needs attention (high, or three medium)."""
    n = [F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in order]
    out = found.groupBy(*keys).agg(*n)
    worst = F.lit(None).cast("string")
    for s in reversed(order):
        worst = F.when(F.col(f"n_{s}") > 0, s).otherwise(worst)
    return out.withColumn("worst", worst).withColumn("attention", (F.col(f"n_{order[0]}") > 0) | (F.col(f"n_{order[1]}") >= 3))


def linkage(columns: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Identifier columns inside standardised files per project, and the finding if there are any."""
    out = columns.groupBy(*keys).agg(F.count_if(F.col(kind) == "identifier").alias("n_identifier"))
    return out.withColumn("finding", F.when(F.col("n_identifier") > 0, "identifier columns in standardised files: review before release"))


def formats(files: DataFrame, keys: list[str], path: str, size: str) -> DataFrame:
    """Files and bytes per extension."""
    return files.groupBy(*keys, F.coalesce(F.nullif(extension(F.col(path)), F.lit("")), F.lit("(none)")).alias("ext")).agg(F.count("*").alias("n_files"), F.sum(size).alias("n_bytes"))


def header_at(lines: Column, at: int, delimiters: tuple[str, ...] = (";", ",", "\t", "|")) -> Column:
    """The columns of a header line (two or more, by the delimiter that gives most), the line where they stand if below
    ``at``, and why there are none: empty_file, short_head, blank_file or content_unparseable.

    ``lines`` are the first lines of a file.
    """

    def parsed(line: Column) -> Column:
        out = F.array().cast("array<string>")
        for d in reversed(delimiters):
            cut = F.transform(F.split(line, "[" + ("\\t" if d == "\t" else d) + "]"), lambda x: F.trim(F.trim(F.trim(x), F.lit('"'))))
            out = F.when((F.size(cut) >= 2) & (F.size(cut) >= F.size(out)), cut).otherwise(out)
        return out

    below = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda r: (r["i"] > at) & (F.trim(r["x"]) != ""))
    first, none = F.get(below, F.lit(0)), F.array().cast("array<string>")
    here = parsed(F.coalesce(F.get(lines, F.lit(at)), F.lit("")))
    result = lambda cols, off, why: F.struct(cols.alias("columns"), off.cast("int").alias("offset"), why.alias("reason"))
    null = F.lit(None)
    return (
        F.when(F.size(lines) == 0, result(none, null, F.lit("empty_file")))
        .when(F.size(lines) <= at, result(none, null, F.lit("short_head")))
        .when(F.size(here) >= 2, result(here, null, F.lit("")))
        .when(first.isNull(), result(none, null, F.lit("blank_file")))
        .when(F.size(parsed(first["x"])) >= 2, result(parsed(first["x"]), first["i"], F.lit("")))
        .otherwise(result(none, null, F.lit("content_unparseable")))
    )


def json_inventory(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Top-level keys of JSON objects with the kind of each value and how often it stands; what isn't an object is one row
    of kind ``array`` or ``unparseable``."""
    as_map = F.from_json(F.col(text), "map<string,string>")
    is_object, is_array = F.trim(text).startswith("{") & as_map.isNotNull(), F.trim(text).startswith("[") & F.json_array_length(text).isNotNull()
    rows = df.select(*keys, F.when(is_object, as_map).alias("m"), is_array.alias("a"))
    v = F.col("value")
    kind = (
        F.when(v.isNull(), "null").when(v.rlike(r"^\s*\{"), "object").when(v.rlike(r"^\s*\["), "array").when(v.isin("true", "false"), "boolean")
        .when(v.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), "number").otherwise("string")
    )
    inside = rows.where("m is not null").select(*keys, F.explode("m")).select(*keys, "key", kind.alias("kind"))
    other = rows.where("m is null").select(*keys, F.lit("").alias("key"), F.when(F.col("a"), "array").otherwise("unparseable").alias("kind"))
    return inside.unionByName(other).groupBy(*keys, "key", "kind").agg(F.count("*").alias("n"))


def top(df: DataFrame, keys: list[str], score: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the greatest score; of equals those first by ``tie``."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), tie))
    return df.withColumn("place", place).where(F.col("place") <= n)


def set_comparison(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many distinct keys both tables share, and how many each has alone."""
    x, y = (d.select(*keys).distinct() for d in (a, b))
    both = x.withColumn("__a", F.lit(1)).join(y.withColumn("__b", F.lit(1)), keys, "full")
    return both.agg(F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("n_both"), F.count_if(F.col("__b").isNull()).alias("n_left_only"), F.count_if(F.col("__a").isNull()).alias("n_right_only"))
