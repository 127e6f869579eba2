"""Where files belong: source, subject, session, stage and place from their paths, with the evidence."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Folder that each stage of a file has below a project's database.
LAYERS = {"RAW": "RawData", "EXTRACTED": "ExtractedData", "DERIVED": "AnalyzedData", "METADATA": "Metadata"}


@dataclass(frozen=True)
class NameRule:
    """What a file's name tells: the first rule of a list whose pattern it has decides."""

    pattern: str
    source: str | None
    stage: str
    confidence: str = "high"


def plain(text: Column) -> Column:
    """Lower-cased, separators as one space, without digits at the end."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[\s_-]+", " "), r"\s*[0-9]+$", ""))


def _first_rule(name: Column, rules: list[NameRule], what: str) -> Column:
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(name.rlike(r.pattern), F.lit(getattr(r, what))).otherwise(out)
    return out


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def classify(
    files: DataFrame, path: str, rules: list[NameRule], aliases: Mapping[str, str], subject: str, ignored: tuple[str, ...] = (), derived: tuple[str, ...] = (), wrappers: tuple[str, ...] = ("database", "rawdata")
) -> DataFrame:
    """Columns project, subject, source, evidence, stage, confidence, session_date, canonical_path and notes.

    A path is PROJECT/folders/name. The name's rule and the deepest source folder (``aliases``: plain folder name to
    source) tell the source; where they disagree a rule of high confidence wins, else the folder, and evidence is
    ``conflict``. ``subject`` is a pattern with one group for folder names that are neither wrappers nor sources, then
    for the file's name. Files in ``ignored`` folders are IGNORE; raw ones in ``derived`` folders DERIVED. The canonical
    path keeps what follows the last folder that carries any of this.
    """
    c = F.col
    parts = F.filter(F.split(F.regexp_replace(path, r"\\", "/"), "/"), lambda p: p != "")
    rows = files.withColumn("__parts", parts)
    rows = rows.withColumn("project", F.get("__parts", F.lit(0))).withColumn("__name", F.element_at("__parts", -1))
    rows = rows.withColumn("__folders", F.when(F.size("__parts") > 2, F.slice("__parts", 2, F.greatest(F.size("__parts") - 2, F.lit(0)))).otherwise(F.array().cast("array<string>")))
    named = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    rows = rows.withColumn("__plain", F.transform("__folders", plain))
    rows = rows.withColumn("__sources", F.transform("__plain", lambda p: named[p]))
    place = F.transform("__sources", lambda s, i: F.when(s.isNotNull(), i))
    rows = rows.withColumn("__source_at", F.array_max(place))
    rows = rows.withColumn("__by_folder", F.get("__sources", c("__source_at"))).withColumn("__by_name", _first_rule(F.lower("__name"), rules, "source"))
    rows = rows.withColumn("__rule_stage", _first_rule(F.lower("__name"), rules, "stage")).withColumn("confidence", F.coalesce(_first_rule(F.lower("__name"), rules, "confidence"), F.when(c("__by_folder").isNotNull(), "low"), F.lit("none")))
    conflict = c("__by_name") != c("__by_folder")
    rows = rows.withColumn("source", F.when(conflict & (c("confidence") != "high"), c("__by_folder")).otherwise(F.coalesce("__by_name", "__by_folder")))
    evidence = (
        F.when(conflict, "conflict").when(c("__by_name").isNotNull() & c("__by_folder").isNotNull(), "both").when(c("__by_name").isNotNull(), "filename")
        .when(c("__by_folder").isNotNull(), "folder").otherwise("none")
    )
    rows = rows.withColumn("evidence", evidence)
    number = lambda f: F.regexp_extract(F.trim(f), subject, 1)
    usable = lambda p, s: ~p.isin(*wrappers) & s.isNull()
    hits = F.transform(F.arrays_zip("__folders", "__plain", "__sources"), lambda z, i: F.when(usable(z["__plain"], z["__sources"]) & (number(z["__folders"]) != ""), F.struct(i.alias("i"), number(z["__folders"]).alias("s"))))
    rows = rows.withColumn("__hit", F.get(F.array_compact(hits), F.lit(0)))
    by_name = F.nullif(number(F.regexp_replace("__name", r"\.[^.]*$", "")), F.lit(""))
    rows = rows.withColumn("subject", F.coalesce(c("__hit.s"), by_name).cast("int").cast("string"))
    stage = F.coalesce("__rule_stage", F.when(c("__by_folder").isNotNull(), "RAW"), F.lit("UNKNOWN"))
    in_derived = F.exists("__plain", lambda p: _any([p.startswith(d) for d in derived]))
    rows = rows.withColumn("stage", F.when(F.exists("__plain", lambda p: p.isin(*ignored)) if ignored else F.lit(False), "IGNORE").when(stage.isin("RAW", "EXTRACTED") & in_derived, "DERIVED").otherwise(stage))
    dated = F.filter(F.transform(F.reverse("__folders"), lambda f: F.regexp_extract(f, r"((?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9])", 1)), lambda d: d != "")
    rows = rows.withColumn("session_date", F.coalesce(F.nullif(F.regexp_extract("__name", r"((?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9])", 1), F.lit("")), F.get(dated, F.lit(0))))
    wrapper_at = F.array_max(F.transform("__plain", lambda p, i: F.when(p.isin(*wrappers), i)))
    anchor = F.greatest(F.coalesce(c("__hit.i"), F.lit(-1)), F.coalesce("__source_at", F.lit(-1)), F.coalesce(wrapper_at, F.lit(-1)))
    tail = F.concat(F.slice("__folders", anchor + 2, F.greatest(F.size("__folders") - anchor - 1, F.lit(0))), F.array("__name"))
    layer = F.create_map(*[F.lit(x) for kv in LAYERS.items() for x in kv])[c("stage")]
    middle = F.when(c("stage") == "METADATA", F.array().cast("array<string>")).otherwise(F.array(F.coalesce("subject", F.lit("_unassigned")), F.coalesce("source", F.lit("_unknown"))))
    rows = rows.withColumn("canonical_path", F.when(layer.isNotNull(), F.array_join(F.concat(F.array(c("project"), F.lit("Database"), layer), middle, tail), "/")))
    notes = F.array_compact(F.array(F.when(conflict, F.concat(F.lit("folder says "), "__by_folder", F.lit(", name says "), "__by_name")), F.when(c("subject").isNull() & ~c("stage").isin("METADATA", "IGNORE"), "subject not found in path")))
    rows = rows.withColumn("notes", F.array_join(notes, "; "))
    return rows.drop(*[x for x in rows.columns if x.startswith("__")])


def review_reason(status: Column, subject: Column, source: Column, stage: Column) -> Column:
    """Why a classified file needs a look; null if it doesn't."""
    stage = F.coalesce(stage, F.lit(""))
    return (
        F.when(status == "review", "layout not confirmed").when(status == "UNCONFIGURED", "project not configured").when(F.coalesce(subject, F.lit("")) == "", "subject not found")
        .when((F.coalesce(source, F.lit("")) == "") & ~stage.isin("METADATA", "DERIVED"), "source unknown").when(stage.isin("UNKNOWN", ""), "no rule")
    )


def earlier_places(project: Column, relative: Column, dropped: str = "Database/RawData/") -> Column:
    """Candidates for where an earlier layout had a file: without the dropped prefix first, if it has it."""
    whole = F.concat_ws("/", project, relative)
    below = F.concat_ws("/", project, F.substring(relative, F.lit(len(dropped) + 1), F.length(relative)))
    return F.when(F.lower(relative).startswith(dropped.lower()), F.array(below, whole)).otherwise(F.array(whole))


def in_scope(path: Column, roots: list[str], excluded: list[str]) -> Column:
    """out (under no root), excluded (some segment is) or in."""
    inside = _any([path.startswith(r.rstrip("/") + "/") for r in roots])
    hit = F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*[F.lit(e.lower()) for e in excluded])) if excluded else F.lit(False)
    return F.when(~inside, "out").when(hit, "excluded").otherwise("in")


def folder_decision(folder: Column, included: list[str], excluded: list[str]) -> Column:
    """include, exclude or unknown: what no rule names is reported, not skipped."""
    return F.when(folder.isin(*excluded), "exclude").when(folder.isin(*included), "include").otherwise("unknown")


def case_renames(paths: DataFrame, path: str, wanted: DataFrame, wanted_path: str) -> DataFrame:
    """(path, wanted) where they differ by case only; a lower-cased path that several wanted ones share isn't decided."""
    w = wanted.select(F.col(wanted_path).alias("wanted"), F.lower(wanted_path).alias("__low"))
    one = w.groupBy("__low").agg(F.min("wanted").alias("wanted"), F.countDistinct("wanted").alias("__n")).where("__n = 1").drop("__n")
    return paths.select(path).distinct().join(one, F.lower(path) == F.col("__low")).where(F.col(path) != F.col("wanted")).select(path, "wanted")


def numbered(folders: DataFrame, study: str, folder: str, pattern: str) -> DataFrame:
    """Column ``number`` of every distinct folder of a study: its explicit number (first group of ``pattern``), and for the
    others the next ones after the greatest explicit, in order; of folders with one number the first keeps it."""
    rows = folders.select(study, folder).distinct()
    said = F.nullif(F.regexp_extract(F.lower(folder), pattern, 1), F.lit("")).cast("int")
    rows = rows.withColumn("__said", said)
    rows = rows.withColumn("__first", F.row_number().over(Window.partitionBy(study, "__said").orderBy(folder)) == 1)
    rows = rows.withColumn("__said", F.when(F.col("__first"), F.col("__said")))
    most = F.coalesce(F.max("__said").over(Window.partitionBy(study)), F.lit(0))
    place = F.row_number().over(Window.partitionBy(study, F.col("__said").isNull()).orderBy(folder))
    return rows.withColumn("number", F.coalesce("__said", most + place)).drop("__said", "__first")


def document_place(path: Column, rules: list[tuple[str, str]]) -> Column:
    """Target folder of a document by the first rule (pattern over the lower-cased path, target) that fits, with its name."""
    out = F.lit(None).cast("string")
    for pattern, target in reversed(rules):
        out = F.when(F.lower(path).rlike(pattern), F.concat(F.lit(target + "/"), F.element_at(F.split(path, "/"), -1))).otherwise(out)
    return out


def with_subjects(blobs: DataFrame, path: str, state: DataFrame, pattern: str) -> DataFrame:
    """Column ``subject``: from the state table (path, subject), else the pattern's group, else the path's first digits."""
    s = state.select(F.col(path).alias("__path"), F.col("subject").alias("__known")).dropDuplicates(["__path"])
    rows = blobs.join(s, F.col(path) == F.col("__path"), "left")
    digits = F.nullif(F.regexp_extract(path, r"([0-9]+)", 1), F.lit(""))
    return rows.withColumn("subject", F.coalesce("__known", F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), digits)).drop("__path", "__known")


def seconds_of_day(time: Column) -> Column:
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def workbook_kind(path: Column, tokens: tuple[str, ...] = ("demograph", "patient", "participant", "master")) -> Column:
    """Where a workbook of demographics lies (metadata, root or elsewhere); null for other files."""
    named = F.lower(F.element_at(F.split(path, "/"), -1)).rlike("(" + "|".join(tokens) + r").*\.(xlsx?|ods|csv)$")
    place = F.when(F.lower(path).contains("/metadata/"), "metadata").when(F.size(F.split(path, "/")) <= 2, "root").otherwise("elsewhere")
    return F.when(named, place)
