"""Variable dictionaries, profiles and names: small configuration on the driver, applied as column expressions."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.columns import base_name, normal_key, without_copy_suffix


def deep_merge(base: Mapping, override: Mapping) -> dict:
    """``override`` over ``base``; mappings are merged, everything else is replaced."""
    out = dict(base)
    for key, value in override.items():
        out[key] = deep_merge(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else value
    return out


def profile(profiles: Mapping[str, Mapping], name: str) -> dict:
    """A profile over those it extends; a circle is an error."""
    chain, at = [], name
    while at:
        if at in chain:
            raise ValueError(f"profiles extend in a circle: {' > '.join([*chain, at])}")
        chain.append(at)
        at = profiles[at].get("extends")
    out: dict = {}
    for at in reversed(chain):
        out = deep_merge(out, profiles[at])
    out.pop("extends", None)
    return out


def overlay(configs: Mapping[str, Mapping], master: Mapping[str, Mapping]) -> tuple[dict, list[str]]:
    """Hard ranges of the master dictionary over signal configurations; what it changes is told, what it alone has is added."""
    out, changed = {k: dict(v) for k, v in configs.items()}, []
    for code, spec in master.items():
        own = out.setdefault(code, {})
        for bound in ("min", "max"):
            if spec.get(bound) is not None:
                if own.get(bound) is not None and own[bound] != spec[bound]:
                    changed.append(f"{code}.{bound}: {own[bound]} -> {spec[bound]}")
                own[bound] = spec[bound]
    return out, changed


def unknown_methods(configs: Mapping[str, Mapping], known: Iterable[str]) -> list[str]:
    """Detector and filter names that no code implements; they are reported, never skipped in silence."""
    names = {(code, m) for code, c in configs.items() for m in [*c.get("detectors", []), *([c["filter"]] if c.get("filter") else [])]}
    return sorted(f"{code}: {m}" for code, m in names if m not in set(known))


def alias_table(spark: SparkSession, variables: Mapping[str, Iterable[str]]) -> DataFrame:
    """alias, variable: every name of a variable, compared by its key; the first variable of an alias wins."""
    seen: dict[str, str] = {}
    for variable, aliases in variables.items():
        for a in [variable, *aliases]:
            seen.setdefault(re.sub(r"\s+", " ", a.replace('"', "").replace("'", "")).strip().lower(), variable)
    return spark.createDataFrame(sorted(seen.items()), "alias string, variable string")


def map_columns(columns: DataFrame, name: str, aliases: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Columns ``variable`` and ``tier`` of headings: alias_exact, alias_base (unit and copy suffix off), classified by the
    first rule (regular expression, class) that fits, or review."""
    one, two = (aliases.select(F.col("alias").alias(f"__{t}"), F.col("variable").alias(f"__v{t}")) for t in "eb")
    rows = columns.withColumn("__exact", normal_key(F.col(name)))
    rows = rows.withColumn("__base", F.lower(base_name(without_copy_suffix(F.col("__exact")))))
    rows = rows.join(one, F.col("__exact") == F.col("__e"), "left").join(two, F.col("__base") == F.col("__b"), "left")
    kind: Column = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        kind = F.when(F.col("__base").rlike(pattern), label).otherwise(kind)
    rows = rows.withColumn("__kind", kind)
    tier = F.when(F.col("__ve").isNotNull(), "alias_exact").when(F.col("__vb").isNotNull(), "alias_base").when(F.col("__kind").isNotNull(), "classified").otherwise("review")
    rows = rows.withColumn("variable", F.coalesce("__ve", "__vb", "__kind")).withColumn("tier", tier)
    return rows.drop("__exact", "__base", "__e", "__ve", "__b", "__vb", "__kind")


def matches_any(text: Column, globs: Iterable[str]) -> Column:
    """Whether a name fits one of some globs."""
    patterns = [fnmatch.translate(g).removeprefix("(?s:").removesuffix(r")\z").removesuffix(r")\Z") for g in globs]
    return text.rlike("^(?s:" + "|".join(patterns) + ")$") if patterns else F.lit(False)


def tier(name: Column, ignored: list[str], parsed: list[str], kept: list[str]) -> Column:
    """C for ignored files, then A for parsed ones, then B for those kept as they are; null for none of them."""
    return F.when(matches_any(name, ignored), "C").when(matches_any(name, parsed), "A").when(matches_any(name, kept), "B")


#: Ordered: cuff pressure goes before invasive pressure, whose name it contains. Signals of monitors by their usual names.
FAMILIES = (
    ("NIBP", "NIBP|NBP"), ("IBP", r"\bART|IBP|\bABP"), ("SPO2", "SPO2|SAT"), ("ECG", "ECG"), ("HR", r"^HR(?![A-Z])|^PULSE"),
    ("RR", r"^RR(?![A-Z])|RESP"), ("TEMP", "TEMP"), ("ETCO2", "CO2"), ("BIS", "BIS"), ("NOL", "NOL"),
)


def family(name: Column, rules=FAMILIES) -> Column:
    plain = F.upper(base_name(name))
    out: Column | None = None
    for label, pattern in rules:
        out = F.when(plain.rlike(pattern), label) if out is None else out.when(plain.rlike(pattern), label)
    return out.otherwise("OTHER")


def path_part(path: Column, pattern: str) -> Column:
    """The first segment of a path that fits a pattern; null without one."""
    return F.get(F.filter(F.split(path, "/"), lambda s: s.rlike(pattern)), F.lit(0))


def classify_paths(files: DataFrame, path: str, rules: list[tuple[str, str, str]], folders: Mapping[str, str]) -> DataFrame:
    """Source, stage and subject of files by path, with the evidence.

    rules: (file name pattern, source, stage), the first that fits; folders: segment to source. Where name and folder
    disagree the row needs review and the name wins.
    """
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    source = stage = F.lit(None).cast("string")
    for pattern, s, g in reversed(rules):
        source, stage = F.when(name.rlike(pattern), s).otherwise(source), F.when(name.rlike(pattern), g).otherwise(stage)
    table = F.create_map(*[F.lit(x) for kv in folders.items() for x in kv])
    found = F.get(F.filter(F.transform(F.split(F.lower(F.col(path)), "/"), lambda s: table[s]), lambda x: x.isNotNull()), F.lit(0))
    out = files.withColumn("__name", source).withColumn("__folder", found).withColumn("stage", stage)
    out = out.withColumn("source", F.coalesce("__name", "__folder"))
    review = F.col("source").isNull() | (F.col("__name") != F.col("__folder"))
    out = out.withColumn("needs_review", F.coalesce(review, F.lit(False)))
    subject = F.lpad(F.nullif(F.regexp_extract(F.col(path), r"(?i)(?:patient|pt|p|case|subject)[ _-]?(\d{1,4})", 1), F.lit("")), 3, "0")
    return out.withColumn("subject", subject).drop("__name", "__folder")
