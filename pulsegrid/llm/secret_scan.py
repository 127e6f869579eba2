"""Secret scans over an incremental, content-addressed blob ledger; built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import BROADCAST_BYTES, materialize, maybe_broadcast


@dataclass(frozen=True)
class Rule:
    """A kind of secret: texts that ``gate`` may hold hold it; ``pattern`` has no groups but group 3, if ``value`` is set.

    Matches are leftmost and non-overlapping; those shorter than ``least`` characters, or whose value is, are dropped.
    """

    kind: str
    gate: str
    pattern: str
    least: int = 0
    value: int = 0


#: The three base kinds, in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"(?i)password|passwd|secret|token|api_?key",
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16}", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24}", r"[0-9a-f]+", least=24),
)
# No pattern repeats a group (Java's engine recurses there, and a long text ends its stack), and none of these has a
# repeat that can run through the start of another match, so that a text is read about once however it repeats them.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN ", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # Payload and signature; the header before them holds no secret.
    Rule("jwt", r"\.eyJ", r"\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # From the slashes on: name and password of any length.
    Rule("url_login", r"://", r"://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "2026.2"
LEDGER_SCHEMA = "blob string, rule_version string"


def _matches(text: Column, rule: Rule) -> Column:
    """Array of (skipped, length, value length) for each match in turn, in code points; the last may be empty.

    Each step takes the shortest run up to the next match or the end, so the whole text is read once.
    """
    pattern = F.lit(rf"(?s)(.*?)({rule.pattern}|\z)")
    group = lambda i: F.regexp_extract_all(text, pattern, F.lit(i))
    parts = F.arrays_zip(group(1).alias("skip"), group(2).alias("found"), group(3 if rule.value else 2).alias("value"))
    return F.transform(
        parts,
        lambda m: F.struct(
            F.length(m["skip"]).alias("skipped"), F.length(m["found"]).alias("length"), F.length(m["value"]).alias("value")
        ),
    )


def _numbered(matches: Column, rank: int) -> Column:
    return F.transform(
        matches,
        lambda m, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("at"), m["skipped"].alias("skipped"), m["length"].alias("length"), m["value"].alias("value")
        ),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, kind, rank (of the kind), start, end: what the rules find in the blobs (blob, content), each of them once."""
    found = None
    for rank, rule in enumerate(rules):
        gate = F.col("content").contains(rule.gate) if rule.gate.isalpha() or rule.gate == "://" else F.col("content").rlike(rule.gate)
        rows = F.when(gate, _numbered(_matches(F.col("content"), rule), rank))
        found = [*(found or []), F.coalesce(rows, F.array().cast("array<struct<rank:int,at:int,skipped:int,length:int,value:int>>"))]
    rows = blobs.select("blob", F.explode(F.flatten(F.array(*found))).alias("m")).select("blob", "m.*")
    # One exchange by blob serves the running sums here and the gathering later.
    rows = rows.repartition("blob").dropDuplicates(["blob", "rank", "at"])
    before = Window.partitionBy("blob", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("skipped").cast("long") + F.col("length")).over(before))
    rows = rows.withColumn("start", F.col("end") - F.col("length"))
    keep = F.col("length") > 0
    for rank, rule in enumerate(rules):
        short = (F.col("length") < rule.least) | (F.col("value") < rule.value)
        keep = keep & ~((F.col("rank") == rank) & short)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank") + 1)
    return rows.where(keep).select("blob", kind.alias("kind"), "rank", "start", "end")


def scan_versions(
    versions: DataFrame,
    path_col: str = "doc_id",
    content_col: str = "text",
    ledger: DataFrame | None = None,
    findings: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan every version of every path, but each blob once per version of the rules.

    A blob is the SHA-256 of a content (null: empty). ``ledger`` (blob, rule_version) tells what was scanned before and
    ``findings`` (blob, kind, rank, start, end, rule_version) what was found then. Returns (paths, findings, ledger):
    paths has one row per row of ``versions`` (path, blob, spans: array of rank, kind, start, end in order); the other
    two are whole, ready to be stored for the next run.

    Copies, repeated rows and paths with several versions have their blob scanned once. A path may be null. An empty
    table gives empty results. Other columns are ignored.
    """
    content = F.coalesce(F.col(content_col).cast("string"), F.lit(""))
    source = versions.select(F.col(path_col).alias("path"), content.alias("content"))
    source = source.select("path", "content", F.sha2(F.encode("content", "UTF-8"), 256).alias("blob"))
    paths = materialize(source.select("path", "blob"), "secret-paths")
    # min over structs, so that a blob whose paths are null has a place too.
    first = paths.groupBy("blob").agg(F.min(F.struct("path")).alias("at"))
    if ledger is not None:
        first = first.join(ledger.where(F.col("rule_version") == rule_version).select("blob").distinct(), "blob", "left_anti")
    unseen = first.select("blob", F.col("at.path").alias("path"))
    # Rows whose blob is scanned at another path or was scanned before: few, where copies are few.
    skip = paths.join(unseen.withColumn("new", F.lit(True)), (paths.blob == unseen.blob) & paths.path.eqNullSafe(unseen.path), "left_anti")
    skip = materialize(skip.select(F.col("path").alias("skip_path"), F.col("blob").alias("skip_blob")).distinct(), "secret-skip")
    todo = source.join(
        maybe_broadcast(skip, skip.count(), 96),
        (F.col("blob") == F.col("skip_blob")) & F.col("path").eqNullSafe(F.col("skip_path")),
        "left_anti",
    )
    new = materialize(scan_blobs(todo, rules).withColumn("rule_version", F.lit(rule_version)), "secret-findings")
    done = unseen.select("blob", F.lit(rule_version).alias("rule_version"))
    if ledger is not None:
        done = ledger.select("blob", "rule_version").unionByName(done)
    everything = new if findings is None else findings.select(new.columns).unionByName(new)
    order = F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end")))
    current = everything.where(F.col("rule_version") == rule_version)
    spans = current.groupBy("blob").agg(order.alias("spans"))
    # A finding takes under 64 bytes; its blob's address 64 more.
    size = current.count() * 128
    spans = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    out = paths.join(spans, "blob", "left").select("path", "blob", F.coalesce("spans", empty).alias("spans"))
    return out, everything, done


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
