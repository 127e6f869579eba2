"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontamination, divergence, exact_dedup, language_id, language_model, license_scan, mixing, near_dedup, oracles, packing, periodic_runs, quality, secret_scan, suffix_dedup
from pulsegrid.llm.common import documents, materialize

BPE = "byte_bpe_50k.json"
PIECES = "byte_bpe_multi_50k.tiktoken"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.drop("hamming")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language_id.held_out(folds=7, fold=2)
    found = language_model.score(documents(spark, sf_dir), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality.fit(docs, labels.where(~language_id.held_out()))
    found = quality.score(docs, machine)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    pieces = packing.pack_documents(docs, public_tokenizers.path(BPE), prompt_share=packing.PROMPT_SHARE, max_loss=packing.MAX_LOSS)
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.where(~language_id.held_out()), public_tokenizers.path(PIECES))
    found = language_id.predict(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _, _ = secret_scan.scan_versions(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE_RULES))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return paths.select(
        F.col("path").cast("long").alias("doc_id"),
        *[count(r.kind) for r in secret_scan.BASE_RULES],
        F.sha2(F.encode(secret_scan.spans_text(base), "UTF-8"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def secret_scan_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents after a first scan of the English ones: the same spans, and only the other blobs are scanned anew."""
    docs = documents(spark, sf_dir)
    _, found, ledger = secret_scan.scan_versions(docs.where("lang = 'en'"))
    found, ledger = materialize(found, "secret-stored-findings"), materialize(ledger, "secret-stored-ledger")
    paths, _, after = secret_scan.scan_versions(docs, ledger=ledger, findings=found)
    new = after.count() - ledger.count()
    return paths.select(F.col("path").cast("long").alias("doc_id"), secret_scan.spans_text(F.col("spans")).alias("spans"), F.lit(new).alias("n_new"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with the tails of about a tenth of the texts replaced by repeats of a few of their words, as op13 asks."""
    code = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(code / 10)
    words = F.when(code % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    out = docs.select("doc_id", "text", g.alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    out = out.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    out = out.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    tail = F.slice(again, F.lit(1), F.col("n") - F.col("a"))
    text = F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text"))
    return out.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_periods(documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n"))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(F.transform("runs", line), ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language_model": op4_language_model,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality": op6_quality,
    "op7_near_dedup": op7_near_dedup,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_source_divergence": op11_source_divergence,
    "op12_source_mix": op12_source_mix,
    "op13_periodic_runs": op13_periodic_runs,
    "secret_scan_again": secret_scan_again,
}

ORACLE_SQL = {
    "op1_license_scan": oracles.license_sql(),
    "op2_decontamination": oracles.LEAKS,
    "op10_secret_scan": oracles.secret_sql(),
    "op11_source_divergence": oracles.DIVERGENCE,
    "op12_source_mix": oracles.MIX,
    "secret_scan_again": f"""
WITH en AS (SELECT DISTINCT coalesce(text, '') AS t FROM documents WHERE lang = 'en')
SELECT doc_id, spans, (SELECT count(DISTINCT coalesce(text, '')) FROM documents WHERE coalesce(text, '') NOT IN (SELECT t FROM en)) AS n_new
FROM ({oracles.secret_sql()})""",
    "op5_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n""",
}
