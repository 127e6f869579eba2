"""Exact deduplication by an extendible-hash index on shared files."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import few_rows, id_and_text, materialize, maybe_broadcast, release, slices, table_path

#: Bytes of text that one bucket holds before the directory doubles, and that one owner compares at a time.
BUCKET_BYTES = 8 << 20
#: An owner of part of a hot key gets so many rows at least, however long they are.
LEAST_ROWS = 16

_SPACE = b" \t\n\x0b\x0c\r"


def normalise(text: str | None) -> bytes:
    """UTF-8 bytes with each run of [\\x20\\x09-\\x0D] as one space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return b""
    words = raw.split()  # bytes.split() takes exactly these six characters as white space
    if not words:
        return b" "
    return b" " * (raw[0] in _SPACE) + b" ".join(words) + b" " * (raw[-1] in _SPACE)


def default_key(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def _keys(key_of):
    out = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.string())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                rows = [(key_of(b := normalise(t)), len(b), hashlib.sha256(b).hexdigest()) for t in part.column(1).to_pylist()]
                key, size, sha = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(key, pa.int64()), pa.array(size, pa.int64()), pa.array(sha)], schema=out
                )
        release()

    return run


def _texts(key_of):
    out = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("content", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                raw = [normalise(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array([key_of(b) for b in raw], pa.int64()), pa.array(raw, pa.binary())], schema=out
                )
        release()

    return run


def directory(keys: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, list[int]]:
    """The extendible-hash directory over rows of distinct keys (key, n_bytes): its global depth and 2**depth bucket numbers.

    It starts with one bucket and doubles as long as some bucket holds more bytes than ``bucket_bytes``; slots of
    buckets that needn't split share one. n_bytes is what one owner of the key gets, all copies counted.
    """
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    depth = (total // bucket_bytes * 4).bit_length()
    slot = F.shiftrightunsigned(F.col("key"), 64 - depth) if depth else F.lit(0).cast("long")
    # At most 2**depth sums, about four to a bucket of data: a description of the directory, not of the keys.
    sizes = {r["slot"]: r["size"] for r in keys.groupBy(slot.alias("slot")).agg(F.sum("n_bytes").alias("size")).collect()}
    slots = [0] * (1 << depth)
    buckets = 0

    def split(begin: int, length: int) -> int:
        """Gives the slots of one bucket their number; returns the deepest local depth."""
        nonlocal buckets
        if length == 1 or sum(sizes.get(i, 0) for i in range(begin, begin + length)) <= bucket_bytes:
            for i in range(begin, begin + length):
                slots[i] = buckets
            buckets += 1
            return depth - length.bit_length() + 1
        half = length // 2
        return max(split(begin, half), split(begin + half, half))

    used = split(0, 1 << depth)
    return used, slots[:: 1 << (depth - used)]


_CHAINED = "doc_id long, key long, bucket long, owners long, head_id long, head boolean, content binary"


def _chain(rows: pa.Table) -> pa.Table:
    """One owner's keys: each key has a chain of its distinct contents, found by comparing bytes."""
    doc_id, key = rows.column("doc_id").to_pylist(), rows.column("key").to_pylist()
    content = rows.column("content")
    chains: dict[int, list[list]] = {}
    found: list[list] = []
    for i, k in enumerate(key):
        raw = content[i].as_py()
        for head in (chain := chains.setdefault(k, [])):
            if head[0] == raw:
                break
        else:
            chain.append(head := [raw, None])
        if doc_id[i] is not None and (head[1] is None or doc_id[i] < head[1]):
            head[1] = doc_id[i]
        found.append(head)
    waiting = {id(h): h[0] for h in found}
    kept = [waiting.pop(id(h), None) for h in found]
    return pa.table(
        {
            "doc_id": pa.array(doc_id, pa.int64()),
            "key": pa.array(key, pa.int64()),
            "bucket": rows.column("bucket"),
            "owners": rows.column("owners"),
            "head_id": pa.array([h[1] for h in found], pa.int64()),
            "head": pa.array([k is not None for k in kept], pa.bool_()),
            "content": pa.array(kept, pa.binary()),
        }
    )


def _owners(n, size, bucket_bytes: int):
    return F.greatest(F.lit(1), F.least(F.ceil(size / bucket_bytes), F.ceil(n / LEAST_ROWS))).cast("long")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, key_of=default_key
) -> DataFrame:
    """Classes of texts that are equal once runs of ASCII white space are one space.

    One row per input row: doc_id, keep_id (smallest id of the class), group_size, kept, text_sha256 (of the normalised
    text). Every row's 64-bit key is counted. A key that only one row has is settled by that; texts of the others are
    read again, written to the index's bucket files and compared byte by byte by the owners of the buckets. Buckets split
    by the bytes of all rows, copies included, so an owner of many keys gets about a bucket. A key whose rows outgrow a
    bucket is dealt to several owners, whose distinct contents meet in a next round.

    Null and empty texts are equal to each other. Rows with a null id never give a class its keep_id unless all its ids
    are null. Of repeated rows (same id, same text) one is kept, all count in group_size. An empty table gives no rows.
    Other columns are ignored.
    """
    source = id_and_text(docs, id_col, text_col)
    keys = materialize(source.mapInArrow(_keys(key_of), "doc_id long, key long, n_bytes long, text_sha256 string"), "exact-keys")
    shared = materialize(
        keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("size")).where("n > 1"),
        "exact-shared",
    )
    n_shared = shared.count()
    owners = _owners(F.col("n"), F.col("size"), bucket_bytes)
    depth, slots = directory(shared.select("key", F.ceil(F.col("size") / owners).cast("long").alias("n_bytes")), bucket_bytes)
    slot = F.shiftrightunsigned(F.col("key"), 64 - depth) if depth else F.lit(0).cast("long")
    pointers = few_rows(docs.sparkSession, slot=list(range(len(slots))), bucket=slots)
    wanted = shared.select("key", owners.alias("owners"), slot.alias("slot"))
    wanted = wanted.join(maybe_broadcast(pointers, len(slots), 16), "slot").drop("slot")
    texts = source.mapInArrow(_texts(key_of), "doc_id long, key long, content binary")
    rows = texts.join(maybe_broadcast(wanted, n_shared, 32), "key")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("owners")))
    path, level, mapping, before, last = table_path(docs.sparkSession, "exact-index"), 0, None, None, False
    while True:
        # The bucket files: an owner's rows lie together, and a lost owner reads them again.
        at = f"{path}/level-{level}"
        rows.repartition("bucket", "salt").write.parquet(at)
        index = docs.sparkSession.read.parquet(at)
        out = materialize(index.groupBy("bucket", "salt").applyInArrow(_chain, _CHAINED), "exact-chained")
        step = out.select("doc_id", "key", "head_id").distinct()
        if mapping is None:
            mapping = step
        else:
            step = step.select(F.col("doc_id").alias("h"), F.col("key").alias("k"), F.col("head_id").alias("next_id"), F.lit(True).alias("moved"))
            mapping = mapping.join(step, F.col("head_id").eqNullSafe(F.col("h")) & (F.col("key") == F.col("k")), "left")
            mapping = materialize(
                mapping.select("doc_id", "key", F.when(F.col("moved"), F.col("next_id")).otherwise(F.col("head_id")).alias("head_id")), "exact-mapping"
            )
        heads = out.where(F.col("head") & (F.col("owners") > 1))
        weight = heads.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("size"))
        most, now = weight.agg(F.max("n"), F.sum("n")).first()
        if last or not now:
            break
        # As long as copies spread over many owners, halve them again; then equal contents go to one owner and it ends.
        last = most <= 4096 or (before is not None and now * 2 > before)
        before, level = now, level + 1
        weight = weight.select("key", _owners(F.col("n"), F.col("size"), bucket_bytes).alias("owners"))
        rows = heads.drop("owners", "head", "doc_id").withColumnRenamed("head_id", "doc_id").join(weight, "key")
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("content" if last else "doc_id"), F.col("owners")))
    sizes = keys.select("doc_id", "key").join(shared.select("key"), "key", "left_semi")
    mapping = mapping.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("head_id"), F.lit(True).alias("chained"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))
    sizes = sizes.join(mapping, same).groupBy(F.col("key").alias("sk"), F.col("head_id").alias("sh")).agg(F.count("*").alias("n"))
    sizes = materialize(sizes, "exact-sizes")
    mapping = mapping.join(
        maybe_broadcast(sizes, sizes.count(), 32), (F.col("k") == F.col("sk")) & F.col("head_id").eqNullSafe(F.col("sh"))
    ).select("d", "k", "head_id", "n", "chained")
    rows = keys.join(mapping, same, "left")
    keep = F.when(F.col("chained"), F.col("head_id")).otherwise(F.col("doc_id"))
    once = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("key")) == 1
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & once).alias("kept"),
        "text_sha256",
    )
