"""Zipped exams by member: the central directory is read from the end of each file, and every member is a row of its own,
decoded by whichever task it is dealt to. No task holds a whole archive."""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C

#: The delivery's file name, and the columns of its samples.
EXAM_NAME = r"^(.+)_(\d{4}-\d{2}-\d{2})_(\d{2}-\d{2}-\d{2})_([0-9a-fA-F]{8})_([0-9a-fA-F]{8})\.parquet\.zip$"
SAMPLE_COLUMNS = ("local_time", "remote_time", "received_time", "value", "dimension", "annotation", "form")
_NUMBERS = SAMPLE_COLUMNS[:4]

_MEMBERS = "path string, member string, at long, packed long, size long, crc long, method int, error string"


def _opened(path: str):
    from pulsegrid.sources.readers import opened

    return opened(path)


def members(spark: SparkSession, path: str) -> DataFrame:
    """path, member, at, packed, size, crc, method of the files in each archive; one that can't be read, or has none, is a row
    with its error. Only the directories at the archives' ends are read."""

    def run(batches):
        for batch in batches:
            rows = []
            for p in batch.column(0).to_pylist():
                try:
                    with _opened(p) as f, zipfile.ZipFile(f) as z:
                        found = [i for i in z.infolist() if i.filename.endswith(".parquet")]
                    rows += [(p, i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type, None) for i in found]
                    if not found:
                        rows.append((p, *[None] * 6, "empty_zip"))
                except (zipfile.BadZipFile, ValueError):
                    rows.append((p, *[None] * 6, "unreadable_zip"))
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.string()]
            columns = list(zip(*rows)) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _MEMBERS.split(", ")])

    from pulsegrid.sources.readers import listed

    return listed(spark, path).select("path").mapInArrow(run, _MEMBERS)


def unpacked(path: str, at: int, packed: int, crc: int, method: int) -> bytes:
    """One member's bytes, read by its place; raises ValueError if they are damaged."""
    with _opened(path) as f:
        f.seek(at)
        head = f.read(30)
        if head[:4] != b"PK\x03\x04" or method not in (0, 8):
            raise ValueError("header")
        name, extra = struct.unpack("<HH", head[26:30])
        f.seek(at + 30 + name + extra)
        raw = f.read(packed)
    try:
        raw = raw if method == 0 else zlib.decompressobj(-15).decompress(raw)
    except zlib.error as e:
        raise ValueError("packed data") from e
    if zlib.crc32(raw) != crc:
        raise ValueError("checksum")
    return raw


#: Unpacked bytes of the members that one task is dealt.
TASK_BYTES = 256 << 20


def _dealt(found: DataFrame) -> DataFrame:
    """Members among tasks by their sizes, whatever archive they are of: a count that isn't coalesced, as rows are small but
    what they stand for is not."""
    total = found.agg(F.sum("size")).first()[0] or 0
    n = max(found.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return found.where("error is null").repartition(n, "path", "member").select("path", "member", "at", "packed", "crc", "method")


def _each(batches) -> Iterator[tuple[str, str, pq.ParquetFile | None]]:
    for batch in batches:
        for p, member, at, packed, crc, method in zip(*(c.to_pylist() for c in batch.columns)):
            try:
                yield p, member, pq.ParquetFile(pa.BufferReader(unpacked(p, at, packed, crc, method)))
            except (ValueError, pa.ArrowInvalid):
                yield p, member, None


def _folder(member: Column, key: str) -> Column:
    return F.nullif(F.regexp_extract(member, rf"(?:^|/){key}=([^/]*)/", 1), F.lit(""))


def samples(found: DataFrame) -> DataFrame:
    """Rows of the members' tables: path, member, time_bin, sensor, signal, the sample columns (null where a member lacks
    them), crc_ok. A damaged member is one row with crc_ok false."""
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), *[(c, pa.float64() if c in _NUMBERS else pa.string()) for c in SAMPLE_COLUMNS], ("crc_ok", pa.bool_())])

    def run(batches):
        for p, member, table in _each(batches):
            if table is None:
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((p, member, *[None] * 7, False), schema.types)], schema=schema)
                continue
            for part in table.iter_batches(32_768, columns=[c for c in SAMPLE_COLUMNS if c in table.schema_arrow.names]):
                n = part.num_rows
                values = [part.column(c).cast(schema.field(c).type, safe=False) if c in part.schema.names else pa.nulls(n, schema.field(c).type) for c in SAMPLE_COLUMNS]
                yield pa.RecordBatch.from_arrays([pa.array([p] * n), pa.array([member] * n), *values, pa.array([True] * n)], schema=schema)

    numbers = ", ".join(f"{c} {'double' if c in _NUMBERS else 'string'}" for c in SAMPLE_COLUMNS)
    rows = _dealt(found).mapInArrow(run, f"path string, member string, {numbers}, crc_ok boolean")
    return rows.select("path", "member", *[_folder(F.col("member"), k).alias(k) for k in ("time_bin", "sensor", "signal")], *SAMPLE_COLUMNS, "crc_ok")


def footers(found: DataFrame) -> DataFrame:
    """path, member, pairs (the footer's keys and values), names (columns); both null for a damaged member."""
    kinds = [pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string())]

    def run(batches):
        for p, member, table in _each(batches):
            pairs = None if table is None else [(k.decode("utf-8", "replace"), v.decode("utf-8", "replace")) for k, v in (table.metadata.metadata or {}).items()]
            row = (p, member, pairs, None if table is None else table.schema_arrow.names)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["path", "member", "pairs", "names"])

    return _dealt(found).mapInArrow(run, "path string, member string, pairs map<string,string>, names array<string>")


def kv_list(text: Column) -> Column:
    """The map of a list like ['a=1', 'b=2']; items without = go."""
    items = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s*\[|\]\s*$", ""), ",")
    items = F.filter(F.transform(items, lambda x: F.regexp_replace(x, r"^[\s'\"]+|[\s'\"]+$", "")), lambda x: x.contains("="))
    pair = lambda x: F.struct(F.trim(F.regexp_extract(x, r"^([^=]*)=", 1)), F.trim(F.regexp_extract(x, r"^[^=]*=(.*)$", 1)))
    return F.map_from_entries(F.array_distinct(F.transform(items, pair)))


def exams(found: DataFrame) -> DataFrame:
    """One row an archive: what its name and its first member's footer say, columns beyond and short of the expected ones,
    and the reason to keep it out, the first of: unreadable_zip, empty_zip, crc32_failure, bad_filename, guid_mismatch."""
    whole = footers(found)
    order = F.struct("member")
    first = whole.groupBy("path").agg(
        F.min_by("pairs", order).alias("pairs"),
        F.count_if(F.col("pairs").isNull()).alias("n_damaged"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("names", F.array().cast("array<string>")))))).alias("names"),
    )
    out = found.groupBy("path").agg(F.min("error").alias("error"), F.count("member").alias("n_members")).join(first, "path", "left")
    name = C.file_name(F.col("path"))
    part = lambda i: F.nullif(F.regexp_extract(name, EXAM_NAME, i), F.lit(""))
    clash = F.lit(False)
    for key, i in (("session_guid", 4), ("exam_guid", 5)):
        said = F.nullif(F.lower(F.trim(F.col("pairs").getItem(key))), F.lit(""))
        clash = clash | F.coalesce(said != F.lower(part(i)), F.lit(False))
    reason = F.coalesce(
        "error",
        F.when(F.coalesce("n_damaged", F.lit(0)) > 0, "crc32_failure"),
        F.when(part(1).isNull(), "bad_filename"),
        F.when(clash, "guid_mismatch"),
    )
    expected = F.array(*[F.lit(c) for c in SAMPLE_COLUMNS])
    return out.select(
        "path",
        "n_members",
        part(1).alias("patient"),
        F.coalesce(F.col("pairs").getItem("session_guid"), part(4)).alias("session_guid"),
        F.coalesce(F.col("pairs").getItem("exam_guid"), part(5)).alias("exam_guid"),
        kv_list(F.col("pairs").getItem("sampling_frequency")).alias("sampling_frequency"),
        F.array_except("names", F.array_append(expected, F.lit("__index_level_0__"))).alias("unexpected"),
        F.array_except(expected, "names").alias("missing"),
        reason.alias("reason"),
    )
