"""Readers of device exports.

Device exports as text are read by the data source of ``device.py``, other text by Spark's readers, as strings that
expressions cast; binary ones are decoded by numpy within tasks from ``binaryFile`` rows, a file per row.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C
from pulsegrid.sources import archives
from pulsegrid.sources.device import DELIMITERS, RANGE_BYTES, device_csv, headings

def sniff_delimiter(header: str, default: str = ",") -> str:
    counts = {d: header.count(d) for d in DELIMITERS}
    best = max(counts, key=counts.get)
    return best if counts[best] else default


def _name(path: Column) -> Column:
    return F.regexp_replace(C.file_name(path), r"\.[^.]*$", "")


def monitor_csv(spark: SparkSession, path: str, time_heading: str, aliases: dict[str, str], codes: list[float], zone: str = "UTC", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Monitor exports, about one row a second: recording_id, ts, variable, value; each file by its own heading.

    Times are yyyyMMddHHmmss of the zone, fractions dropped; rows without a time go; of repeated times the first row
    stays; missing codes and rows without any value go. Files without the time column give nothing; see ``unread``.
    """
    df = device_csv(spark, path, time_heading=time_heading, aliases=aliases, range_bytes=range_bytes).where("error is null")
    local = F.try_to_timestamp(F.left(F.regexp_replace("time", "[\"']", ""), F.lit(14)), F.lit("yyyyMMddHHmmss"))
    rows = df.select(_name(F.col("path")).alias("recording_id"), C.local_to_utc(local, zone).alias("ts"), "offset", "cells").where("ts is not null")
    rows = rows.withColumn("__k", F.row_number().over(Window.partitionBy("recording_id", "ts").orderBy("offset"))).where("__k = 1")
    long = rows.select("recording_id", "ts", F.explode("cells").alias("x")).select("recording_id", "ts", "x.variable", C.numeric(F.col("x.value")).alias("value"))
    return long.where(F.col("value").isNotNull() & ~F.col("value").isin(codes))


def export_metadata(long: DataFrame, recognised: list[str]) -> DataFrame:
    """What monitor rows show of each recording: rows, start and end, columns known and unknown, median, least and greatest
    interval in seconds with the rate they make, and whether it is physiological at all."""
    times = long.groupBy("recording_id", "ts").agg(F.count("*").alias("n"))
    before = F.lag("ts").over(Window.partitionBy("recording_id").orderBy("ts"))
    step = (F.unix_micros("ts") - F.unix_micros(before)) / 1e6
    rates = times.withColumn("step", step).groupBy("recording_id").agg(
        F.count("*").alias("n_rows"),
        F.min("ts").alias("starts"),
        F.max("ts").alias("ends"),
        F.percentile("step", F.lit(0.5)).alias("median_interval_s"),
        F.min("step").alias("min_interval_s"),
        F.max("step").alias("max_interval_s"),
    )
    known = F.col("variable").isin(recognised)
    columns = long.groupBy("recording_id").agg(F.countDistinct(F.when(known, F.col("variable"))).alias("n_recognised"), F.countDistinct(F.when(~known, F.col("variable"))).alias("n_unknown"))
    out = rates.join(columns, "recording_id").withColumn("estimated_hz", F.round(1 / F.nullif("median_interval_s", F.lit(0.0)), 6))
    return out.withColumn("export_type", F.when(F.col("n_recognised") > 0, "physiological").otherwise("non_physiological_or_unrecognised"))


def unread(spark: SparkSession, path: str, **options) -> DataFrame:
    """Files that ``device_csv`` can't read by these options, and why: path, error."""
    return device_csv(spark, path, **options).where("error is not null").select("path", "error")


def waveform_slices(spark: SparkSession, path: str, time_heading: str = "Time (msecs)", zone: str = "UTC", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Waveform exports in slices name-1.csv, name-2.csv, ... of one recording: recording_id, slice, ts, variable, value;
    each slice by its own heading.

    Decimal commas; times are elapsed milliseconds after the start in the file name; of repeated times the first stays.
    """
    df = device_csv(spark, path, time_heading=time_heading, range_bytes=range_bytes).where("error is null")
    name = C.file_name(F.col("path"))
    rows = df.select(
        F.regexp_replace(name, r"(-\d+)?\.csv$", "").alias("recording_id"),
        F.coalesce(C.slice_number(name), F.lit(1)).alias("slice"),
        C.decimal_comma(F.col("time")).alias("elapsed_ms"),
        C.start_clock(name, zone).alias("start"),
        "offset",
        "cells",
    ).where("elapsed_ms is not null")
    first = F.row_number().over(Window.partitionBy("recording_id", "elapsed_ms").orderBy("slice", "offset"))
    rows = rows.withColumn("__k", first).where("__k = 1")
    ts = F.timestamp_micros(F.unix_micros("start") + (F.col("elapsed_ms") * 1000).cast("long"))
    rows = rows.select("recording_id", "slice", "elapsed_ms", ts.alias("ts"), F.explode("cells").alias("x"))
    return rows.select("recording_id", "slice", "elapsed_ms", "ts", "x.variable", C.decimal_comma(F.col("x.value")).alias("value"))


def slice_order(samples: DataFrame) -> DataFrame:
    """Slices of each recording with their reach, and whether one is missing before them or starts before the last ended."""
    out = samples.groupBy("recording_id", "slice").agg(F.min("elapsed_ms").alias("starts_ms"), F.max("elapsed_ms").alias("ends_ms"), F.countDistinct("elapsed_ms").alias("n_rows"))
    before = Window.partitionBy("recording_id").orderBy("slice")
    gap = F.col("slice") - F.coalesce(F.lag("slice").over(before), F.lit(0)) - 1
    overlap = F.coalesce(F.col("starts_ms") <= F.max("ends_ms").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    return out.select("*", gap.alias("missing_before"), overlap.alias("overlaps"))


def nol_export(spark: SparkSession, path: str, zone: str = "UTC") -> dict[str, DataFrame]:
    """Export with two stacked headers: demographics (two lines), then the series, whose rows begin with a date.

    Returns demographics (path, field, value), series (path, ts, relative_s, nol, hr), events (path, ts, text).
    """
    # wholetext keeps line numbers right; such a file is small.
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    files = files.withColumn("line", F.trim(F.regexp_replace("line", "^﻿", "")))
    stamp = r"^\"?\d{1,2}-[A-Za-z]{3}-\d{4} \d{2}:\d{2}:\d{2}"
    header = files.where((F.col("n") < 20) & F.col("line").contains("Abs Time Vector")).groupBy("path").agg(F.min("n").alias("header"))
    rows = files.join(header, "path")
    own = rows.where((F.col("n") < F.col("header")) & (F.col("line") != "")).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("l"))
    pair = F.arrays_zip(F.split(F.get("l", F.lit(0))["line"], ",").alias("field"), F.split(F.get("l", F.lit(1))["line"], ",").alias("value"))
    demographics = own.where(F.size("l") >= 2).select("path", F.explode(pair).alias("x")).select("path", F.trim("x.field").alias("field"), F.trim("x.value").alias("value")).where("field <> ''")
    data = rows.where((F.col("n") > F.col("header")) & F.col("line").rlike(stamp))
    parts = F.from_csv("line", F.lit("t string, rel string, nol string, hr string, events string"))
    data = data.select("path", parts.alias("x")).select("path", "x.*")
    data = data.withColumn("ts", C.local_to_utc(F.try_to_timestamp("t", F.lit("dd-MMM-yyyy HH:mm:ss")), zone))
    number = lambda c: C.no_nan(F.trim(c).try_cast("double"))
    series = data.select("path", "ts", number("rel").alias("relative_s"), number("nol").alias("nol"), number("hr").alias("hr"))
    events = data.where(F.length(F.trim("events")) > 0).select("path", "ts", F.trim("events").alias("text"))
    return {"demographics": demographics, "series": series, "events": events}


#: Microvolts per count of the raw EEG.
EEG_SCALE = 1675.42688 / 32767


def decode_eeg(raw: bytes, channels: int = 2) -> np.ndarray:
    """Interleaved little-endian 16-bit samples as microvolts, a row per channel.

    Odd sizes, sizes that don't divide by the channels, and steps too large for the byte order are refused.
    """
    if len(raw) % 2:
        raise ValueError("odd number of bytes")
    x = np.frombuffer(raw, "<i2")
    if len(x) % channels:
        raise ValueError("samples don't divide by channels")
    if len(x) > channels and np.median(np.abs(np.diff(x.reshape(-1, channels).astype(int), axis=0))) > 5000:
        raise ValueError("implausible steps: another byte order?")
    return x.reshape(-1, channels).T * EEG_SCALE


def eeg_raw(spark: SparkSession, path: str, fs: float = 128.0, channels: int = 2) -> DataFrame:
    """recording_id, channel, i, t_s, value, error of raw EEG files; a refused file is one row with its error."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                name = re.sub(r"\.[^.]*$", "", p.rsplit("/", 1)[-1])
                try:
                    x = decode_eeg(bytes(content), channels)
                except ValueError as e:
                    yield pd.DataFrame([{"recording_id": name, "channel": None, "i": None, "t_s": None, "value": None, "error": str(e)}])
                    continue
                for c in range(channels):
                    i = np.arange(x.shape[1])
                    yield pd.DataFrame({"recording_id": name, "channel": c, "i": i, "t_s": i / fs, "value": x[c], "error": None})

    return files.mapInPandas(run, "recording_id string, channel int, i long, t_s double, value double, error string")


def eeg_trends(spark: SparkSession, path: str, hints: dict[str, str], fallback: dict[str, int]) -> DataFrame:
    """Pipe-separated trends, header on the second line: recording_id, ts, variable, value; negative values are missing.

    Columns are found by a part of their name, else by a fixed place.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    header = lines.where("n = 1").select("path", F.transform(F.split("line", r"\|"), lambda h: F.lower(F.trim(h))).alias("h"))
    rows = lines.where((F.col("n") > 1) & (F.trim("line") != "")).join(header, "path")
    rows = rows.withColumn("p", F.split("line", r"\|"))
    place = lambda hint: F.array_position(F.transform("h", lambda h: h.contains(hint)), True).cast("int")
    text = {v: F.get("p", F.when(place(h) > 0, place(h) - 1).otherwise(F.lit(fallback.get(v, -1)))) for v, h in hints.items()}
    stamp = F.trim(text.pop("time"))
    ts = F.coalesce(F.try_to_timestamp(stamp), F.timestamp_seconds(stamp.try_cast("double")))
    name = F.regexp_replace(C.file_name(F.col("path")), r"\.[^.]*$", "")
    rows = rows.select(name.alias("recording_id"), ts.alias("ts"), *[F.trim(t).try_cast("double").alias(v) for v, t in text.items()])
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.when(F.col(v) >= 0, F.col(v)).alias("value")) for v in text])
    return rows.select("recording_id", "ts", F.explode(pairs).alias("x")).select("recording_id", "ts", "x.variable", "x.value")


def eeg_pairs(raw: DataFrame, trends: DataFrame, most_difference_s: float = 5.0) -> DataFrame:
    """Raw EEG and trends of a recording side by side: durations, mismatch, flat channel, start from the trends."""
    r = raw.where("error is null").groupBy("recording_id", "channel").agg(F.max("t_s").alias("d"), F.stddev_pop("value").alias("sd"), F.count("*").alias("n"))
    r = r.groupBy("recording_id").agg(F.max("d").alias("raw_s"), F.max((F.col("sd") == 0) & (F.col("n") > 128)).alias("flat_channel"))
    t = trends.groupBy("recording_id").agg(F.min("ts").alias("t_start"), (F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))).cast("double").alias("trend_s"))
    out = r.join(t, "recording_id", "full")
    return out.withColumn("duration_mismatch", F.coalesce(F.abs(F.col("raw_s") - F.col("trend_s")) > most_difference_s, F.lit(False)))


def pump_events(spark: SparkSession, path: str, zone: str = "UTC", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pump event logs: recording_id, ts and the other columns as strings; day first; date and time may be two columns.

    Files may have different columns: the result has all of them, null where a file lacks one.
    """
    read = lambda **only: device_csv(spark, path, time_pattern="time|date|heure", range_bytes=range_bytes, **only).where("error is null")
    df = read()
    stamp = F.trim("time")
    patterns = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss")
    ts = F.coalesce(*[F.try_to_timestamp(stamp, F.lit(p)) for p in patterns])
    tidy = lambda h: F.trim(F.regexp_replace(F.lower(h), r"\W+", "_"), F.lit("_"))
    cells = F.transform("cells", lambda x: F.struct(tidy(x["heading"]).alias("key"), F.trim(x["value"]).alias("value")))
    rows = df.select(_name(F.col("path")).alias("recording_id"), C.local_to_utc(ts, zone).alias("ts"), cells.alias("cells"))
    # Headings are few, whatever the number of rows: those of a device's exports. A file's first row has all of its own.
    headings_of = read(first_rows=True).select(F.explode("cells.heading").alias("h")).distinct()
    names = sorted(r[0] for r in headings_of.select(tidy(F.col("h")).alias("k")).distinct().collect())
    value = lambda n: F.get(F.filter("cells", lambda x: x["key"] == n), F.lit(0))["value"].alias(n)
    return rows.select("recording_id", "ts", *[value(n) for n in names])


def exam_zip(spark: SparkSession, path: str, sentinel: float = -32768.0, sentinel_sensor: str = "draeger") -> DataFrame:
    """Samples of zipped exams of Parquet parts under sensor=/signal= folders, read member by member.

    A part whose checksum fails is one row with crc_ok false. The sentinel is null for its sensor only. Missing columns
    are null; columns outside the schema are left out. ``archives.exams`` tells which exams to keep out, and why.
    """
    out = archives.samples(archives.members(spark, path))
    gone = (F.col("sensor") == sentinel_sensor) & (F.col("value") == sentinel)
    out = out.withColumn("value", F.when(~F.coalesce(gone, F.lit(False)), C.no_nan(F.col("value"))))
    exam = F.regexp_replace(C.file_name(F.col("path")), r"\.[^.]*$", "")
    ts = F.timestamp_micros((F.col("local_time") * 1_000_000).cast("long"))
    return out.select(exam.alias("exam"), "sensor", "signal", "dimension", "local_time", "remote_time", "received_time", "value", "crc_ok", ts.alias("ts"))


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path and length of files; their contents aren't read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def opened(path: str):
    """A file opened for reading parts of it, on any store that Arrow knows; inside tasks."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else "file://" + path)
    return store.open_input_file(at)


def footer_census(spark: SparkSession, path: str) -> DataFrame:
    """Per Parquet file and column whether it has any value, from footers alone: true, false or null (no statistics)."""

    def run(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            for p in batch["path"]:
                with opened(p) as f:
                    meta = pq.ParquetFile(f).metadata
                rows = []
                for c in range(meta.num_columns):
                    known, valid = True, False
                    for g in range(meta.num_row_groups):
                        stats = meta.row_group(g).column(c).statistics
                        if stats is None or stats.null_count is None:
                            known = False
                        else:
                            valid = valid or meta.row_group(g).num_rows > stats.null_count
                    rows.append({"path": p, "column": meta.schema.column(c).path, "n_rows": meta.num_rows, "has_values": True if valid else (False if known else None)})
                yield pd.DataFrame(rows, columns=["path", "column", "n_rows", "has_values"])

    return listed(spark, path).mapInPandas(run, "path string, column string, n_rows long, has_values boolean")


def footer_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The key and value pairs of Parquet footers: path, key, value."""

    def run(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            for p in batch["path"]:
                with opened(p) as f:
                    pairs = pq.ParquetFile(f).metadata.metadata or {}
                yield pd.DataFrame([(p, k.decode(), v.decode("utf-8", "replace")) for k, v in pairs.items()], columns=["path", "key", "value"])

    return listed(spark, path).mapInPandas(run, "path string, key string, value string")


def located(df: DataFrame, path: str, places: list[tuple[str, str]]) -> DataFrame:
    """Column ``location``: the first place (pattern over the lower-cased file name, label) that a file's name tells."""
    name = F.lower(C.file_name(F.col(path)))
    out = F.lit(None).cast("string")
    for pattern, label in reversed(places):
        out = F.when(name.rlike(pattern), label).otherwise(out)
    return df.withColumn("location", out)


def json_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogues, a JSON text a file: an object, or an array of which each element is a row; UTF-8, or UTF-16 with or without
    a byte order mark.

    Files are rows of texts that are parsed: Spark's reader of JSON over many lines hands the list of all files to each task.
    """
    raw = F.col("content")
    mark, zero = F.hex(F.substring(raw, 1, 2)), F.lit("00")
    text = (
        F.when(mark.isin("FEFF", "FFFE"), F.decode(raw, "UTF-16"))
        .when(F.substring(mark, 3, 2) == zero, F.decode(raw, "UTF-16LE"))
        .when(F.substring(mark, 1, 2) == zero, F.decode(raw, "UTF-16BE"))
        .otherwise(F.regexp_replace(raw.cast("string"), "^\ufeff", ""))
    )
    texts = spark.read.format("binaryFile").load(path).select(text.alias("value"))
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark._jsparkSession.read().json(strings), spark)


def label_csv(spark: SparkSession, path: str) -> DataFrame:
    """Label segments: project, patient, signal, start_s, end_s, label."""
    return spark.read.csv(path, header=True, schema="project string, patient string, signal string, start_s double, end_s double, label int")


def pruned(spark: SparkSession, path: str, columns: list[str], rows: int | None = None) -> DataFrame:
    """Some columns of Parquet files; with ``rows`` the first so many of each file."""
    df = spark.read.parquet(path)
    return (df.where(F.col("_metadata.row_index") < rows) if rows else df).select(*columns)


def head_census(spark: SparkSession, path: str, head: int = 256 << 10) -> DataFrame:
    """What unknown text files look like from their heads: encoding, delimiter, header line, columns, numeric share, hash."""

    def run(batches):
        for batch in batches:
            rows = []
            for p, n in zip(batch["path"], batch["length"], strict=True):
                with opened(p) as f:
                    part = f.read(8 << 20)
                raw, sha = part[:head], hashlib.sha256(part).hexdigest()
                encoding = next((e for e in ("utf-8-sig", "cp1252", "latin-1") if _decodes(raw, e)), "latin-1")
                lines = [x for x in raw.decode(encoding, "replace").splitlines() if x.strip()]
                sep = sniff_delimiter(max(lines[:20], key=lambda x: max(x.count(d) for d in DELIMITERS), default=""))
                # The header is the first line with most fields that are hardly numbers.
                at = next((i for i, x in enumerate(lines[:20]) if x.count(sep) >= 1 and _numeric_share(x, sep) <= 0.34), None)
                names = headings(lines[at].split(sep)) if at is not None else []
                body = lines[at + 1 : at + 200] if at is not None else []
                share = float(np.mean([_numeric_share(x, sep) for x in body])) if body else 0.0
                rows.append({"path": p, "length": n, "encoding": encoding, "delimiter": sep, "header_line": at, "columns": names, "numeric_share": share, "partial_sha256": sha})
            yield pd.DataFrame(rows)

    return listed(spark, path).mapInPandas(run, "path string, length long, encoding string, delimiter string, header_line int, columns array<string>, numeric_share double, partial_sha256 string")


def _decodes(raw: bytes, encoding: str) -> bool:
    try:
        raw.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _numeric_share(line: str, sep: str) -> float:
    fields = line.split(sep)
    return sum(bool(re.fullmatch(r"\s*-?\d+([.,]\d+)?\s*", f)) for f in fields) / len(fields)


#: First bytes of kinds of files.
MAGIC = ((b"PAR1", "parquet"), (b"PK\x03\x04", "zip"), (b"\x1f\x8b", "gzip"), (b"gAAAA", "token"), (b"\xd0\xcf\x11\xe0", "ole"), (b"%PDF", "pdf"), (b"\x89PNG", "png"), (b"\xff\xd8\xff", "jpeg"))


def fingerprint(raw: bytes) -> tuple[str, str, str, float, float, str]:
    """kind, first bytes, byte order mark, entropy in bits a byte, share of zero bytes and class of a file's head."""
    kind = "empty" if not raw else next((k for m, k in MAGIC if raw.startswith(m)), "unknown")
    mark = next((n for m, n in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")) if raw.startswith(m)), "")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = counts[counts > 0] / max(1, len(raw))
    entropy, zeros = float(-(p * np.log2(p)).sum()) if len(p) else 0.0, float(counts[0] / max(1, len(raw)))
    printable = counts[32:127].sum() + counts[[9, 10, 13]].sum() + counts[128:].sum()
    if kind != "unknown" or not raw:
        label = kind
    elif zeros > 0.95:
        label = "zeros"
    elif mark or printable > 0.95 * len(raw):
        label = "text"
    else:
        label = "compressed_or_encrypted" if entropy > 7.5 else "binary"
    return kind, raw[:8].hex().upper(), mark, entropy, zeros, label


def fingerprints(spark: SparkSession, path: str, head: int = 64 << 10) -> DataFrame:
    """Kind of files by their first bytes, with byte order mark, entropy, share of zeros and class of the head."""

    def run(batches):
        for batch in batches:
            rows = []
            for p, n in zip(batch["path"], batch["length"], strict=True):
                with opened(p) as f:
                    rows.append((p, n, *fingerprint(f.read(head))))
            yield pd.DataFrame(rows, columns=["path", "length", "kind", "first_bytes", "bom", "entropy", "zeros", "class"])

    return listed(spark, path).mapInPandas(run, "path string, length long, kind string, first_bytes string, bom string, entropy double, zeros double, class string")


READERS = {
    "monitor_csv": monitor_csv,
    "waveform_slices": waveform_slices,
    "nol_export": nol_export,
    "eeg_raw": eeg_raw,
    "eeg_trends": eeg_trends,
    "pump_events": pump_events,
    "exam_zip": exam_zip,
    "json_catalog": json_catalog,
    "label_csv": label_csv,
    "head_census": head_census,
    "footer_census": footer_census,
}


def reader(name: str):
    """The reader of a name; an unknown one is an error that lists those there are."""
    if name not in READERS:
        raise KeyError(f"{name}: one of {', '.join(sorted(READERS))}")
    return READERS[name]
