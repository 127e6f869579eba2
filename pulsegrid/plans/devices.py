"""Queries on files of devices: the samples are written as exports of several kinds, and read back by their readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.plans.files import scratch
from pulsegrid.plans.registry import query
from pulsegrid.plans.signals import samples
from pulsegrid.sources import archives, readers, sinks

c = F.col


def _files(rows: DataFrame, name: Column, head: Column, line: Column, newline: str = "\n", encoding: str = "UTF-8") -> DataFrame:
    """name, content: a file for each name, of its heading and its lines in the order of their events."""
    lines = F.array_sort(F.collect_list(F.struct("event_id", line.alias("line"))))
    out = rows.groupBy(name.alias("name"), head.alias("head")).agg(lines.alias("lines"))
    text = F.array_join(F.concat(F.array("head"), F.transform("lines", lambda x: x["line"])), newline)
    return out.select("name", F.encode(text, encoding).alias("content"))


@query("""
SELECT user_id::VARCHAR AS user_id, strftime(TIMESTAMP '2026-01-01' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S') AS t,
       CASE event_type WHEN 'view' THEN 'durée vue' ELSE event_type END AS variable, value
FROM events WHERE value <> 77 AND event_type IN ('click', 'view', 'purchase')""")
def read_mixed_monitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monitor export for each user: three headings in other orders, with other delimiters and encodings, one below a
    line of the maker's. Variables without a name of their own keep their heading; the missing code goes."""
    path = scratch(spark, "mixed")
    df = samples(spark, sf_dir).withColumn("value", F.when(c("value") != 77, c("value")).otherwise(-1401.0))
    at = F.concat(F.date_format(F.timestamp_seconds(F.lit(1_767_225_600) + c("event_id")), "yyyyMMddHHmmss"), F.lit(".25"))
    cell = lambda t: F.coalesce(F.when(c("event_type") == t, c("value").cast("string")), F.lit(""))
    time = "OBSERVATION_DATETIME"
    layouts = (
        (";", "UTF-8", [f'"{time}"', "Click (n)", "durée vue", "buy"], [at, cell("click"), cell("view"), cell("purchase")]),
        (",", "ISO-8859-1", ["buy", time, "durée vue", "CLICK"], [cell("purchase"), at, cell("view"), cell("click")]),
        ("\t", "UTF-16", ["durée vue", "click", "buy", time.lower()], [cell("view"), cell("click"), cell("purchase"), at]),
    )
    for i, (sep, encoding, names, cells) in enumerate(layouts):
        head = sep.join(names) if i else "exported by a monitor\n" + sep.join(names)
        mine = df.where(c("user_id") % 3 == i)
        sinks.raw_files(_files(mine, F.concat(c("user_id").cast("string"), F.lit(".csv")), F.lit(head), F.concat_ws(sep, *cells), encoding=encoding), path)
    got = readers.monitor_csv(spark, path, time, {"click": "click", "BUY": "purchase"}, [-1401.0], range_bytes=16384)
    return got.select(c("recording_id").alias("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "variable", "value")


@query("""
WITH t AS (SELECT DISTINCT user_id, event_id AS s FROM events),
d AS (SELECT user_id, s, s - lag(s) OVER (PARTITION BY user_id ORDER BY s) AS step FROM t),
r AS (SELECT user_id, count(*) AS n_rows, min(s) AS starts, max(s) AS ends, quantile_cont(step, 0.5) AS m, min(step)::DOUBLE AS min_interval_s, max(step)::DOUBLE AS max_interval_s FROM d GROUP BY user_id),
k AS (SELECT user_id, count(DISTINCT event_type) FILTER (event_type IN ('click', 'view')) AS n_recognised, count(DISTINCT event_type) FILTER (event_type NOT IN ('click', 'view')) AS n_unknown FROM events GROUP BY user_id)
SELECT user_id::VARCHAR AS recording_id, n_rows, starts, ends, m AS median_interval_s, min_interval_s, max_interval_s, n_recognised, n_unknown,
       round(1 / m, 6) AS estimated_hz, CASE WHEN n_recognised > 0 THEN 'physiological' ELSE 'non_physiological_or_unrecognised' END AS export_type
FROM r JOIN k USING (user_id)""")
def monitor_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = samples(spark, sf_dir).select(c("user_id").cast("string").alias("recording_id"), F.timestamp_seconds("event_id").alias("ts"), c("event_type").alias("variable"), "value")
    out = readers.export_metadata(long, ["click", "view"])
    return out.withColumn("starts", F.unix_seconds("starts")).withColumn("ends", F.unix_seconds("ends"))


_SLICE = "user_id || '.126010512000025' || user_id % 10"


def _slices(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Waveform exports of each user in four slices, with other delimiters, encodings and orders of columns."""
    path = scratch(spark, label)
    df = samples(spark, sf_dir)
    last = df.agg(F.max("event_id")).first()[0] or 0
    df = df.withColumn("slice", (c("event_id") * 4 / (last + 1)).cast("int"))
    comma = lambda x: F.replace(x.cast("string"), F.lit("."), F.lit(","))
    cell = lambda t: F.coalesce(F.when(c("event_type") == t, comma(c("value"))), F.lit(""))
    # Zero-padded to sixteen digits and a leading 1, the start's wall clock.
    name = F.concat(c("user_id").cast("string"), F.lit(".126010512000025"), (c("user_id") % 10).cast("string"), F.lit("-"), (c("slice") + 1).cast("string"), F.lit(".csv"))
    types = ("click", "view", "purchase", "error", "signup")
    for i, (sep, encoding) in enumerate(((";", "UTF-8"), ("\t", "ISO-8859-1"), ("|", "UTF-8"), (";", "UTF-16"))):
        order = types[i:] + types[:i]
        heading = sep.join(["Time (msecs)", *order, "µV"])
        line = F.concat_ws(sep, comma(c("event_id") + 0.5), *[cell(t) for t in order], F.lit("x"))
        sinks.raw_files(_files(df.where(c("slice") == i), name, F.lit(heading), line, "\r\n", encoding), path)
    return readers.waveform_slices(spark, path, range_bytes=16384)


@query(f"""
SELECT {_SLICE} AS recording_id, (event_id * 4 // ((SELECT max(event_id) FROM events) + 1))::INTEGER + 1 AS slice, event_id + 0.5::DOUBLE AS elapsed_ms,
       epoch_us(TIMESTAMP '2026-01-05 12:00:00') + (250 + user_id % 10) * 1000 + event_id * 1000 + 500 AS us, event_type AS variable, value FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'error', 'signup')""")
def read_mixed_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _slices(spark, sf_dir, "slices").where("value is not null")
    return got.select("recording_id", "slice", "elapsed_ms", F.unix_micros("ts").alias("us"), "variable", "value")


@query(f"""
WITH s AS (SELECT {_SLICE} AS recording_id, (event_id * 4 // ((SELECT max(event_id) FROM events) + 1))::INTEGER + 1 AS slice, event_id + 0.5::DOUBLE AS t FROM events),
g AS (SELECT recording_id, slice, min(t) AS starts_ms, max(t) AS ends_ms, count(*) AS n_rows FROM s GROUP BY ALL)
SELECT *, slice - coalesce(lag(slice) OVER (PARTITION BY recording_id ORDER BY slice), 0) - 1 AS missing_before, false AS overlaps FROM g""")
def order_of_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.slice_order(_slices(spark, sf_dir, "slice-order"))


@query("""
SELECT user_id::VARCHAR AS recording_id, strftime(TIMESTAMP '2026-01-05' + to_minutes(event_id), '%Y-%m-%d %H:%M') AS t, event_type AS drug_name,
       CASE WHEN user_id % 2 = 0 THEN value::VARCHAR END AS rate_ml_h, CASE WHEN user_id % 2 = 1 THEN value::VARCHAR END AS dose FROM events""")
def read_mixed_pumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pump logs of two layouts: date and hour in two columns and a rate, or one stamp and a dose."""
    path = scratch(spark, "pumps")
    df = samples(spark, sf_dir).withColumn("at", F.timestamp_seconds(F.lit(1_767_571_200) + c("event_id") * 60))
    name, value = F.concat(c("user_id").cast("string"), F.lit(".csv")), c("value").cast("string")
    two = F.concat_ws(";", F.date_format("at", "dd/MM/yyyy"), F.date_format("at", "HH:mm"), "event_type", value)
    one = F.concat_ws(",", value, F.concat(F.lit('"'), c("event_type"), F.lit('"')), F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
    sinks.raw_files(_files(df.where("user_id % 2 = 0"), name, F.lit("Date;Heure;Drug name;Rate (mL/h)"), two), path)
    sinks.raw_files(_files(df.where("user_id % 2 = 1"), name, F.lit("Dose,DRUG NAME,Timestamp"), one, encoding="ISO-8859-1"), path)
    got = readers.pump_events(spark, path, range_bytes=16384)
    return got.select("recording_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("t"), "drug_name", "rate_ml_h", "dose")


@query("""
SELECT user_id::VARCHAR AS recording_id, strftime(TIMESTAMP '2026-08-12 14:00:00' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S') AS t, event_id::DOUBLE AS relative_s,
       CASE WHEN event_type <> 'error' THEN value END AS nol, CASE WHEN event_type = 'error' THEN value END AS hr,
       CASE WHEN event_type = 'signup' THEN 'Intubation' END AS event, (user_id % 90)::VARCHAR AS age FROM events""")
def read_stacked_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports with demographics above the series: samples, event texts and age back together."""
    path = scratch(spark, "nol")
    df = samples(spark, sf_dir)
    head = F.concat(F.lit("Id,Age\n"), c("user_id").cast("string"), F.lit(","), (c("user_id") % 90).cast("string"), F.lit("\n\n  Abs Time Vector,Relative Time,NOL,HR,Events\n"))
    at = F.date_format(F.timestamp_seconds(F.lit(1_786_543_200) + c("event_id")), "dd-MMM-yyyy HH:mm:ss")
    nan = lambda keep: F.when(keep, c("value").cast("string")).otherwise("NaN")
    event = F.when(c("event_type") == "signup", '" Intubation"').otherwise("")
    line = F.concat_ws(",", at, c("event_id").cast("string"), nan(c("event_type") != "error"), nan(c("event_type") == "error"), event)
    sinks.raw_files(_files(df, F.concat(c("user_id").cast("string"), F.lit(".csv")), head, line), path)
    got = readers.nol_export(spark, path)
    age = got["demographics"].where("field = 'Age'").select("path", c("value").alias("age"))
    out = got["series"].join(age, "path", "left").join(got["events"].select("path", "ts", c("text").alias("event")), ["path", "ts"], "left")
    recording = F.regexp_extract("path", r"([0-9]+)\.csv$", 1)
    return out.select(recording.alias("recording_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "relative_s", "nol", "hr", "event", "age")


def _word(x: Column) -> Column:
    """A 16-bit integer's two bytes as hexadecimal digits, the low byte first."""
    digits = F.lpad(F.hex(F.when(x < 0, x + 65536).otherwise(x)), 4, "0")
    return F.concat(F.substring(digits, 3, 2), F.substring(digits, 1, 2))


_EEG = "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, (event_id % 2001 - 1000)::INTEGER AS a, CASE WHEN user_id % 5 = 0 THEN 7 ELSE (event_id % 301)::INTEGER END AS b FROM events"


def _eeg(spark: SparkSession, sf_dir: str) -> str:
    """Two channels of raw EEG for each user, and trends for some; a file of each tenth user has a byte too many."""
    path = scratch(spark, "eeg")
    df = samples(spark, sf_dir)
    a, b = (c("event_id") % 2001 - 1000).cast("int"), F.when(c("user_id") % 5 == 0, 7).otherwise((c("event_id") % 301).cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct("event_id", F.concat(_word(a), _word(b)).alias("w"))))
    raw = df.groupBy("user_id").agg(F.array_join(F.transform(ordered, lambda x: x["w"]), "").alias("w"))
    odd = F.when(c("user_id") % 10 == 3, "00").otherwise("")
    sinks.raw_files(raw.select(F.concat(c("user_id").cast("string"), F.lit(".r2a")).alias("name"), F.unhex(F.concat("w", odd)).alias("content")), path)
    at = F.date_format(F.timestamp_seconds(F.lit(1_767_225_600) + c("event_id")), "yyyy-MM-dd HH:mm:ss")
    line = F.concat_ws("|", at, (c("value") - 100).cast("string"), F.lit(" 40 "))
    trends = _files(df.where("user_id % 4 <> 1"), F.concat(c("user_id").cast("string"), F.lit(".spa")), F.lit("made by x\nSystem Time | BIS value| other"), line)
    sinks.raw_files(trends, path)
    return path


@query(f"""
WITH e AS ({_EEG}), n AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id)
SELECT user_id::VARCHAR AS recording_id, channel, i, i / 128.0::DOUBLE AS t_s, round((CASE WHEN channel = 0 THEN a ELSE b END) * {readers.EEG_SCALE}::DOUBLE, 9) AS value, NULL AS error
FROM e, (VALUES (0), (1)) k(channel) WHERE user_id % 10 <> 3
UNION ALL SELECT user_id::VARCHAR, NULL, NULL, NULL, NULL, 'odd number of bytes' FROM n WHERE user_id % 10 = 3""")
def read_raw_eeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.eeg_raw(spark, f"{_eeg(spark, sf_dir)}/*.r2a").withColumn("value", F.round("value", 9))


@query("""
SELECT user_id::VARCHAR AS recording_id, strftime(TIMESTAMP '2026-01-01' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S') AS t, CASE WHEN round(value - 100, 6) >= 0 THEN round(value - 100, 6) END AS value FROM events WHERE user_id % 4 <> 1""")
def read_eeg_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = readers.eeg_trends(spark, f"{_eeg(spark, sf_dir)}/*.spa", {"time": "time", "BIS": "bis"}, {"time": 0, "BIS": 1})
    return got.select("recording_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), F.round("value", 6).alias("value"))


@query(f"""
WITH e AS ({_EEG}), r AS (SELECT user_id, (count(*) - 1) / 128.0::DOUBLE AS raw_s, count(*) > 128 AND (min(a) = max(a) OR min(b) = max(b)) AS flat_channel FROM e WHERE user_id % 10 <> 3 GROUP BY user_id),
t AS (SELECT user_id, min(event_id) AS t_start, (max(event_id) - min(event_id))::DOUBLE AS trend_s FROM events WHERE user_id % 4 <> 1 GROUP BY user_id)
SELECT user_id::VARCHAR AS recording_id, raw_s, flat_channel, t_start, trend_s, coalesce(abs(raw_s - trend_s) > 5, false) AS duration_mismatch
FROM r FULL JOIN t USING (user_id)""")
def pairs_of_eeg_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw EEG beside its trends: lengths, flat channels, and the start that the trends give."""
    path = _eeg(spark, sf_dir)
    trends = readers.eeg_trends(spark, f"{path}/*.spa", {"time": "time", "BIS": "bis"}, {"time": 0, "BIS": 1})
    out = readers.eeg_pairs(readers.eeg_raw(spark, f"{path}/*.r2a"), trends)
    return out.select("recording_id", "raw_s", "flat_channel", (F.unix_seconds("t_start") - 1_767_225_600).alias("t_start"), "trend_s", "duration_mismatch")


def _zips(spark: SparkSession, sf_dir: str) -> str:
    """An exam for each user, a member for each kind of event, times in disorder; some exams are spoilt: by another id in the
    footer, a damaged member, a wrong name, or by not being an archive."""
    path = scratch(spark, "exams")

    def pack(key, table):
        import io
        import zipfile

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        user, out = key[0].as_py(), io.BytesIO()
        name = f"p_{user}_2026-01-05_12-00-00_{user:08x}_{user + 1:08x}.parquet.zip"
        table = table.sort_by([("event_type", "ascending"), ("event_id", "descending")])
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED if user % 2 else zipfile.ZIP_STORED) as z:
            for kind in pc.unique(table["event_type"]).to_pylist():
                rows = table.filter(pc.equal(table["event_type"], kind))
                value = pc.if_else(pc.equal(pc.bit_wise_and(rows["event_id"], 7), 0), -32768.0, rows["value"])
                part = pa.table({"local_time": rows["event_id"].cast("float64"), "value": value, **({"extra": value} if kind == "view" else {})})
                pairs = {"exam_guid": f"{user + 1 + (user % 10 == 3):08X}", "session_guid": f"{user:08x}", "sampling_frequency": f"['draeger_ecg={user}', 'other=2']"}
                raw = io.BytesIO()
                pq.write_table(part.replace_schema_metadata(pairs), raw)
                z.writestr(f"time_bin=0/sensor={'draeger' if kind == 'click' else 'other'}/signal={kind}/x.parquet", raw.getvalue())
        content = bytearray(out.getvalue())
        if user % 10 == 4:
            content[120] ^= 255
        name = name.replace("_2026-01", "-2026-01") if user % 10 == 5 else name
        return pa.table({"name": [name], "content": pa.array([b"none" if user % 10 == 6 else bytes(content)], pa.binary())})

    files = samples(spark, sf_dir).select("user_id", "event_id", "event_type", "value").groupBy("user_id").applyInArrow(pack, "name string, content binary")
    sinks.raw_files(files, path)
    return path


def _user() -> Column:
    return F.regexp_extract("path", r"/p_([0-9]+)[_-]2026", 1).cast("long").alias("user_id")


@query("""
WITH f AS (SELECT user_id, min(event_type) AS first FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN event_type = 'click' THEN 'draeger' ELSE 'other' END AS sensor, event_type AS signal, event_id::DOUBLE AS local_time,
       CASE WHEN event_id % 8 = 0 THEN CASE WHEN event_type <> 'click' THEN -32768.0 END ELSE value END AS value, true AS crc_ok
FROM events JOIN f USING (user_id) WHERE user_id % 10 <> 6 AND NOT (user_id % 10 = 4 AND event_type = first)
UNION ALL SELECT user_id, CASE WHEN first = 'click' THEN 'draeger' ELSE 'other' END, first, NULL, NULL, false FROM f WHERE user_id % 10 = 4""")
def read_zipped_exams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by member; a damaged member is one row, the others of its exam are read."""
    path = _zips(spark, sf_dir)
    got = readers.exam_zip(spark, path).withColumn("path", F.concat(F.lit("/"), "exam"))
    return got.select(_user(), "sensor", "signal", "local_time", "value", "crc_ok")


@query("""
SELECT user_id, CASE WHEN user_id % 10 = 6 THEN 0 ELSE count(DISTINCT event_type) END AS n_members,
       CASE user_id % 10 WHEN 3 THEN 'guid_mismatch' WHEN 4 THEN 'crc32_failure' WHEN 5 THEN 'bad_filename' WHEN 6 THEN 'unreadable_zip' END AS reason,
       CASE WHEN user_id % 10 NOT IN (4, 6) THEN user_id::VARCHAR END AS ecg_hz, CASE WHEN user_id % 10 NOT IN (4, 6) THEN bool_or(event_type = 'view') END AS has_extra,
       CASE WHEN user_id % 10 NOT IN (4, 6) THEN 5 END AS n_missing
FROM events GROUP BY user_id""")
def checked_exams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which exams to keep out, by name, directory, checksums and footers."""
    out = archives.exams(archives.members(spark, _zips(spark, sf_dir)))
    whole = ~F.coalesce(c("reason").isin("crc32_failure", "unreadable_zip"), F.lit(False))
    return out.select(
        _user(),
        "n_members",
        "reason",
        F.when(whole, c("sampling_frequency")["draeger_ecg"]).alias("ecg_hz"),
        F.when(whole, F.array_contains("unexpected", "extra")).alias("has_extra"),
        F.when(whole, F.size("missing")).alias("n_missing"),
    )


@query("""
WITH n AS (SELECT user_id, least(count(*), 200) AS n FROM events GROUP BY user_id),
k AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
m AS (SELECT user_id, bool_or(event_type = 'error') AS hidden, bool_or(event_type = 'signup') AS blank FROM k WHERE i <= 200 GROUP BY user_id)
SELECT user_id, CASE user_id % 4 WHEN 1 THEN ',' WHEN 2 THEN chr(9) WHEN 3 THEN '|' ELSE ';' END AS delimiter, CASE user_id % 4 WHEN 2 THEN 'cp1252' WHEN 3 THEN 'utf-8-sig' ELSE 'utf-8' END AS encoding,
       3 AS n_columns, user_id % 4 = 3 AS stacked, CASE user_id % 4 WHEN 0 THEN 'Horodatage' WHEN 1 THEN 'b' WHEN 2 THEN 'Datum/Date' ELSE 'Abs Time Vector' END AS time_column,
       CASE user_id % 4 WHEN 0 THEN 'YYYYMMDDHHMMSS' WHEN 1 THEN 'ISO datetime' WHEN 2 THEN 'DD/MM/YYYY' ELSE 'DD-Mon-YYYY HH:MM:SS' END AS time_format,
       CASE WHEN blank AND hidden THEN '(blank),-1401' WHEN blank THEN '(blank)' WHEN hidden THEN '-1401' ELSE '' END AS tokens
FROM events JOIN m USING (user_id) GROUP BY ALL""")
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of four unknown kinds: delimiter, encoding, headings, the time column and its format, and missing tokens."""
    from pulsegrid.sources import discovery

    path = scratch(spark, "unknown")
    df = samples(spark, sf_dir).withColumn("at", F.timestamp_seconds(F.lit(1_767_225_600) + c("event_id")))
    cell = F.when(c("event_type") == "error", "-1401").when(c("event_type") == "signup", "").otherwise(c("value").cast("string"))
    kinds = (
        (";", "UTF-8", "Horodatage;a;n", [F.date_format("at", "yyyyMMddHHmmss"), cell, F.lit("7")]),
        (",", "UTF-8", "a,b,n", [cell, F.date_format("at", "yyyy-MM-dd'T'HH:mm"), F.lit("7")]),
        ("\t", "ISO-8859-1", "é\tDatum/Date\tn", [cell, F.date_format("at", "dd/MM/yyyy"), F.lit("7")]),
        ("|", "UTF-8", "﻿Abs Time Vector|a|n\n1|2|3\nsecond|heading|n", [F.date_format("at", "dd-MMM-yyyy HH:mm:ss"), cell, F.lit("7")]),
    )
    for i, (sep, encoding, heading, cells) in enumerate(kinds):
        name = F.concat(c("user_id").cast("string"), F.lit(".txt"))
        sinks.raw_files(_files(df.where(c("user_id") % 4 == i), name, F.lit(heading), F.concat_ws(sep, *cells), encoding=encoding), path)
    out = discovery.discovered(discovery.heads(spark, path))
    user = F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("long").alias("user_id")
    return out.select(user, "delimiter", "encoding", "n_columns", "stacked", "time_column", "time_format", F.array_join("missing_tokens", ",").alias("tokens"))
