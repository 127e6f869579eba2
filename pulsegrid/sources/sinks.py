"""Writers: each can be repeated without writing anything twice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.functions.columns import micros
from pulsegrid.operators.catalog import new_rows
from pulsegrid.sources import tables


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def append_new(rows: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None) -> tuple[int, int]:
    """Appends the rows whose keys the table doesn't hold; null equals null. Returns rows given and rows written.

    Of rows with the same keys the smallest by their other columns is written.
    """
    spark = rows.sparkSession
    given = rows.count()
    rest = [c for c in rows.columns if c not in keys]
    names = rows.columns
    rows = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*").select(*names) if rest else rows.dropDuplicates(keys)
    fresh = new_rows(rows, spark.read.parquet(path), keys) if exists(spark, path) else rows
    # Counted before the append, which would make them old.
    written = fresh.count()
    if written:
        writer = fresh.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return given, written


def signal_table(long: DataFrame, path: str) -> tuple[int, int]:
    """Samples (recording_id, ts, variable, value) into the signal table, of which only the days of the samples are read;
    ``tables.read`` gives it back."""
    return tables.insert(long.withColumn("day", F.to_date("ts")), path, ["recording_id", "variable", "ts"], "day")


def exam_table(samples: DataFrame, path: str) -> tuple[int, int]:
    """Exams by sensor and signal; free text stays out. A sample is known by exam, sensor, signal and local_time."""
    free = [c for c in ("annotation", "form") if c in samples.columns]
    return append_new(samples.drop(*free), path, ["exam", "sensor", "signal", "local_time"], ["sensor", "signal"])


def quarantine(df: DataFrame, bad, reason: str, path: str) -> DataFrame:
    """Rows for which ``bad`` holds go to the quarantine with the reason, each once; the others are returned."""
    bad = F.coalesce(bad, F.lit(False))
    append_new(df.where(bad).withColumn("reason", F.lit(reason)), path, [*df.columns, "reason"])
    return df.where(~bad)


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows with the incoming ones in the place of those with their keys; null equals null."""
    return new_rows(current, incoming, keys).unionByName(incoming, allowMissingColumns=True)


def catalog_files(catalog: DataFrame, json_path: str, csv_path: str, summary: list[str]) -> None:
    catalog.write.mode("overwrite").json(json_path)
    catalog.select(*summary).write.mode("overwrite").option("header", True).csv(csv_path)


def feed(df: DataFrame, path: str) -> None:
    """One JSON text per row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def flagged(df: DataFrame, path: str, values: list[str], qc: list[str], review) -> None:
    """Filtered values, their labels and the rows for review, in three places; raw data are never touched."""
    keys = [c for c in df.columns if c not in values and c not in qc]
    df.select(*keys, *values).write.mode("overwrite").parquet(f"{path}/filtered")
    df.select(*keys, *qc).write.mode("overwrite").parquet(f"{path}/qc")
    df.where(review).write.mode("overwrite").json(f"{path}/review")


def audit(spark: SparkSession, path: str, run: str, status: str, n_rows: int) -> None:
    """One row per run and status."""
    row = spark.createDataFrame([(run, status, n_rows)], "run string, status string, n_rows long")
    append_new(row.withColumn("at", F.current_timestamp()), path, ["run", "status"])


def content_hashes(samples: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """key, sha256: a hash of each recording's rows, whatever order they come in. It is of its hours' digests in turn, each
    of its rows' digests in the order of time, so that no recording is gathered in one row; nulls count as empty texts."""
    line = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)
    rows = samples.select(key, micros(F.col(ts)).alias("us"), line.alias("h"))
    digest = lambda at: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "h"))), lambda x: x["h"]), ""), 256)
    hours = rows.groupBy(key, F.floor(F.col("us") / 3_600_000_000).alias("hour")).agg(digest("us").alias("h"))
    return hours.groupBy(key).agg(digest("hour").alias("sha256"))


def standardised(samples: DataFrame, path: str, hashes: DataFrame) -> tuple[int, int]:
    """Samples of recordings by project and device, each under a key of patient, device and its content's hash; a recording
    that is there already isn't written again. hashes: recording_id, sha256; a recording's own hash."""
    key = F.concat_ws("_", "patient", "device", F.substring("sha256", 1, 8))
    rows = samples.join(hashes, "recording_id").withColumn("key", key)
    return append_new(rows, path, ["key", "variable", "ts"], ["project", "device"])


def get_or_create(names: DataFrame, path: str, keys: list[str], id_col: str) -> DataFrame:
    """The table of ids by ``keys`` with the missing ones added after the greatest id, in the order of the keys."""
    spark = names.sparkSession
    wanted = names.select(*keys).distinct()
    if exists(spark, path):
        known = spark.read.parquet(path)
        top = known.agg(F.max(id_col)).first()[0] or 0
        wanted = new_rows(wanted, known, keys)
    else:
        top = 0
    # Dealt by range, each partition numbers its own rows after those before it: no single sorted task. Ranges are written
    # before they are counted, as a second run of the same plan may cut them at other places.
    ranged = f"{path.rstrip('/')}-ranged-{uuid.uuid4().hex}"
    rows = wanted.repartitionByRange(*keys).withColumn("__p", F.spark_partition_id())
    rows.write.parquet(ranged)
    rows = spark.read.schema(rows.schema).parquet(ranged)
    rows = rows.withColumn("__i", F.row_number().over(Window.partitionBy("__p").orderBy(*keys)))
    sizes = rows.groupBy("__p").count().collect()  # a number per partition
    starts, at = [], top
    for r in sorted(sizes, key=lambda r: r["__p"]):
        starts.append((r["__p"], at))
        at += r["count"]
    if starts:
        offset = F.create_map(*[F.lit(x) for kv in starts for x in kv])[F.col("__p")]
        rows.withColumn(id_col, (offset + F.col("__i")).cast("long")).select(*keys, id_col).write.mode("append").parquet(path)
    remove(spark, ranged)
    return spark.read.parquet(path)


def register(entries: DataFrame, path: str) -> DataFrame:
    """Registers files of a catalogue (project, patient, device, sha256, parse_status): projects, their participants, devices
    and recordings get ids that stay, a recording being known by its content. A recording that is there already gets the
    new parse status, but entries that only say ``duplicate`` leave it alone. Returns the recordings.

    Each level's distinct names, not its files, are matched with the ids there are.
    """
    entries = entries.where(~F.coalesce(F.col("parse_status") == "duplicate", F.lit(False)))
    ids = lambda rows, name, keys, id_col: get_or_create(rows.select(*keys), f"{path}/{name}", keys, id_col)

    def with_id(rows: DataFrame, name: str, keys: list[str], id_col: str) -> DataFrame:
        known = ids(rows, name, keys, id_col)
        return rows.join(known, [rows[k].eqNullSafe(known[k]) for k in keys]).select(*[rows[c] for c in rows.columns], known[id_col])

    rows = with_id(entries, "projects", ["project"], "project_id")
    rows = with_id(rows, "participants", ["project_id", "patient"], "participant_id")
    rows = with_id(rows, "devices", ["device"], "device_id")
    rows = with_id(rows, "recording_ids", ["sha256"], "recording_id")
    rows = rows.select("recording_id", "participant_id", "device_id", "sha256", F.coalesce("parse_status", F.lit("pending")).alias("parse_status"), F.lit("RECEIVED").alias("status"), F.left("sha256", F.lit(2)).alias("bucket"))
    tables.replace(rows, f"{path}/recordings", ["sha256"], "bucket")
    return tables.read(rows.sparkSession, f"{path}/recordings").drop("bucket")


def statistics_book(tables: dict[str, DataFrame], path: str) -> None:
    """A folder of CSV sheets."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


#: Rows of one file of an export.
FILE_ROWS = 1_000_000


def _unit_files(rows: DataFrame, path: str, keys: list[str]) -> None:
    """CSV files path/key=value/.../part-<i>.csv as Spark would partition them, written line by line by the task that a
    unit's part is dealt to, under another name until they are whole; other files in a unit's folder go.

    Spark's own writer makes folders and renames one after another, and on local disks starts a process for each.
    """
    columns = [c for c in rows.columns if c not in (*keys, "__parts")]
    plain = lambda x: F.coalesce(F.nullif(x.cast("string"), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    heading = rows.sparkSession.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(c) for c in columns]))).first()[0]
    part = F.pmod(F.xxhash64(*columns), F.col("__parts")).cast("int")
    lines = rows.select(F.array(*[plain(F.col(k)) for k in keys]).alias("unit"), part.alias("part"), "__parts", F.to_csv(F.struct(*columns)).alias("line"))
    lines = lines.repartition("unit", "part").sortWithinPartitions("unit", "part")

    def put(batches):
        import re

        import pyarrow as pa
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        escaped = lambda x: re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", x)
        now, out, draft, target = None, None, None, None

        def whole() -> None:
            if out is not None:
                out.close()
                store.move(draft, target)

        for batch in batches:
            for unit, i, parts, line in zip(*(c.to_pylist() for c in batch.columns)):
                if (unit, i) != now:
                    whole()
                    now = unit, i
                    folder = "/".join([at, *[f"{k}={escaped(v)}" for k, v in zip(keys, unit)]])
                    store.create_dir(folder, recursive=True)
                    kept = {f"part-{k:05}.csv" for k in range(parts)}
                    for info in store.get_file_info(fs.FileSelector(folder)) if i == 0 else ():
                        if info.type == fs.FileType.File and info.base_name[0] not in "._" and info.base_name not in kept:
                            store.delete_file(info.path)
                    target = f"{folder}/part-{i:05}.csv"
                    draft = f"{folder}/.part-{i:05}.{uuid.uuid4().hex}"
                    out = store.open_output_stream(draft)
                    out.write(f"{heading}\n".encode())
                out.write(f"{line}\n".encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})
        whole()

    lines.mapInArrow(put, "n long").agg(F.sum("n")).collect()


def csv_exports(df: DataFrame, path: str, keys: list[str]) -> tuple[int, int]:
    """Rows as CSV under a folder for each unit (``keys``, a project and patient, say), but for units that were exported before.
    Returns units exported and units skipped.

    An export is noted after its files are written, and files of a unit replace what an export that died left there. Null
    keys are a unit of their own.
    """
    spark, done = df.sparkSession, f"{path}/_exported"
    units = df.select(*keys).distinct()
    n = units.count()
    fresh = new_rows(units, spark.read.parquet(done), keys) if exists(spark, done) else units
    # Kept, as what is noted below must be what was written.
    fresh = fresh.persist()
    added = fresh.count()
    if added:
        names = {k: f"__{k}" for k in keys}
        same = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
        rows = df.join(fresh.withColumnsRenamed(names), same, "left_semi")
        sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / FILE_ROWS).cast("int").alias("__parts")).withColumnsRenamed(names)
        _unit_files(rows.join(sizes, same).drop(*names.values()), f"{path}/csv", keys)
        fresh.write.mode("append").parquet(done)
    fresh.unpersist()
    return added, n - added


def raw_files(files: DataFrame, path: str) -> None:
    """Each row's content (binary) as a file of its name under ``path``, written by the tasks; again the same, if repeated."""

    def put(batches):
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        store.create_dir(at, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{at}/{name}") as out:
                    out.write(content)
            yield batch.select([0])

    files.select(F.col("name"), F.col("content")).mapInArrow(put, "name string").count()
