"""Keyed tables on plain Parquet whose writes touch few buckets and become visible at once.

A table is a folder of data folders, none of which is ever changed, and of numbered manifests. A manifest lists the data
folders of each bucket (a day, say). A write reads only the buckets that its rows fall in, writes new folders, and commits
by creating the next manifest: a write that dies before that leaves the version before it as it was, and of two writers at
once the second fails. A bucket must follow from the keys, so that a key is only ever looked for in its own bucket.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrid.operators.catalog import new_rows

_NULL = "__null__"


class Conflict(RuntimeError):
    """Another writer has committed since this one read the table."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, in order; files of writers that died are none."""
    fs, p = _fs(spark, f"{path}/_manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """version, schema and buckets (name to data folders) of a version, the last one if none is named."""
    known = versions(spark, path)
    if version is None:
        if not known:
            return {"version": 0, "schema": None, "buckets": {}}
        version = known[-1]
    if version not in known:
        raise KeyError(f"version {version} of {path}")
    fs, p = _fs(spark, f"{path}/_manifests/{version:08}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, now: dict) -> None:
    """Makes a manifest the table's next version, or fails if there is one of its number: it is written under another name
    first, and renamed, which doesn't replace a file."""
    fs, target = _fs(spark, f"{path}/_manifests/{now['version']:08}.json")
    _, draft = _fs(spark, f"{path}/_manifests/{now['version']:08}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(now).encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        raise Conflict(f"version {now['version']} of {path}")


def bucket_name(bucket: str):
    return F.coalesce(F.col(bucket).cast("string"), F.lit(_NULL))


def read(spark: SparkSession, path: str, buckets: list[str] | None = None, version: int | None = None) -> DataFrame | None:
    """The rows of a version, or of some of its buckets: only their folders are listed and read. None without any."""
    now = manifest(spark, path, version)
    folders = [f"{path}/{f}" for b, fs in sorted(now["buckets"].items()) if buckets is None or b in buckets for f in fs]
    if not now["schema"]:
        return None
    schema = StructType.fromJson(now["schema"])
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _write(rows: DataFrame, path: str, bucket: str, now: dict, touched: list[str], replace: bool) -> dict:
    """Data folders for the rows, and the manifest that has them: in the place of the touched buckets, or beside what
    they hold."""
    spark, version = rows.sparkSession, now["version"] + 1
    folder = f"data/{version:08}-{uuid.uuid4().hex}"
    rows.withColumn("__bucket", bucket_name(bucket)).write.partitionBy("__bucket").parquet(f"{path}/{folder}")
    fs, p = _fs(spark, f"{path}/{folder}")
    made = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    by_bucket = {unescape(name.split("=", 1)[1]): f"{folder}/{name}" for name in made}
    buckets = {b: list(fs) for b, fs in now["buckets"].items() if not (replace and b in touched)}
    for b, f in by_bucket.items():
        buckets[b] = [*buckets.get(b, []), f]
    return {"version": version, "schema": rows.schema.jsonValue(), "buckets": buckets}


def _touched(rows: DataFrame, bucket: str) -> list[str]:
    """The buckets of the rows: names of days or the like, few beside the rows."""
    return sorted(r[0] for r in rows.select(bucket_name(bucket)).distinct().collect())


def _once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with the same keys the smallest by their other columns."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*").select(*rows.columns)


def insert(rows: DataFrame, path: str, keys: list[str], bucket: str) -> tuple[int, int]:
    """Adds the rows whose keys the table doesn't hold; null equals null. Returns rows given and rows added; without any
    to add there is no new version."""
    spark, given, now = rows.sparkSession, rows.count(), None
    now = manifest(spark, path)
    touched = _touched(rows, bucket)
    held = read(spark, path, touched) if now["version"] else None
    fresh = _once(rows, keys)
    if held is not None:
        fresh = new_rows(fresh, held.select(*fresh.columns), keys)
    after = _write(fresh, path, bucket, now, touched, replace=False)
    folders = [f"{path}/{f}" for b, fs in after["buckets"].items() for f in fs if f not in now["buckets"].get(b, [])]
    written = spark.read.parquet(*folders).count() if folders else 0
    if written:
        commit(spark, path, after)
    return given, written


def replace(rows: DataFrame, path: str, keys: list[str], bucket: str) -> tuple[int, int]:
    """Puts the rows in the place of those with their keys and adds the others; the buckets they fall in are written anew,
    the rest isn't read. Null equals null. Returns rows given and rows of the rewritten buckets."""
    spark, given = rows.sparkSession, rows.count()
    now = manifest(spark, path)
    touched = _touched(rows, bucket)
    if not touched:
        return 0, 0
    fresh = _once(rows, keys)
    held = read(spark, path, touched) if now["version"] else None
    if held is not None:
        fresh = new_rows(held.select(*fresh.columns), fresh, keys).unionByName(fresh)
    after = _write(fresh, path, bucket, now, touched, replace=True)
    commit(spark, path, after)
    return given, read(spark, path, touched).count()
