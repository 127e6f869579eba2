"""What the operators of this subpackage share: shared tables, checked broadcasts and word splitting."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and has at most so many bytes.
BROADCAST_BYTES = 32 << 20

#: Rows go to Python workers in batches of about so many bytes at most, where a stage asks for it.
BATCH_BYTES = 4 << 20

#: Separators of words once A-Z are lower-cased: every ASCII byte but 0-9 and a-z.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: bytes.translate table: A-Z to a-z, separators to a space, everything else as it is.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        # Driver and executors are one process.
        path = spark.conf.get("spark.pulsegrid.shared.dir", None)
        if not path:
            path = "file://" + tempfile.mkdtemp(prefix="pulsegrid-shared-")
            spark.conf.set("spark.pulsegrid.shared.dir", path)
    return path.rstrip("/")


def table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: a cut of the lineage that outlives executors."""
    path = table_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay under BROADCAST_BYTES, else as it is (a shuffle join)."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def few_rows(spark: SparkSession, **columns: list) -> DataFrame:
    """A small table of lists. Arrow carries it: Python rows would start workers of another kind, which then idle for a minute."""
    return spark.createDataFrame(pa.table(columns))


def in_small_batches(stage):
    """``stage`` (its first argument is the session) with batches of about BATCH_BYTES at most, from then on in its session.

    A limit that the session has been given stays. Spark's default, 10,000 rows up to 64 MB, stands in the JVM and in the
    worker at once.
    """

    @wraps(stage)
    def bounded(spark: SparkSession, *args, **kwargs):
        key = "spark.sql.execution.arrow.maxBytesPerBatch"
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(BATCH_BYTES))
        return stage(spark, *args, **kwargs)

    return bounded


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` but for those whose id is in ``ids`` (one column, any name)."""
    gone = materialize(ids.select(F.col(ids.columns[0]).alias("__gone_id")).distinct(), "gone")
    gone = maybe_broadcast(gone, gone.count(), 16)
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__gone_id")), "left_anti")


def lower_ascii(text):
    """A-Z to a-z and nothing else, null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def words_native(text):
    """The words of a text column as an array, by built-in functions."""
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD_PATTERN), F.lit(0))


def words_of(text: str | None) -> list[bytes]:
    """The same words as UTF-8 bytes, for code inside tasks."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator reads, under names of its own; clashing extra columns are left behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def release() -> None:
    """Gives what a task has freed back to the system: a worker is reused, and what it keeps adds up."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batch: pa.RecordBatch, text_index: int, most_bytes: int = 2 << 20):
    """A batch in row slices of about ``most_bytes`` of text, so that arrays made from them stay small."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text_index)), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    yield batch.slice(begin)
