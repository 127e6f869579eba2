"""Streams over folders of files; each takes a checkpoint folder, so that a restart goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """Rows of files as they arrive; each file is read once."""
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.format(kind).load(path)


def run_available(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process all that is there and stop: what the next run finds is only what came since."""
    query = df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def watch(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, seconds: int) -> StreamingQuery:
    """Batches at most every so many seconds; what arrives meanwhile goes together."""
    return df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def once_per_exam(df: DataFrame, exam: str, ts: str, late: str = "7 days") -> DataFrame:
    """The first row per exam; a repeat within the watermark's reach is dropped."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark([exam])


def windowed(df: DataFrame, keys: list[str], ts: str, value: str, width: str, late: str = "1 second") -> DataFrame:
    """Count, mean and extremes per key and tumbling window; samples later than the watermark no longer count."""
    rows = df.withWatermark(ts, late).groupBy(*keys, F.window(ts, width).alias("w"))
    out = rows.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return out.select(*keys, F.col("w.start").alias("w_start"), "n", "mean", "min", "max")


def sessions(df: DataFrame, keys: list[str], ts: str, gap: str, late: str = "1 second") -> DataFrame:
    """Stretches of samples without a pause longer than ``gap``."""
    rows = df.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, gap).alias("w"))
    return rows.agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("t_start"), F.col("w.end").alias("t_end"), "n")


def gap_alarms(df: DataFrame, key: str, ts: str, limit_s: float) -> DataFrame:
    """A row for every pause over ``limit_s`` between a recording's samples, across batches: key, gap_start, gap_s.

    The state of a recording is its last time stamp. Samples of a batch are put in order; older ones than the state are
    late and give no pause.
    """

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Whole microseconds, which a double holds exactly.
        last = int(state.get[0]) if state.exists else None
        times = pd.concat([p[ts] for p in parts]).sort_values().astype("datetime64[us]").astype("int64")
        begins, gaps = [], []
        for t in times.tolist():
            if last is not None and t - last > limit_s * 1e6:
                begins.append(last)
                gaps.append((t - last) / 1e6)
            last = t if last is None else max(last, t)
        state.update((float(last),))
        if gaps:
            yield pd.DataFrame({key: [k[0]] * len(gaps), "gap_start": pd.to_datetime(pd.Series(begins), unit="us"), "gap_s": gaps})

    kind = dict(df.dtypes)[key]
    return df.select(key, ts).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, gap_start timestamp, gap_s double", "last double", "append", GroupStateTimeout.NoTimeout)


def recordings(df: DataFrame, key: str, ts: str, limit_s: float, ends_after_s: float, late: str = "1 second") -> DataFrame:
    """What happens to recordings, with state that ends with them: key, kind, at, gap_s, n_samples.

    ``gap``: a pause over ``limit_s`` began at ``at``. ``ended``: ``at`` was the last sample, as the watermark is
    ``ends_after_s`` beyond it; the recording's state, a time and a count, is dropped then. A sample that comes after that
    begins the recording anew. Samples of a batch are put in order; those older than the state count but give no pause, and
    null times are left out.
    """
    kind, column = dict(df.dtypes)[key], key
    micros, wait = int(limit_s * 1e6), int(ends_after_s * 1000)

    def rows_of(k: tuple, what: str, at: list[int], gap: list[float | None], n: int) -> pd.DataFrame:
        times = pd.to_datetime(pd.Series(at, dtype="int64"), unit="us")
        return pd.DataFrame({column: [k[0]] * len(at), "kind": what, "at": times, "gap_s": pd.Series(gap, dtype="float64"), "n_samples": n})

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (None, 0)
        if state.hasTimedOut:
            state.remove()
            yield rows_of(k, "ended", [last], [None], n)
            return
        times = np.sort(np.concatenate([p[ts].dropna().to_numpy("datetime64[us]").astype(np.int64) for p in parts]))
        begins, gaps = [], []
        if len(times):
            # What came before each: the latest so far, of the state too.
            before = np.append(times[0] if last is None else last, np.maximum(times[:-1], times[0] if last is None else last))
            wide = times - before > micros
            begins, gaps = before[wide].tolist(), ((times - before)[wide] / 1e6).tolist()
            last, n = int(times[-1] if last is None else max(last, times[-1])), n + len(times)
        if last is not None:
            state.update((last, n))
            # Whole milliseconds are what timeouts count in, so one a millisecond late at most; they lie beyond the watermark.
            state.setTimeoutTimestamp(max(-(-last // 1000) + wait, state.getCurrentWatermarkMs() + 1))
        if gaps:
            yield rows_of(k, "gap", begins, gaps, n)

    # State of many recordings is kept in RocksDB, not in memory.
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = df.select(key, ts).withWatermark(ts, late).groupBy(key)
    schema = f"{key} {kind}, kind string, at timestamp, gap_s double, n_samples long"
    return rows.applyInPandasWithState(step, schema, "last long, n long", "append", GroupStateTimeout.EventTimeTimeout)


def states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state that ``recordings`` holds after its last batch: key, last, n."""
    found = spark.read.format("statestore").option("path", checkpoint).load()
    return found.select(F.col("key").getField(found.schema["key"].dataType.names[0]).alias("key"), "value.groupState.last", "value.groupState.n")
