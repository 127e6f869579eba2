"""Filters of series. The recursive ones run in blocks, between which a scan carries the filter's state."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.scans import join_on, numbered


def butter_sections(order: int, cutoff: float | tuple[float, float], fs: float, kind: str) -> np.ndarray | None:
    """Second-order sections of a digital Butterworth filter by the bilinear transform; None if the cut-offs don't lie
    between 0 and half the sampling rate."""
    edges = np.atleast_1d(np.asarray(cutoff, float))
    if (edges <= 0).any() or (edges >= fs / 2).any() or (len(edges) == 2 and edges[0] >= edges[1]):
        return None
    k = np.arange(1, order + 1)
    poles = np.exp(1j * np.pi * (2 * k + order - 1) / (2 * order))
    warped = 2 * fs * np.tan(np.pi * edges / fs)
    if kind == "low":
        zeros, poles, gain = np.zeros(0), poles * warped[0], warped[0] ** order
    elif kind == "high":
        zeros, poles, gain = np.zeros(order), warped[0] / poles, 1.0
    else:
        width, centre = warped[1] - warped[0], np.sqrt(warped[0] * warped[1])
        half = poles * width / 2
        root = np.sqrt(half**2 - centre**2 + 0j)
        zeros, poles, gain = np.zeros(order), np.concatenate([half + root, half - root]), width**order
    fs2 = 2 * fs
    gain = gain * np.real(np.prod(fs2 - zeros) / np.prod(fs2 - poles))
    zeros = np.concatenate([(fs2 + zeros) / (fs2 - zeros), -np.ones(len(poles) - len(zeros))])
    poles = (fs2 + poles) / (fs2 - poles)
    # Conjugate pairs together; a single real pole has a section of its own.
    real = sorted(poles[np.abs(poles.imag) < 1e-9].real)
    upper = sorted(poles[poles.imag >= 1e-9], key=lambda p: abs(abs(p) - 1))
    pairs = [(p, np.conj(p)) for p in upper] + [tuple(real[i : i + 2]) for i in range(0, len(real), 2)]
    zeros = sorted(zeros.real)
    sections = []
    for pair in pairs:
        take = [zeros.pop(0) if i % 2 == 0 else zeros.pop() for i in range(len(pair))]
        b, a = np.real(np.poly(take)), np.real(np.poly(pair))
        sections.append(np.concatenate([np.pad(b, (0, 3 - len(b))), np.pad(a, (0, 3 - len(a)))]))
    out = np.array(sections)
    out[0, :3] *= gain
    return out


def steady_state(sections: np.ndarray) -> np.ndarray:
    """Two numbers a section: the state that an endless input of 1 leaves the cascade in."""
    out, level = [], 1.0
    for b0, b1, b2, _, a1, a2 in sections:
        after = level * (b0 + b1 + b2) / (1 + a1 + a2)
        out += [after - b0 * level, b2 * level - a2 * after]
        level = after
    return np.array(out)


def cascade(sections: np.ndarray, x: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The recursion itself, sample by sample, for many blocks side by side: a block a row of ``x``, of so many samples,
    from its row of ``state``. Returns the outputs and the states after each block's last sample."""
    z, y, last = state.T.copy(), np.zeros_like(x), state.copy()
    for t in range(x.shape[1]):
        v = x[:, t]
        for k, (b0, b1, b2, _, a1, a2) in enumerate(sections):
            out = b0 * v + z[2 * k]
            z[2 * k] = b1 * v - a1 * out + z[2 * k + 1]
            z[2 * k + 1] = b2 * v - a2 * out
            v = out
        y[:, t] = v
        done = lengths == t + 1
        if done.any():
            last[done] = z[:, done].T
    return y, last


def step_matrix(sections: np.ndarray, samples: int) -> np.ndarray:
    """What so many samples make of a state: linear, whatever the input."""
    n = 2 * len(sections)
    one = cascade(sections, np.zeros((n, 1)), np.ones(n), np.eye(n))[1].T
    return np.linalg.matrix_power(one, samples)


def fft_band(x: np.ndarray, fs: float, low: float, high: float) -> np.ndarray:
    """Brick-wall band-pass."""
    spectrum = np.fft.rfft(x)
    f = np.fft.rfftfreq(len(x), 1 / fs)
    spectrum[(f < low) | (f > high)] = 0
    return np.fft.irfft(spectrum, len(x))


def ecg_qc(x: np.ndarray, fs: float) -> np.ndarray:
    """Label per second of an ECG, in this order of priority: FLAT, SATURATED, NOISY, DRIFT, VALID."""
    n = max(1, int(fs))
    seconds = -(-len(x) // n)
    out = np.full(seconds, "VALID", dtype=object)
    residual = x - fft_band(x, fs, 0, 25)
    drift = fft_band(x, fs, 0, 0.7)
    top, bottom = x.max(), x.min()
    for s in range(seconds):
        part = slice(s * n, min(len(x), (s + 1) * n))
        v = x[part]
        span = drift[max(0, (s - 1) * n) : (s + 1) * n]
        at = (v == top) | (v == bottom)
        longest = max((len(r) for r in "".join("1" if a else "0" for a in at).split("0")), default=0)
        if v.std() < 0.005:
            out[s] = "FLAT"
        elif longest >= max(5, n // 20):
            out[s] = "SATURATED"
        elif residual[part].std() > 0.04:
            out[s] = "NOISY"
        elif np.ptp(span) > 0.30:
            out[s] = "DRIFT"
    return out


#: Samples of a block.
BLOCK = 1024


def zero_phase(sections: np.ndarray, series: list[np.ndarray]) -> list[np.ndarray]:
    """Whole series forward and backward over odd extensions of both ends, side by side with others about as long."""
    steady, most = steady_state(sections), 3 * (2 * len(sections) + 1)
    out, turn = [np.zeros(0)] * len(series), sorted(range(len(series)), key=lambda i: len(series[i]))
    for begin in range(0, len(turn), 256):
        part = turn[begin : begin + 256]
        pads = [min(most, len(series[i]) - 1) for i in part]
        lengths = np.array([len(series[i]) + 2 * n for i, n in zip(part, pads)])
        wide = np.zeros((len(part), lengths.max()))
        for row, i, n in zip(wide, part, pads):
            v = series[i]
            row[:n], row[n : n + len(v)], row[n + len(v) : 2 * n + len(v)] = 2 * v[0] - v[n:0:-1], v, 2 * v[-1] - v[-2 : -2 - n : -1]
        for _ in range(2):
            wide = cascade(sections, wide, lengths, steady * wide[:, :1])[0]
            for row, n in zip(wide, lengths):
                row[:n] = row[:n][::-1].copy()
        for row, i, n in zip(wide, part, pads):
            out[i] = row[n : n + len(series[i])]
    return out


def _short_series(rows: DataFrame, keys: list[str], order: str, value: str, sections: np.ndarray, least: int) -> DataFrame:
    """Column ``filtered`` of series that are short enough to be held whole: they are sorted once, and each batch of sorted
    rows is filtered both ways at once. Those of under ``least`` samples stay as they are."""
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", filtered double"

    def run(batches):
        held = []
        for batch in itertools.chain(batches, [None]):
            table = pa.Table.from_batches([*held, *([batch] if batch else [])]) if held or batch else None
            if table is None or not table.num_rows:
                continue
            starts = np.flatnonzero(table.column("__i").to_numpy() == 1)
            # The last series goes on in the next batch, maybe.
            stops = starts[1:] if batch else np.append(starts[1:], table.num_rows)
            held = table.slice(starts[-1]).to_batches() if batch else []
            if not len(stops):
                continue
            table = table.slice(0, stops[-1])
            y = table.column(value).to_numpy().copy()
            spans = [(a, b) for a, b in zip(starts.tolist(), stops.tolist()) if b - a >= least]
            for (a, b), v in zip(spans, zero_phase(sections, [y[a:b] for a, b in spans])):
                y[a:b] = v
            yield from table.drop_columns("__i").append_column("filtered", pa.array(y)).combine_chunks().to_batches()

    own = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("__i", own).mapInArrow(run, schema)


def _blocks(rows: DataFrame, keys: list[str], order: str, value: str, block: int) -> DataFrame:
    """keys, __block, __s (order and value of its samples in turn), __blocks: the non-null samples of each series in blocks,
    of which the last has up to twice as many samples."""
    rows = numbered(rows, keys, order, block)
    sizes = rows.groupBy(*keys).agg(F.greatest(F.floor(F.count("*") / block), F.lit(1)).cast("int").alias("__blocks"), F.count("*").alias("__n"))
    rows = join_on(rows, sizes, keys).withColumn("__block", F.least(F.col("__stretch"), F.col("__blocks") - 1).cast("int"))
    samples = F.array_sort(F.collect_list(F.struct("__i", F.col(order).alias("o"), F.col(value).cast("double").alias("x"))))
    return rows.groupBy(*keys, "__block", "__blocks", "__n").agg(samples.alias("__s"))


def _run_blocks(df: DataFrame, sections: np.ndarray, out: str) -> DataFrame:
    """Each row's array __x through the filter from its __state: the array ``out``, and __end, the state after it."""
    columns = [c for c in df.columns if c != out]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*columns).dtypes) + f", {out} array<double>, __end array<double>"

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                xs = [np.array(v) for v in part.column(part.schema.get_field_index("__x")).to_pylist()]
                lengths = np.array([len(v) for v in xs])
                wide = np.zeros((len(xs), max(lengths)))
                for row, v in zip(wide, xs):
                    row[: len(v)] = v
                y, end = cascade(sections, wide, lengths, np.array(part.column(part.schema.get_field_index("__state")).to_pylist()))
                arrays = [*part.columns, pa.array([row[:n] for row, n in zip(y, lengths)], pa.list_(pa.float64())), pa.array(list(end), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, out, "__end"])

    return df.select(*columns).mapInArrow(run, schema)


def _pass(blocks: DataFrame, keys: list[str], sections: np.ndarray, block: int, most: int, out: str) -> DataFrame:
    """One pass over the arrays __x of the blocks, in the order of __nth, from the steady state of the first sample.

    A block changes a state by an affine map: all but the first by the same matrix, plus the state it ends in from rest.
    These maps compose, so the states between blocks come from a scan that doubles its reach each round, over one row a
    block; then every block runs once more from the state it starts in.
    """
    size = 2 * len(sections)
    start = F.transform(F.array(*[F.lit(float(v)) for v in steady_state(sections)]), lambda v: v * F.get("__x", F.lit(0)))
    rest = F.array(*[F.lit(0.0)] * size)
    rows = blocks.withColumn("__state", F.when(F.col("__nth") == 0, start).otherwise(rest))
    ends = _run_blocks(rows, sections, "__y").select(*keys, "__nth", *[F.get("__end", F.lit(i)).alias(f"__z{i}") for i in range(size)])
    w = Window.partitionBy(*keys).orderBy("__nth")
    power, reach = step_matrix(sections, block), 1
    while reach < most:
        old = lambda i: F.coalesce(F.lag(f"__z{i}", reach).over(w), F.lit(0.0))  # noqa: B023, E731
        ends = ends.withColumns({f"__z{i}": F.col(f"__z{i}") + sum(F.lit(float(power[i, j])) * old(j) for j in range(size)) for i in range(size)})
        power, reach = power @ power, 2 * reach
    entry = F.when(F.col("__nth") > 0, F.array(*[F.lag(f"__z{i}").over(w) for i in range(size)]))
    rows = join_on(rows, ends.select(*keys, "__nth", entry.alias("__entry")), [*keys, "__nth"])
    return _run_blocks(rows.withColumn("__state", F.coalesce("__entry", "__state")).drop("__entry"), sections, out).drop("__end", "__state")


def filtered(df: DataFrame, keys: list[str], order: str, value: str, fs: float, kind: str, cutoff, filter_order: int = 4, size: int = BLOCK) -> DataFrame:
    """Column ``filtered``: the zero-phase Butterworth filter of each series, in blocks of ``size`` samples.

    Forward and backward over odd extensions of both ends; nulls are left out and stay null. Series with too few samples
    (under 3 * order + 1) and cut-offs that don't fit the rate leave values as they are. Blocks give what one recursion
    over the whole series gives, whatever the filter remembers.
    """
    sections = butter_sections(filter_order, cutoff, fs, kind)
    columns = [*keys, order, value]
    same = df.select(*columns, F.col(value).cast("double").alias("filtered"))
    if sections is None:
        return same
    pad, least = 3 * (2 * len(sections) + 1), 3 * filter_order + 1
    size = max(size, pad + 1)
    given = df.select(*keys, order, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
    # What is one block needs neither places in the series nor a scan.
    several = given.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") >= 2 * size).drop("__n").persist()
    nulls = same.where(F.col(value).isNull())
    if several.isEmpty():
        return _short_series(given, keys, order, value, sections, least).unionByName(nulls)
    few = _short_series(join_on(given, several, keys, "left_anti"), keys, order, value, sections, least)
    blocks = _blocks(join_on(given, several, keys, "left_semi"), keys, order, value, size)
    # Kept as a table of their own: both passes and their scans read them.
    blocks = blocks.persist()
    most = blocks.agg(F.max("__blocks")).first()[0]
    rows = blocks.withColumn("__v", F.transform("__s", lambda s: s["x"]))
    n = F.least(F.lit(pad), F.col("__n").cast("int") - 1)
    first, last = F.get("__v", F.lit(0)), F.element_at("__v", -1)
    head = F.transform(F.reverse(F.slice("__v", F.lit(2), n)), lambda x: 2 * first - x)
    tail = F.transform(F.reverse(F.slice("__v", F.size("__v") - n, n)), lambda x: 2 * last - x)
    none = F.array().cast("array<double>")
    is_first, is_last = F.col("__block") == 0, F.col("__block") == F.col("__blocks") - 1
    rows = rows.withColumn("__x", F.concat(F.when(is_first, head).otherwise(none), "__v", F.when(is_last, tail).otherwise(none)))
    rows = rows.withColumn("__from", F.when(is_first, n).otherwise(0)).withColumn("__nth", F.col("__block")).drop("__v", "__n")
    forth = _pass(rows, keys, sections, size, most, "__forth").persist()
    turned = forth.withColumn("__x", F.reverse("__forth")).withColumn("__nth", F.col("__blocks") - 1 - F.col("__block")).drop("__forth")
    back = _pass(turned, keys, sections, size, most, "__back")
    y = F.slice(F.reverse("__back"), F.col("__from") + 1, F.size("__s"))
    out = back.select(*keys, F.explode(F.arrays_zip(F.col("__s").alias("s"), y.alias("y"))).alias("p"))
    out = out.select(*keys, F.col("p.s.o").alias(order), F.col("p.s.x").alias(value), F.col("p.y").alias("filtered"))
    return out.unionByName(few).unionByName(nulls)


def ecg_labels(df: DataFrame, keys: list[str], order: str, value: str, fs: float, seconds: int = 60) -> DataFrame:
    """A label per second of every recording, minute by minute: keys, second, qc."""
    size = int(fs) * seconds
    rows = df.select(*keys, order, value).withColumn("__i", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    rows = rows.withColumn("__minute", F.floor(F.col("__i") / size))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + ", second long, qc string"

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__i")
        qc = ecg_qc(part[value].to_numpy(float), fs)
        base = int(part["__minute"].iloc[0]) * seconds
        return pd.DataFrame({**{c: part[c].iloc[0] for c in keys}, "second": np.arange(len(qc)) + base, "qc": qc})

    return rows.groupBy(*keys, "__minute").applyInPandas(run, schema)


def interpolate_windows(df: DataFrame, column: str, most_missing: float = 0.5) -> DataFrame:
    """Arrays with their nulls interpolated from neighbours; null if over ``most_missing`` of one is missing."""

    @F.pandas_udf("array<double>")
    def fill(v: pd.Series) -> pd.Series:
        def one(a):
            if a is None:
                return None
            x = np.array(a, float)
            good = ~np.isnan(x)
            if not len(x) or good.mean() < 1 - most_missing or not good.any():
                return None
            return np.interp(np.arange(len(x)), np.flatnonzero(good), x[good])

        return v.map(one)

    return df.withColumn(column, fill(column))
