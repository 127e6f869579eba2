"""Removal of byte strings that occur more than once, by interval expansion on Burrows-Wheeler transforms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize, maybe_broadcast, slices

LENGTH = 200
#: An anchor is the least of the hashed KMER-byte strings in a window; equal windows have the same one at the same place.
KMER = 64
STEP = 8
BLOCK_BYTES = 512 << 10
#: Distinct surroundings of one anchor that outgrow this are compared window by window, dealt over all tasks.
HOT_BYTES = 4 << 20
CHUNK = 1 << 20
_POSITION = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0][0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _TABLES[0] = tuple(np.cumprod(np.full(n, b, np.uint64)) for b in (_BASE, inverse))
    up, down = _TABLES[0]
    return up[:n], down[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])
    return _mix((sums[width:] - sums[:-width]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(raw: list[bytes], length: int = LENGTH, kmer: int = KMER):
    """(text number, anchor hash, first and last window start) of each run of windows with one anchor, in texts' order."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    out = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    if len(data) < length:
        return out
    ends = np.cumsum([len(r) for r in raw])
    found = []
    for begin in range(0, len(data) - length + 1, CHUNK):
        part = data[begin : begin + CHUNK + length - 1]
        h = rolling(part, kmer)
        place = np.arange(len(h), dtype=np.uint64)
        # The leftmost of equal least hashes: the position is in the low bits.
        at = (sliding_min((h & ~_POSITION) | place, length - kmer + 1) & _POSITION).astype(np.int64)
        start = begin + np.arange(len(at))
        doc = np.searchsorted(ends, start, side="right")
        good = start + length <= ends[doc]
        start, at, doc = start[good], at[good], doc[good]
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        found.append((doc[first], h[at[first]], start[first], start[last]))
    if not found:
        return out
    doc, h, first, last = (np.concatenate(c) for c in zip(*found, strict=True))
    origin = ends[doc] - np.array([len(r) for r in raw])[doc]
    return doc, h, first - origin, last - origin


def _encoded(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


_RUNS = "doc_id long, a long, b long, n_bytes long, anchors array<long>, contexts array<long>, checks array<long>, firsts array<int>, lasts array<int>"


def _find_anchors(batches):
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "a", "b", "n_bytes")]
        + [(c, pa.list_(pa.int64())) for c in ("anchors", "contexts", "checks")]
        + [(c, pa.list_(pa.int32())) for c in ("firsts", "lasts")]
    )
    for batch in batches:
        for part in slices(batch, 3, CHUNK):
            raw = _encoded(part.column(3).to_pylist())
            doc, h, first, last = anchors(raw)
            # A context is all bytes of the run's windows: equal contexts repeat each other's every window.
            digests = [xxhash.xxh3_128_digest(raw[d][f : e + LENGTH]) for d, f, e in zip(doc.tolist(), first.tolist(), last.tolist(), strict=True)]
            context = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(raw)))]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(c))
                for c in (h.view(np.int64), context[:, 0].copy(), context[:, 1].copy(), first.astype(np.int32), last.astype(np.int32))
            ]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([len(r) for r in raw], pa.int64()), *lists], schema=schema)


def _cut(batches):
    """The bytes of the listed runs."""
    for batch in batches:
        for part in slices(batch, 0, CHUNK):
            raw = _encoded(part.column(0).to_pylist())
            rows = [
                (x["anchor"], x["context"], x["check"], x["n"], r[x["first"] : x["last"] + LENGTH])
                for r, xs in zip(raw, part.column(1).to_pylist(), strict=True)
                for x in xs
            ]
            if rows:
                a, c, d, n, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in (a, c, d, n)), pa.array(b, pa.binary())], ["anchor", "context", "check", "n", "content"]
                )


def suffix_order(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by their first ``depth`` codes or more, and the keys of their first STEP codes."""
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(STEP, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(STEP):
        key = (key << np.uint64(8)) | padded[i : i + n].astype(np.uint64)
    order = np.argsort(key)
    width, rank, sort_key = STEP, None, key
    while True:
        ordered = sort_key[order]
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        if width >= depth or rank[order[-1]] == n - 1:
            return order, key
        follow = np.zeros(n, np.int64)
        follow[: n - width] = rank[width:] + 1
        sort_key = rank * (n + 1) + follow
        order = np.argsort(sort_key)
        width *= 2


def repeated(codes: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which positions begin a string of ``length`` codes that begins elsewhere, too.

    ``length`` is a multiple of STEP. The Burrows-Wheeler transform, with symbols of STEP codes, holds what stands before
    each suffix; its last-to-first step leads from the occurrences of a symbol to neighbouring suffixes that begin with
    it. All intervals are extended backward at once, breadth first: neighbours are parted as soon as a border of the
    level before lies between the occurrences that they come from. So common prefixes of 8, 16, 24 and
    so on are told apart by increasing value, and it stops at ``length``. Code 0 parts strings.
    """
    n = len(codes)
    order, key = suffix_order(codes, length)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    parted_by = np.concatenate([[0], np.cumsum(codes == 0), np.full(STEP, (codes == 0).sum())])
    whole = parted_by[STEP : STEP + n] == parted_by[:n]  # symbols without a separator
    ordered = key[order]
    apart = np.ones(n, bool)
    apart[1:] = (ordered[1:] != ordered[:-1]) | ~whole[order[1:]]  # what holds a separator is like nothing else
    # Last to first: a suffix leads back to the one that has the transform's symbol before it.
    at = np.flatnonzero(order >= STEP)
    at = at[whole[order[at] - STEP]]
    origin = np.full(n, -1)
    origin[place[order[at] - STEP]] = at
    apart[1:] |= (origin[1:] < 0) | (origin[:-1] < 0)
    together = np.flatnonzero(~apart)
    left, right = origin[together - 1], origin[together]
    border = np.empty(n, np.int64)
    shared = STEP
    while shared < length and len(together):
        np.cumsum(apart, out=border)
        parted = border[right] != border[left]
        apart[together[parted]] = True
        left, right, together = left[~parted], right[~parted], together[~parted]
        shared += STEP
    out = np.zeros(n, bool)
    out[order[together]] = True
    out[order[together - 1]] = True
    return out


def repeated_windows(contents: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each of some distinct strings the runs (first, last) of window starts whose window occurs again among them."""
    data = np.frombuffer(b"\x00".join(contents) + b"\x00", np.uint8)
    sizes = np.array([len(c) for c in contents])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    # Codes from 1 for the bytes that occur, so that a separator is like none of them.
    used = np.zeros(256, bool)
    inside = np.ones(len(data), bool)
    inside[starts + sizes] = False
    used[data[inside]] = True
    code = np.cumsum(used).astype(np.uint8)  # at most 243 byte values occur in UTF-8
    codes = np.where(inside, code[data], 0).astype(np.uint8)
    hit = repeated(codes, length)
    out = []
    for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        at = np.flatnonzero(hit[s : s + n - length + 1])
        if not len(at):
            out.append([])
            continue
        cut = np.flatnonzero(np.diff(at) > 1)
        out.append(list(zip(at[np.concatenate([[0], cut + 1])].tolist(), at[np.append(cut, len(at) - 1)].tolist(), strict=True)))
    return out


def _expand(batches):
    """Blocks of whole anchors (rows come sorted by anchor): anchor, context, check, runs of repeated window starts in it."""
    held: list[tuple] = []
    size = 0

    def flush(rows):
        runs = repeated_windows([r[4] for r in rows])
        # A context that stands in several places repeats itself.
        runs = [[(0, len(r[4]) - LENGTH)] if r[3] > 1 else x for r, x in zip(rows, runs, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            + [pa.array([[x[i] for x in xs] for xs in runs], pa.list_(pa.int32())) for i in (0, 1)],
            ["anchor", "context", "check", "firsts", "lasts"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= BLOCK_BYTES and held[-1][0] != row[0]:
                yield flush(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield flush(held)


def _windows(batches):
    """Every window of the contexts by its hash."""
    for batch in batches:
        for part in slices(batch, 4, 64 << 10):
            for anchor, context, mark, _, content in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = np.frombuffer(content, np.uint8)
                h = rolling(data, LENGTH).view(np.int64)
                check = np.fromiter((xxhash.xxh3_64_intdigest(content[i : i + LENGTH]) for i in range(len(h))), np.uint64, len(h)).view(np.int64)
                n = len(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(check), pa.array(np.full(n, anchor)), pa.array(np.full(n, context)), pa.array(np.full(n, mark)), pa.array(np.arange(n, dtype=np.int32))],
                    ["h", "same", "anchor", "context", "check", "at"],
                )


def _finish(batches):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
    )
    for batch in batches:
        for part in slices(batch, 1, CHUNK):
            rows = []
            for doc_id, text, runs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                raw = _encoded([text])[0]
                spans: list[list[int]] = []
                for r in sorted((r["first"], r["last"] + LENGTH) for r in runs or ()):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                kept, at = [], 0
                for start, stop in spans:
                    kept.append(raw[at:start])
                    at = stop
                kept.append(raw[at:])
                rest = b"".join(kept)
                rows.append((doc_id, len(raw), len(raw) - len(rest), len(spans), rest, [{"start": a, "stop": b} for a, b in spans]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts without the bytes of any 200-byte string that starts more than once in the table.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (remaining bytes), spans.

    Every 200-byte window has an anchor, its least hashed substring, which equal windows share at the same place; so
    windows are grouped by anchor and only groups with several places are looked into. The bytes around an anchor's
    places meet in one task as a block of distinct strings, whose repeated windows come from the block's Burrows-Wheeler
    transform. An anchor whose distinct surroundings outgrow HOT_BYTES has its windows counted by hash instead, over all
    tasks. Copies of a text are one unit; each is repeated as a whole.

    A null text is empty; texts under 200 bytes stay whole. Repeated rows repeat each other. An empty table gives no
    rows; ids may be null or repeated. Other columns are ignored. Texts, contexts and windows of hot anchors are told apart
    by 128 bits of hash.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Two independent hashes tell texts apart; a text's unit is a number of the written table.
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), text.alias("text"))
    runs = source.mapInArrow(_find_anchors, _RUNS)
    arrays = ("anchors", "contexts", "checks", "firsts", "lasts")
    units = runs.groupBy("a", "b").agg(F.min(F.struct("doc_id")).alias("at"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"), *[F.first(c).alias(c) for c in arrays])
    units = materialize(units.withColumn("rep", F.col("at.doc_id")).drop("at").withColumn("unit", F.monotonically_increasing_id()), "suffix-units")
    flat = units.select("unit", F.explode(F.arrays_zip(*arrays)).alias("x"))
    names = ("anchor", "context", "check", "first", "last")
    flat = flat.select("unit", *[F.col(f"x.{c}").alias(n) for c, n in zip(arrays, names, strict=True)])
    place = F.struct("context", "check")
    known = flat.groupBy("anchor").agg(F.count("*").alias("n"), (F.min(place) != F.max(place)).alias("several")).where("n > 1")
    known = materialize(known.select("anchor", "several"), "suffix-anchors")
    # Joins with places, texts and spans are never hinted: all grow with the input, and sizes on disk tell Spark enough.
    places = materialize(flat.join(known, "anchor"), "suffix-places")
    # One place of each distinct context of anchors with several: its bytes go to a block.
    same_context = ["anchor", "context", "check"]
    distinct = places.where("several").groupBy(*same_context).agg(F.count("*").alias("n"), F.min(F.struct("unit", "first", "last")).alias("at"))
    wanted = distinct.select(F.col("at.unit").alias("unit"), F.struct(*same_context, "n", F.col("at.first").alias("first"), F.col("at.last").alias("last")).alias("x"))
    wanted = wanted.groupBy("unit").agg(F.collect_list("x").alias("xs")).join(units.select("unit", F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("rep").alias("r")), "unit")
    wanted = materialize(wanted.drop("unit"), "suffix-wanted")
    same = (F.col("a") == F.col("ua")) & (F.col("b") == F.col("ub"))
    contents = source.join(wanted, same & F.col("doc_id").eqNullSafe(F.col("r"))).select("text", "xs")
    contents = contents.mapInArrow(_cut, "anchor long, context long, check long, n long, content binary")
    contents = materialize(contents, "suffix-contents")
    weight = contents.groupBy("anchor").agg(F.sum(F.length("content")).alias("size")).where(F.col("size") > HOT_BYTES)
    hot = materialize(weight.select(F.col("anchor").alias("hot")), "suffix-hot")
    n_hot = hot.count()
    hot = maybe_broadcast(hot, n_hot, 16)
    cool = contents.join(hot, F.col("anchor") == F.col("hot"), "left_anti") if n_hot else contents
    blocks = cool.repartition("anchor").sortWithinPartitions("anchor").dropDuplicates(same_context)
    blocks = blocks.sortWithinPartitions("anchor").select(*same_context, "n", "content")
    found = blocks.mapInArrow(_expand, "anchor long, context long, check long, firsts array<int>, lasts array<int>")
    if n_hot:
        rows = contents.join(hot, F.col("anchor") == F.col("hot"), "left_semi").dropDuplicates(same_context)
        windows = rows.select(*same_context, "n", "content").mapInArrow(_windows, "h long, same long, anchor long, context long, check long, at int")
        often = windows.groupBy("h", "same").agg(F.count("*").alias("times")).where("times > 1").select("h", "same")
        again = windows.join(often, ["h", "same"]).select(*same_context, "at")
        whole = rows.where("n > 1").select(*same_context, F.explode(F.sequence(F.lit(0), F.length("content") - LENGTH)).alias("at"))
        again = again.unionByName(whole).groupBy(*same_context).agg(F.array_sort(F.collect_set("at")).alias("firsts"))
        found = found.unionByName(again.select(*same_context, "firsts", F.col("firsts").alias("lasts")))
    found = materialize(found.where(F.size("firsts") > 0), "suffix-found")
    alone = places.where("not several").select("unit", "first", "last")
    mixed = places.where("several").join(found, same_context)
    mixed = mixed.select("unit", "first", F.explode(F.arrays_zip("firsts", "lasts")).alias("x"))
    mixed = mixed.select("unit", (F.col("first") + F.col("x.firsts")).alias("first"), (F.col("first") + F.col("x.lasts")).alias("last"))
    copies = units.where((F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH))
    copies = copies.select("unit", F.lit(0).alias("first"), (F.col("n_bytes") - LENGTH).cast("int").alias("last"))
    spans = alone.unionByName(mixed).unionByName(copies)
    spans = spans.groupBy("unit").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    spans = materialize(spans.join(units.select("unit", F.col("a").alias("ua"), F.col("b").alias("ub")), "unit").drop("unit"), "suffix-spans")
    out = source.join(spans, same, "left").select("doc_id", "text", "runs")
    return out.mapInArrow(
        _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:bigint,stop:bigint>>"
    )
