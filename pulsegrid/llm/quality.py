"""Quality classification by a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize, maybe_broadcast, slices, words_of

#: The machine is fitted on about so many labelled documents at most, chosen by a hash of their ids.
MAX_TRAIN_DOCS = 10_000
#: If these have more features than this in all, fewer documents are taken, by another hash.
MAX_TRAIN_FEATURES = 10_000_000
WORD_BITS = 16
RANK = 8
#: Structure statistics, each by its bin; then the bias of a bin.
BINS = 16
STATS = (
    "log_chars", "log_words", "mean_word", "symbol_share", "upper_share", "digit_share", "space_share", "line_words",
    "repeated_lines", "repeated_words", "marked_words", "other_share",
)
WORDS = 1 << WORD_BITS
SIZE = WORDS + len(STATS) * BINS
_MARKS = re.compile(rb"[!-/:-@\[-`{-~]{2,}")
_KINDS = np.zeros(256, np.int8)
for _c in range(256):
    _ch = chr(_c)
    _KINDS[_c] = 5 if _c >= 128 else 0 if _ch.islower() else 1 if _ch.isupper() else 2 if _ch.isdigit() else 3 if _ch.isspace() else 4


def _bin(share: float) -> int:
    """Shares on a scale that is fine near 0."""
    return min(BINS - 1, int(BINS * min(1.0, max(0.0, share)) ** 0.5))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text. Nothing else about the document is an input."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = words_of(text)
    marks = _MARKS.findall(raw)
    n = max(1, len(raw))
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=6) / n
    lines = [x for x in raw.split(b"\n") if x]
    tokens = raw.split()
    stats = (
        min(BINS - 1, int(np.log2(n))), min(BINS - 1, int(np.log2(len(words) + 1))), min(BINS - 1, int(n / max(1, len(words)))),
        _bin(kinds[4]), _bin(kinds[1]), _bin(kinds[2]), _bin(kinds[3]), min(BINS - 1, int(np.log2(1 + len(tokens) / max(1, len(lines))) * 2)),
        _bin(1 - len(set(lines)) / max(1, len(lines))), _bin(1 - len(set(words)) / max(1, len(words))), _bin(len(marks) / max(1, len(tokens))), _bin(kinds[5]),
    )
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words + marks), np.uint64, len(words) + len(marks)) >> np.uint64(64 - WORD_BITS)
    index, count = np.unique(hashed.astype(np.int64), return_counts=True)
    value = 1 + np.log(count)
    value /= max(1e-9, float(np.sqrt((value**2).sum())))
    fixed = WORDS + np.arange(len(STATS)) * BINS + np.array(stats)
    return np.concatenate([index, fixed]), np.concatenate([value, np.full(len(STATS), 0.5)])


class Machine:
    """score = bias + sum of w x + half of (squared sums of v x less sums of squares), through a logistic."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores of documents whose features lie together from ``starts``, and their sums of v x."""
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, starts)
        pair = 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), starts))
        return self.bias + np.add.reduceat(self.w[index] * value, starts) + pair, sums

    def predict(self, texts: list[str | None]) -> np.ndarray:
        rows = [features(t) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in rows])[:-1]])
        raw, _ = self.raw(np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]), starts)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss over mini-batches of a bounded sample."""
    random = np.random.default_rng(seed)
    positive = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    machine = Machine(float(np.log(positive / (1 - positive))), np.zeros(SIZE), random.normal(0, 0.02, (SIZE, RANK)))
    gw, gv, gb = np.full(SIZE, 1e-6), np.full((SIZE, RANK), 1e-6), 1e-6
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for k in range(0, len(order), batch):
            at = order[k : k + batch]
            index, value = (np.concatenate([rows[i][j] for i in at]) for j in (0, 1))
            sizes = np.array([len(rows[i][0]) for i in at])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            raw, sums = machine.raw(index, value, starts)
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[at]
            e = np.repeat(error, sizes) * value
            dv = e[:, None] * (np.repeat(sums, sizes, axis=0) - machine.v[index] * value[:, None])
            order_i = np.argsort(index, kind="stable")
            first = np.flatnonzero(np.diff(index[order_i], prepend=-1))
            u = index[order_i][first]
            dw = np.add.reduceat(e[order_i], first) + decay * machine.w[u]
            dv = np.add.reduceat(dv[order_i], first) + decay * machine.v[u]
            gw[u] += dw**2
            gv[u] += dv**2
            gb += error.sum() ** 2
            machine.w[u] -= rate * dw / np.sqrt(gw[u])
            machine.v[u] -= rate * 0.3 * dv / np.sqrt(gv[u])
            machine.bias -= rate * error.sum() / np.sqrt(gb)
    return machine


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = MAX_TRAIN_DOCS
) -> Machine:
    """Fits the machine to labelled documents (label 1 or 0), about ``max_docs`` at most.

    Null labels, and labels without a document, don't count; of several labels of one document the greatest does.
    Without any the machine answers its prior, one half.
    """
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).where("__id is not null and __label is not null")
    marked = marked.groupBy("__id").agg(F.max("__label").alias("__label"))
    total = marked.count()
    if total > max_docs:
        marked = marked.where(F.pmod(F.xxhash64("__id", F.lit("train")), F.lit(1 << 30)) < int(max_docs / total * (1 << 30)))
    marked = materialize(marked, "quality-labels")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(maybe_broadcast(marked, marked.count(), 24), "__id").select("text", "__id", "__label")

    def extract(batches):
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                found = [features(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array([i.astype(np.int32) for i, _ in found]), pa.array([x.astype(np.float32) for _, x in found])],
                    ["id", "label", "index", "value"],
                )

    found = materialize(rows.mapInArrow(extract, f"id {dict(rows.dtypes)['__id']}, label int, index array<int>, value array<float>"), "quality-features")
    size = found.agg(F.sum(F.size("index"))).first()[0] or 0
    if size > MAX_TRAIN_FEATURES:
        found = found.where(F.pmod(F.xxhash64("id", F.lit("features")), F.lit(1 << 30)) < int(MAX_TRAIN_FEATURES / size * (1 << 30)))
    # A bounded sample: at most about max_docs rows, and MAX_TRAIN_FEATURES features, come to the driver.
    got = found.toPandas().sort_values("id")
    sample = [(np.asarray(i, np.int64), np.asarray(x, float)) for i, x in zip(got["index"], got["value"], strict=True)]
    return train(sample, (got.label.to_numpy() > 0).astype(float))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) for every row, whole texts; null texts are empty.

    Ids may be null or repeated, and every row has its score, the same for the same text. An empty table gives no rows.
    Other columns, labels among them, are never read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # a fixed number of weights

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 512 << 10):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.predict(part.column(1).to_pylist()))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")
