"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize, maybe_broadcast, release, slices

#: Every step of the softmax chooses among so many: the class of a token (the last one: the tail), then its member.
WIDTH, DIGIT = 32, 5
#: The most frequent tokens, by class and member; all others are the tail.
SYMBOLS = (WIDTH - 1) * WIDTH
#: The tail is a tree of classes by the tokens' hashes, deep enough that a leaf has about so many tokens; at most DEEPEST.
LEAF, DEEPEST = 8192, 4
#: The weight table has as many rows as training has distinct tokens, rounded up to a power of two within these.
LEAST_BITS, MOST_BITS = 12, 16
#: Tokens whose counts tasks hold; the counts of others reach their documents by a join.
HEAD = 1 << 17
#: Averagings in a pass over the training documents, and passes.
ROUNDS, PASSES = 2, 1
#: Text bytes of one gradient update.
UPDATE_BYTES = 64 << 10
RATE, FIRST_SQUARE = 0.15, 0.1
#: Small partitions are joined until a task learns from about so many tokens: means of few updates are poor.
LEARN_TOKENS = 4_000_000
FAN_IN = 32
BLOCK_ROWS = 512
END = xxhash.xxh3_64_intdigest(b"\n", 1)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in turn, each text's end among them, and the number of tokens of each."""
    words = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    out = np.empty(int(sizes.sum()), np.uint64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends] = END
    out[inner] = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws), np.uint64, len(out) - len(words))
    return out, sizes


class Counts:
    """Counts of the most frequent training tokens, by hash; place of each in the softmax, and what the leaves hold.

    ``leaves``: tail tokens of each leaf, training and distinct ones together.
    """

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int, depth: int = 1, leaves: np.ndarray | None = None):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        self.symbols = np.minimum(order, SYMBOLS)  # hashes come by falling count
        self.total, self.distinct, self.depth = total, distinct, depth
        self.bits = min(MOST_BITS, max(LEAST_BITS, int(distinct).bit_length()))
        leaves = np.zeros(WIDTH**depth) if leaves is None else leaves
        self.leaves = np.log10(leaves + 1)
        # Without a context every choice goes by the counts: logarithms for each node, fixed.
        members = np.zeros(SYMBOLS)
        members[: len(counts[:SYMBOLS])] = counts[:SYMBOLS]
        members = members.reshape(-1, WIDTH)
        self.bias = [np.append(members.sum(axis=1), leaves.sum())[None, :], members]
        self.bias += [leaves.reshape(WIDTH**k, WIDTH, -1).sum(axis=2) for k in range(depth)]
        self.bias = [np.log(b + 1).astype(np.float32) for b in self.bias]
        # One slot per value of the top 20 bits points at the first hash there.
        self.first = np.searchsorted(self.hashes, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        top = (self.hashes >> np.uint64(44)).astype(np.int64)
        self.steps = int(np.bincount(top).max()) if len(top) else 0
        self.hashes = np.append(self.hashes, np.zeros(self.steps + 1, np.uint64))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash here, or -1."""
        at = self.first[(h >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(h), -1, np.int64)
        for step in range(self.steps):
            hit = self.hashes[at + step] == h
            out[hit] = at[hit] + step
        out[out >= len(self.counts)] = -1
        return out

    def symbol(self, place: np.ndarray) -> np.ndarray:
        return np.where(place >= 0, self.symbols[place] if len(self.symbols) else SYMBOLS, SYMBOLS)

    def leaf(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - DIGIT * self.depth)).astype(np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def contexts(h: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Three features of each token's context: the last token, the one before it (skipping the last), both.

    Before a text stand ends.
    """
    one, two = np.empty_like(h), np.empty_like(h)
    one[1:], two[2:] = h[:-1], h[:-2]
    starts = np.cumsum(sizes) - sizes
    one[starts] = two[starts] = END
    two[starts[sizes > 1] + 1] = END
    salt = [np.uint64(int(_STEP) * k & (1 << 64) - 1) for k in (1, 3, 5)]
    return [_mix(one + salt[0]), _mix(two + salt[1]), _mix(_mix(two + salt[2]) + one)]


def steps(counts: Counts, h: np.ndarray, sizes: np.ndarray, symbol: np.ndarray):
    """The choices that make up each token: (tokens, logits by counts, rows of the weight table, what they choose).

    Rows are found by hashing a node of the tree and a feature; in the tail, the skipping one isn't used.
    """
    context = contexts(h, sizes)
    head, tail = np.flatnonzero(symbol < SYMBOLS), np.flatnonzero(symbol >= SYMBOLS)
    picks = [(slice(None), np.zeros(len(h), np.int64), np.minimum(symbol // WIDTH, WIDTH - 1)), (head, symbol[head] // WIDTH, symbol[head] % WIDTH)]
    for k in range(counts.depth):
        down = counts.leaf(h[tail]) >> (DIGIT * (counts.depth - k - 1))
        picks.append((tail, down >> DIGIT, down & (WIDTH - 1)))
    for k, (at, node, pick) in enumerate(picks):
        if len(pick):
            salt = _mix((node.astype(np.uint64) + np.uint64((k + 1) << 40)) * _STEP)
            features = context if k < 2 else [context[0], context[2]]
            rows = [(_mix(c[at] ^ salt) >> np.uint64(64 - counts.bits)).astype(np.int64) for c in features]
            yield at, np.take(counts.bias[k], node, axis=0), rows, pick


def softmax(w: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits less their greatest, and the sums of their exponentials; reuses ``bias``."""
    x = bias
    for r in rows:
        x += np.take(w, r, axis=0)
    x -= x.max(axis=1, keepdims=True)
    return x, np.exp(x)


def log_prob(w: np.ndarray, counts: Counts, h: np.ndarray, sizes: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Natural log-probability of each token's way through the classes, down to its member or leaf."""
    out = np.zeros(len(h))
    for at, bias, rows, pick in steps(counts, h, sizes, symbol):
        x, e = softmax(w, bias, rows)
        out[at] += x[np.arange(len(pick)), pick] - np.log(e.sum(axis=1))
    return out


def sums_by_row(rows: np.ndarray, values: np.ndarray, most: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, how often each stands there, and the sum of its values; ``values`` repeat along ``rows``."""
    n = len(values)
    key = np.sort((rows << 24) | np.arange(len(rows)))
    order, flat = (key & ((1 << 24) - 1)) % n, key >> 24
    first = np.flatnonzero(np.diff(flat, prepend=-1))
    times = np.diff(np.append(first, len(flat)))
    # Rows by falling number: the k-th values of all that have one are added at once, what is left of long ones after.
    by = np.argsort(-np.minimum(times, most + 1), kind="stable")
    first, times = first[by], times[by]
    out = np.take(values, order[first], axis=0)
    for k in range(1, most):
        m = int(np.searchsorted(-times, -k, side="left"))
        if not m:
            break
        out[:m] += np.take(values, order[first[:m] + k], axis=0)
    long = np.flatnonzero(times > most)
    if len(long):
        rest = np.concatenate([order[f + most : f + t] for f, t in zip(first[long].tolist(), times[long].tolist(), strict=True)])
        out[long] += np.add.reduceat(np.take(values, rest, axis=0), np.append(0, np.cumsum(times[long] - most)[:-1]), axis=0)
    return flat[first], times, out


class Learner:
    """AdaGrad, one rate for each row, on one task's documents; remembers how often each row was used."""

    def __init__(self, w: np.ndarray):
        self.w, self.used = w.copy(), np.zeros(len(w), np.int64)
        self.square = np.full(len(w), FIRST_SQUARE, np.float32)

    def update(self, counts: Counts, h: np.ndarray, sizes: np.ndarray) -> None:
        symbol = counts.symbol(counts.find(h))
        for _, bias, rows, pick in steps(counts, h, sizes, symbol):
            _, e = softmax(self.w, bias, rows)
            e /= -e.sum(axis=1, keepdims=True)
            e[np.arange(len(pick)), pick] += 1
            u, times, total = sums_by_row(np.concatenate(rows), e)
            self.square[u] += np.einsum("ij,ij->i", total, total) / WIDTH
            total *= (np.float32(RATE) / np.sqrt(self.square[u]))[:, None]
            self.w[u] += total
            self.used[u] += times


def _learn(source: DataFrame, counts, weights: np.ndarray, share: int, which: int, tasks: int) -> np.ndarray:
    """One averaging: every task updates the same weights on its own share of rows; a row of the table becomes the mean
    of the tasks' versions, weighted by how often each used it."""
    spark = source.sparkSession
    shared = spark.sparkContext.broadcast(weights)
    rows = source.where(F.pmod(F.xxhash64("row", F.lit(f"round {which}")), F.lit(ROUNDS)) == share).select("text").coalesce(tasks)

    def run(batches):
        learner, seen = Learner(shared.value), 0
        for batch in batches:
            for part in slices(batch, 0, UPDATE_BYTES):
                h, sizes = tokens(part.column(0).to_pylist())
                learner.update(counts.value, h, sizes)
                seen += 1
        at = np.flatnonzero(learner.used) if seen else []
        if len(at):
            cuts = np.searchsorted(at, np.arange(0, len(learner.w) + BLOCK_ROWS, BLOCK_ROWS))
            own = [at[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(x[0]) // BLOCK_ROWS for x in own], pa.int32()), pa.array([task] * len(own), pa.int64()),
                    pa.array([x.astype("<i4").tobytes() for x in own]), pa.array([learner.used[x].astype("<i4").tobytes() for x in own]),
                    pa.array([learner.w[x].astype("<f2").tobytes() for x in own]),
                ],
                ["block", "task", "rows", "used", "w"],
            )
        del learner
        release()

    def mean(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        used, total = np.zeros(BLOCK_ROWS), np.zeros((BLOCK_ROWS, WIDTH))
        for at, n, w in zip(*(rows.column(c) for c in ("rows", "used", "w")), strict=True):
            at, n = np.frombuffer(at.as_py(), "<i4") - block * BLOCK_ROWS, np.frombuffer(n.as_py(), "<i4")
            used[at] += n
            total[at] += np.frombuffer(w.as_py(), "<f2").reshape(-1, WIDTH).astype(float) * n[:, None]
        at = np.flatnonzero(used)
        w = (total[at] / used[at, None]).astype("<f2").tobytes()
        row = [block, rows.column("task")[0].as_py(), (at + block * BLOCK_ROWS).astype("<i4").tobytes(), np.minimum(used[at], 2**31 - 1).astype("<i4").tobytes(), w]
        return pa.table([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["block", "task", "rows", "used", "w"])

    schema = "block int, task long, rows binary, used binary, w binary"
    sums = materialize(rows.mapInArrow(run, schema), "lm-weights")
    # Means of FAN_IN tasks at a time, until one is left.
    tasks = (sums.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:
        sums = sums.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("block", "task").applyInArrow(mean, schema)
        tasks = -(-tasks // FAN_IN)
    out = weights.copy()
    for r in sums.select("rows", "w").collect():  # as large as the weights
        out[np.frombuffer(r["rows"], "<i4")] = np.frombuffer(r["w"], "<f2").reshape(-1, WIDTH)
    return out


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores all texts by a model learnt from those for which ``training``, a condition on ``docs``, holds.

    One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score. Tokens are runs of other than
    ASCII white space, A-Z lower-cased, then one end per text. base_score is the log10 probability by add-one smoothed
    counts of the training tokens; all of them count. score is the model's: a token given the two before it is a way
    through classes, each choice a softmax over weights hashed by features of the context. The most frequent tokens
    have a class and a member; the others a leaf of a tree by their hash, and there their smoothed count among the
    leaf's. Tree and weight table grow with the number of distinct tokens.

    A null text is empty: its end is scored. Ids may be null; rows with the same text have equal scores. Of tokens with
    equal counts the smaller hash comes first. Repeated rows train as often as they stand there. Without training rows
    every count is 0 and the model is uniform; an empty table gives no rows. Other columns are ignored. Tokens are told
    apart by 64-bit hashes. How the input is split changes which documents a task learns from together, and with that
    scores a little; it doesn't where one task learns from all.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"), F.coalesce(training, F.lit(False)).alias("training"))

    def count(batches):
        held = []
        for batch in batches:
            for part in slices(batch, 0, 4 << 20):
                h, n = np.unique(tokens(part.column(0).to_pylist())[0], return_counts=True)
                held.append((h, n))
                if len(held) == 4:
                    yield merged(held)
                    held = []
        if held:
            yield merged(held)

    def merged(held):
        h, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["token", "n"])

    learn = source.where("training")
    table = learn.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    table = materialize(table, "lm-counts")
    total, distinct = table.select(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Tokens by the logarithm of their count, some hundred bins: the head is all from the bin down to which HEAD suffices.
    level = F.floor(F.log2("n") * 64)
    least, room = None, HEAD
    for r in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    head = table.where(level >= least if least is not None else F.lit(False)).toPandas()
    head = head.sort_values(["n", "token"], ascending=[False, True])
    hashes, n = head.token.to_numpy(np.int64).view(np.uint64), head.n.to_numpy(np.int64)
    spark = docs.sparkSession
    depth = 1
    while depth < DEEPEST and distinct > LEAF * WIDTH**depth:
        depth += 1
    # Sums by leaf of what isn't a symbol: as many as the tree has leaves.
    leaf = F.shiftrightunsigned("token", 64 - DIGIT * depth)
    sums = table.groupBy(leaf.alias("leaf")).agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).toPandas()
    leaves = np.zeros(WIDTH**depth)
    leaves[sums.leaf.to_numpy(np.int64)] += (sums.n + sums.distinct).to_numpy(float)
    np.subtract.at(leaves, (hashes[:SYMBOLS] >> np.uint64(64 - DIGIT * depth)).astype(np.int64), n[:SYMBOLS] + 1.0)
    counts = Counts(hashes, n, int(total), int(distinct), depth, leaves)
    shared = spark.sparkContext.broadcast(counts)
    weights = np.zeros((1 << counts.bits, WIDTH), np.float32)
    for turn in range(ROUNDS * PASSES if total else 0):
        weights = _learn(learn, shared, weights, turn % ROUNDS, turn // ROUNDS, -(-int(total) // LEARN_TOKENS))
    model = spark.sparkContext.broadcast(weights)
    # The tokens outside the head, by document; those that training knows bring their counts.
    out = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("head", pa.float64()), ("model", pa.float64())]
        + [("tail", pa.list_(pa.struct([("token", pa.int64()), ("times", pa.int32())])))]
    )

    def run(batches):
        counts, w = shared.value, model.value
        for batch in batches:
            for part in slices(batch, 2, 256 << 10):
                h, sizes = tokens(part.column(2).to_pylist())
                place = counts.find(h)
                symbol = counts.symbol(place)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                in_head = place >= 0
                seen = np.where(in_head, np.log10(np.append(counts.counts, 0) + 1.0)[place], 0.0)
                total = lambda x, owner=owner, k=len(sizes): np.bincount(owner, x, k)
                rare = np.where(symbol == SYMBOLS, seen - counts.leaves[counts.leaf(h)], 0.0)
                found = total(log_prob(w, counts, h, sizes, symbol) / np.log(10) + rare)
                tail, tail_owner = h[~in_head], owner[~in_head]
                order = np.lexsort((tail, tail_owner))
                tail, tail_owner = tail[order], tail_owner[order]
                new = np.ones(len(tail), bool)
                new[1:] = (tail[1:] != tail[:-1]) | (tail_owner[1:] != tail_owner[:-1])
                at = np.flatnonzero(new)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(tail_owner[at], np.arange(len(sizes) + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(tail[at].view(np.int64)), pa.array(np.diff(np.append(at, len(tail))).astype(np.int32))], ["token", "times"]),
                )
                ints = [pa.array(x.astype(np.int64)) for x in (sizes, total(in_head))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *ints, pa.array(total(seen)), pa.array(found), lists], schema=out)
        release()

    kinds = "doc_id long, row long, n_tokens long, n_known long, head double, model double, tail array<struct<token:bigint,times:int>>"
    part = materialize(source.select("doc_id", "row", "text").mapInArrow(run, kinds), "lm-scored")
    tail = part.select("row", F.explode("tail").alias("x")).select("row", "x.token", "x.times")
    rest = table.join(maybe_broadcast(spark.createDataFrame(head[["token"]]) if len(head) else table.limit(0).select("token"), len(head), 16), "token", "left_anti")
    tail = tail.join(rest, "token")
    tail = tail.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("sum_log"), F.sum("times").alias("sum_known"))
    # Copies of a text have brought the same tokens each.
    tail = tail.join(part.groupBy("row").agg(F.count("*").alias("copies")), "row")
    tail = tail.select("row", (F.col("sum_log") / F.col("copies")).alias("tail_log"), (F.col("sum_known") / F.col("copies")).cast("long").alias("tail_known"))
    base = float(np.log10(total + distinct + 1))
    found = part.drop("tail").join(tail, "row", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return found.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("head") + tail_log - F.col("n_tokens") * base).alias("base_score"),
        (F.col("model") + tail_log).alias("score"),
    )
