"""Near-duplicate classes by ProbMinHash, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import id_and_text, materialize, maybe_broadcast, release, slices, words_of
from pulsegrid.llm.graph import components

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 24, 5
SIZE = BANDS * ROWS

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """(shingle, document number) of every five-word run, and a digest of each text's words (None: no words).

    A text of one to four words has one shingle, all of them.
    """
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in words for w in ws), np.uint64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    n = len(flat) - SHINGLE + 1
    out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        h = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            h = mix(h * _STEP + flat[i : i + n])
        whole = doc[:n] == doc[SHINGLE - 1 :]
        out, owner = h[whole], doc[:n][whole]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        own = np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i]), 1) for i in short], np.uint64)
        out, owner = np.append(out, own), np.append(owner, short)
    return out, owner, [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]


def weighted(shingle: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, shingle) in order, with how often each occurs."""
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    first = np.ones(len(shingle), bool)
    first[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return shingle[at], owner[at], np.diff(np.append(at, len(shingle)))


def signatures(shingle: np.ndarray, owner: np.ndarray, weight: np.ndarray, n_docs: int, size: int = SIZE) -> np.ndarray:
    """ProbMinHash signatures: each element's Poisson process, of its weight's rate, sends arrivals to random components.

    A component keeps the element that came first. An element stops once its next arrival is later than every
    component's first one; two signatures agree on a component with the probability Jaccard similarity of the weights.
    """
    first = np.full(n_docs * size, np.inf)
    sig = np.zeros(n_docs * size, np.uint64)
    at, when, turn = np.arange(len(shingle)), np.zeros(len(shingle)), 0
    while len(at):
        turn += 1
        r = mix(shingle[at] + np.uint64(int(_STEP) * turn & (1 << 64) - 1))
        uniform = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        when = when - np.log(uniform) / weight[at]
        live = when < first.reshape(n_docs, size).max(axis=1)[owner[at]]
        at, when, r = at[live], when[live], r[live]
        slot = owner[at] * size + (mix(r ^ _M1) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, slot, when)
        won = first[slot] == when
        sig[slot[won]] = shingle[at[won]]
    return sig.reshape(n_docs, size)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per document and band."""
    rows = sig.shape[1] // bands
    parts = sig.reshape(len(sig), bands, rows)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), bands)).copy()
    for i in range(rows):
        h = mix(h * _STEP + parts[:, :, i])
    return h.view(np.int64)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sketch(batches):
    for batch in batches:
        for part in slices(batch, 1, 1 << 20):
            shingle, owner, node = shingles(part.column(1).to_pylist())
            keys = band_keys(signatures(*weighted(shingle, owner), len(node)))
            bands = [None if n is None else k for n, k in zip(node, keys, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(node, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=_SKETCH)
    release()


def _contents(batches):
    """node and its shingles, sorted, as bytes."""
    for batch in batches:
        for part in slices(batch, 1, 1 << 20):
            shingle, owner, node = shingles(part.column(1).to_pylist())
            order = np.lexsort((shingle, owner))
            shingle = shingle[order].astype("<u8")
            ends = np.cumsum(np.bincount(owner, minlength=len(node)))
            rows = [shingle[e - n : e].tobytes() for e, n in zip(ends, np.bincount(owner, minlength=len(node)), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(node, pa.binary()), pa.array(rows, pa.binary())], ["doc_id", "node", "content"])
    release()


def elements(content: bytes) -> np.ndarray:
    """A sorted multiset of shingles as a set: the k-th occurrence of a shingle is an element of its own."""
    v = np.frombuffer(content, "<u8")
    return mix(v + _STEP * (np.arange(len(v)) - np.searchsorted(v, v)).astype(np.uint64))


def similar(a: bytes, b: bytes) -> bool:
    """Whether two sorted multisets of shingles have a Jaccard similarity of LEAST_SIMILARITY or more."""
    n, m = len(a) // 8, len(b) // 8
    if not min(n, m) or min(n, m) < LEAST_SIMILARITY * max(n, m):
        return False
    c = len(np.intersect1d(elements(a), elements(b), assume_unique=True))
    return c >= LEAST_SIMILARITY * (n + m - c)


def _compare(batches):
    for batch in batches:
        a, b, x, y = (batch.column(i) for i in range(4))
        found = [similar(p.as_py(), q.as_py()) for p, q in zip(x, y, strict=True)]
        yield pa.RecordBatch.from_arrays([a, b, pa.array(found, pa.bool_())], ["a", "b", "similar"])
    release()


def _elements(batches):
    for batch in batches:
        for part in slices(batch, 1):
            rows = [elements(c.as_py()).view(np.int64) for c in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(r) for r in rows], pa.int32()), pa.array(rows, pa.list_(pa.int64()))], ["node", "size", "elements"])
    release()


def star_pairs(buckets: DataFrame) -> DataFrame:
    """Each bucket's pivot with all its other nodes: (a, b). The pivot is the node that meets most others in all."""
    degree = buckets.groupBy("node").agg(F.sum("n").alias("degree"))
    rows = buckets.join(degree, "node")
    pivot = rows.groupBy("bucket").agg(F.max_by("node", F.struct("degree", "node")).alias("pivot"))
    return buckets.join(pivot, "bucket").where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()


def open_nodes(compared: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) of those that share a pivot with a node of another class: some of them may still be similar."""
    rows = compared.select(F.col("a").alias("pivot"), F.col("b").alias("node"))
    rows = rows.unionByName(compared.select(F.col("a").alias("pivot"), F.col("a").alias("node")).distinct())
    rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = rows.groupBy("pivot").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("pivot")
    return rows.join(several, "pivot", "left_semi").select("node", "label").distinct()


def prefix_pairs(nodes: DataFrame, contents: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different classes that can be similar, by prefix and place; no similar pair is left out.

    Two sets of similarity 0.8, of n and m >= n elements, share 4 / 9 of n + m at least, which is 8 n / 9 and 0.8 m at least.
    So, rarest first, the first element they share is among the first n / 9 and one of the smaller set, among the first
    m / 5 and one of the larger one, and in both as many as they must share still follow, itself included. What a template
    gives to many texts is frequent, so it comes late and joins little.
    """
    sets = contents.join(nodes, "node").select("node", "content", "label")
    sets = materialize(sets.select("node", "content").mapInArrow(_elements, "node binary, size int, elements array<long>").join(nodes, "node"), "near-elements")
    flat = sets.select("node", "label", "size", F.explode("elements").alias("element"))
    often = flat.groupBy("element").agg(F.count("*").alias("often")).where("often > 1")
    # Elements of one node alone come first in its prefix; they join nothing and need only be counted.
    flat = flat.join(often, "element")
    shared = Window.partitionBy("node")
    place = F.row_number().over(shared.orderBy("often", "element")) + F.col("size") - F.count("*").over(shared)
    rows = flat.select("element", "node", "label", "size", place.alias("place"))
    # ``left`` elements follow, this one included; whole numbers, as the bounds are exact.
    rows = rows.select("element", "node", "label", F.col("size").cast("long").alias("size"), (F.col("size") - F.col("place") + 1).cast("long").alias("left"))
    rows = materialize(rows.where("5 * left >= 4 * size"), "near-prefixes")
    x, y, c = rows.where("9 * left >= 8 * size").alias("x"), rows.alias("y"), F.col
    smaller = (c("x.size") < c("y.size")) | ((c("x.size") == c("y.size")) & (c("x.node") < c("y.node")))
    enough = 9 * F.least("x.left", "y.left") >= 4 * (c("x.size") + c("y.size"))
    pairs = x.join(y, (c("x.element") == c("y.element")) & smaller & (c("x.label") != c("y.label")) & (5 * c("x.size") >= 4 * c("y.size")) & enough)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents linked by near-duplicate texts: doc_id, class_id (smallest id), class_size; a row per row.

    Two texts are linked if the multisets of their five-word shingles have a Jaccard similarity of 0.8 or more. Texts of
    equal words are one node. Nodes that share a band of the signature are a bucket. A bucket's nodes are compared with
    its pivot; those of them that this left in different classes are joined by a prefix filter, and what it can't rule
    out is compared, too. So every similar pair that shares a bucket ends in one class. The signature estimates
    probability Jaccard, which is that of the multisets where shingles don't repeat; then a similarity of 0.8 shares a
    bucket with probability 0.9999. Tests measure the share for texts with repeated words.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A text of one to four words has them as
    its one shingle; null, empty and wordless texts are alone. Repeated rows are each in the class. A null id never
    names a class unless all its ids are null. An empty table gives no rows. Other columns are ignored.
    """
    source = id_and_text(docs, id_col, text_col)
    sketch = materialize(source.mapInArrow(_sketch, "doc_id long, node binary, bands array<long>"), "near-sketch")
    nodes = sketch.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id")).alias("at"), F.first("bands").alias("bands"))
    nodes = materialize(nodes.select("node", F.col("at.doc_id").alias("rep"), "bands"), "near-nodes")
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(rows.join(shared, "bucket"), "near-buckets")
    # Shingles of the nodes in buckets, from one row each.
    wanted = materialize(nodes.join(buckets.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("wanted"), "rep"), "near-wanted")
    contents = source.mapInArrow(_contents, "doc_id long, node binary, content binary")
    contents = contents.join(
        maybe_broadcast(wanted, wanted.count(), 48), (F.col("node") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    )
    contents = materialize(contents.select("node", "content").dropDuplicates(["node"]), "near-contents")

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        both = pairs.join(contents.select(F.col("node").alias("b"), F.col("content").alias("y")), "b")
        both = both.join(contents.select(F.col("node").alias("a"), F.col("content").alias("x")), "a").select("a", "b", "x", "y")
        return materialize(both.mapInArrow(_compare, "a binary, b binary, similar boolean"), label)

    compared = verified(star_pairs(buckets), "near-stars")
    edges = compared.where("similar").select("a", "b")
    labels = materialize(components(edges), "near-labels")
    nodes = materialize(open_nodes(compared, labels), "near-open")
    if not nodes.isEmpty():
        more = verified(prefix_pairs(nodes, contents), "near-more").where("similar").select("a", "b")
        if not more.isEmpty():
            labels = materialize(components(edges.unionByName(more)), "near-labels")
    out = sketch.select("doc_id", "node")
    out = out.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = out.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    classes = materialize(classes.where("class_size > 1"), "near-classes")
    out = out.join(maybe_broadcast(classes, classes.count(), 48), "label", "left")
    # A class of one is its own; so is a text without words.
    return out.select(
        "doc_id",
        F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )
