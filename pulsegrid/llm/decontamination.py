"""Benchmark decontamination by SimHash of item-sized windows; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize, maybe_broadcast, words_native

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BITS, BLOCKS = 64, 8
#: The index holds every value of a block within so many bits, so two fingerprints within RADIUS meet in some block.
FLIPS = 2
#: Each bit of two windows of similarity 0.8 differs with probability 0.152, 9.7 bits of 64 on average: 24 or more do in
#: about 3 of a million. Windows that share no shingle are within RADIUS in 2 of a hundred; verification tells them apart.
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: Lanes of 16 bits count a bit's votes four to a long.
_LANES = 4
_MOST_VOTES = 1 << 15


def _shingle(words: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(SHINGLE)])


def _shingles(words: Column) -> Column:
    n = F.size(words) - SHINGLE + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: _shingle(words, i))).otherwise(F.array().cast("array<bigint>"))


def numbered(shingles: Column) -> Column:
    """A multiset of shingles as a set: the second and further occurrences of a shingle are elements of their own."""
    before = lambda x, i: F.size(F.filter(F.slice(shingles, 1, i), lambda y: y == x))
    one = lambda x, i: F.when(before(x, i) == 0, x).otherwise(F.xxhash64(x, before(x, i)))
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), shingles).otherwise(F.transform(shingles, one))


def simhash(elements: Column) -> Column:
    """64-bit SimHash of a set of 64-bit hashes (a column, as it is named twice): each votes on each bit. More votes than a
    lane counts give null."""
    long = lambda x: F.lit(x).cast("long")

    def spread(h, k):
        x = F.shiftrightunsigned(h, _LANES * k).bitwiseAND(long(15))
        return x.bitwiseOR(F.shiftleft(x, 15)).bitwiseOR(F.shiftleft(x, 30)).bitwiseOR(F.shiftleft(x, 45)).bitwiseAND(long(0x0001000100010001))

    names = [f"c{k}" for k in range(BITS // _LANES)]
    zero = F.struct(*[long(0).alias(c) for c in names], F.lit(0).alias("n"))
    add = lambda a, h: F.struct(*[(a[c] + spread(h, k)).alias(c) for k, c in enumerate(names)], (a["n"] + 1).alias("n"))

    def finish(a):
        out = long(0)
        for k, c in enumerate(names):
            for i in range(_LANES):
                votes = F.shiftrightunsigned(a[c], 16 * i).bitwiseAND(long(0xFFFF))
                out = out.bitwiseOR(F.when(votes * 2 > a["n"], F.shiftleft(long(1), _LANES * k + i)).otherwise(long(0)))
        return out

    return F.when(F.size(elements) < _MOST_VOTES, F.aggregate(elements, zero, add, finish))


def _block(fingerprint: Column, i: int) -> Column:
    width = BITS // BLOCKS
    return F.shiftrightunsigned(fingerprint, width * i).bitwiseAND(F.lit((1 << width) - 1).cast("long")).cast("int")


def blocks(fingerprint: Column) -> Column:
    """Array of (block number, its bits)."""
    return F.array(*[F.struct(F.lit(i).alias("block"), _block(fingerprint, i).alias("bits")) for i in range(BLOCKS)])


def _near(bits: Column) -> Column:
    """A block's value and all that differ from it in up to FLIPS bits."""
    masks = [m for m in range(1 << (BITS // BLOCKS)) if m.bit_count() <= FLIPS]
    return F.transform(F.array(*map(F.lit, masks)), lambda m: bits.bitwiseXOR(m))


def _first_block(difference: Column) -> Column:
    """The first block in which two fingerprints with this difference meet: what the index finds in several counts there."""
    return F.least(*[F.when(F.bit_count(_block(difference, i)) <= FLIPS, i) for i in range(BLOCKS)])


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, item_id, start_word, n_words, hamming, similarity.

    Windows of as many words as an item has slide over the texts. A window is skipped if fewer of its five-word shingles
    stand in any item of that size than a similarity of LEAST_SIMILARITY takes: no item can match it. All others are
    fingerprinted by SimHash and looked up in a multi-index, whose blocks find every item of the size within RADIUS bits.
    Exact similarity of the shingle multisets (Jaccard, weighted by occurrences) decides. A window counts where some
    shared shingle has the same place in window and item, or at the start of a text that has lost the item's first words.
    The best window of each document and item is returned (the first of equals).

    Items of fewer than five words have no shingle and match nothing, as do null and empty texts, and an empty table of
    either. Items have under 32,768 shingles. Repeated rows count as one; a null id is an id. Items with equal texts are
    reported each. Other columns are ignored whatever their names.
    """
    item_words = items.select(F.col(item_id_col).cast("long").alias("item_id"), words_native(F.col(item_text_col).cast("string")).alias("item_words"))
    item_words = item_words.select("item_id", F.size("item_words").alias("n_words"), _shingles(F.col("item_words")).alias("item_shingles"))
    item_words = item_words.where(F.size("item_shingles") > 0).distinct().withColumn("item_elements", numbered(F.col("item_shingles")))
    item_table = materialize(item_words.withColumn("item_print", simhash(F.col("item_elements"))), "leak-items")
    n_items = item_table.count()
    # The sizes of items that hold a shingle; a shingle may be in many items and texts, but no pairs of them are made.
    grams = item_table.select("n_words", F.explode("item_shingles").alias("gram")).groupBy("gram").agg(F.collect_set("n_words").alias("sizes"))
    grams = materialize(grams, "leak-grams")
    n_grams = grams.agg(F.coalesce(F.sum(F.size("sizes") + F.lit(8)), F.lit(0))).first()[0]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.select("doc_id", F.xxhash64("text").alias("row"), "text")
    w = source.select("doc_id", "row", words_native(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE)
    w = w.withColumn("p", F.explode(F.sequence(F.lit(0), F.size("w") - SHINGLE)))
    places = w.select("doc_id", "row", "p", _shingle(F.col("w"), F.col("p")).alias("gram"))
    marks = places.join(maybe_broadcast(grams, n_grams, 8), "gram").select("doc_id", "row", "p", F.explode("sizes").alias("n_words"))
    marks = marks.groupBy("doc_id", "row", "n_words").agg(F.sort_array(F.collect_set("p")).alias("marks"))
    # Of the marks in a window the first is marks[i], and enough more follow.
    n = F.col("n_words") - (SHINGLE - 1)
    enough = F.ceil(n * F.lit(LEAST_SIMILARITY)).cast("int")
    lowest = lambda m, i: F.greatest(F.lit(0), F.get("marks", i - 1) + 1, F.get("marks", i + enough - 1) - n + 1)
    runs = F.transform("marks", lambda m, i: F.when(i + enough <= F.size("marks"), F.struct(lowest(m, i).alias("low"), m.alias("high"))))
    runs = F.filter(runs, lambda r: r["low"] <= r["high"])
    wanted = marks.select("doc_id", "row", "n_words", F.explode(runs).alias("r"))
    wanted = wanted.select("doc_id", "row", "n_words", F.explode(F.sequence("r.low", "r.high")).alias("start"))
    wanted = materialize(wanted, "leak-windows")
    by_doc = wanted.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_list(F.struct("start", "n_words")).alias("windows"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r"))
    windows = source.join(maybe_broadcast(by_doc, wanted.count(), 40), same).dropDuplicates(["doc_id", "row"])
    windows = windows.select("doc_id", "row", words_native(F.col("text")).alias("w"), "windows")
    # Words, shingles and elements are columns of their own: an expression within a lambda would be run for each element.
    windows = windows.select("doc_id", "row", _shingles(F.col("w")).alias("s"), "windows").select("doc_id", "row", "s", F.explode("windows").alias("x"))
    windows = windows.select("doc_id", "row", "x.start", "x.n_words", F.slice("s", F.col("x.start") + 1, F.col("x.n_words") - (SHINGLE - 1)).alias("shingles"))
    windows = windows.withColumn("elements", numbered(F.col("shingles")))
    windows = materialize(windows.withColumn("print", simhash(F.col("elements"))), "leak-prints")
    index = item_table.select("item_id", "n_words", "item_print", F.explode(blocks(F.col("item_print"))).alias("b"))
    index = index.select("item_id", "n_words", "item_print", F.col("b.block").alias("block"), F.explode(_near(F.col("b.bits"))).alias("bits"))
    look = windows.select("*", F.explode(blocks(F.col("print"))).alias("b")).select(*windows.columns, F.col("b.block").alias("block"), F.col("b.bits").alias("bits"))
    near = look.join(maybe_broadcast(index, n_items * BLOCKS * 37, 64), ["n_words", "block", "bits"])
    difference = F.col("print").bitwiseXOR(F.col("item_print"))
    near = near.withColumn("hamming", F.bit_count(difference)).where((F.col("hamming") <= RADIUS) & (_first_block(difference) == F.col("block")))
    near = near.select(*windows.columns, "item_id", "hamming").join(item_table.select("item_id", "n_words", "item_shingles", "item_elements"), ["item_id", "n_words"])
    near = near.withColumn("common", F.size(F.array_intersect("elements", "item_elements")))
    similarity = F.col("common") / (F.size("shingles") + F.size("item_shingles") - F.col("common"))
    near = near.withColumn("similarity", similarity).where(F.col("similarity") >= LEAST_SIMILARITY)
    in_place = F.exists(F.zip_with("shingles", "item_shingles", lambda a, b: a.eqNullSafe(b) & a.isNotNull()), lambda x: x)
    later = F.exists(F.transform("shingles", lambda a, i: F.array_contains(F.slice("item_shingles", i + 1, F.size("item_shingles")), a)), lambda x: x)
    near = near.where(in_place | ((F.col("start") == 0) & later))
    best = F.max_by(F.struct("start", "n_words", "hamming", "similarity"), F.struct("similarity", -F.col("start")))
    found = near.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select(
        "doc_id", "item_id", F.col("b.start").cast("long").alias("start_word"), F.col("b.n_words").cast("long").alias("n_words"), F.col("b.hamming").cast("int").alias("hamming"), "b.similarity"
    )
