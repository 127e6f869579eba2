"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words; built-in functions only.

The bits of a slot's number in reverse (van der Corput's sequence) fall into one of the intervals that the sources' targets
cut from the unit line, so every stretch of slots has nearly the sources' shares. A source's documents, shuffled by a hash
and laid end to end as often as its target needs, are cut into blocks of equally many words; its slots take them in turn.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize, maybe_broadcast

#: Weights of the sources in their order, in turn.
WEIGHTS = (5, 2, 1)
#: No source, and so no document, is taken more often.
MOST_TIMES = 3
#: Words of a slot.
BLOCK_WORDS = 256
#: Rows of a stretch of one source whose positions are summed together, and slots that are ranked together, as powers of 2.
STRETCH_BITS = 14
#: Intervals are looked up by so many leading bits of a point.
CELL_BITS = 12
_KEY_BITS = 60


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words) and key: 60 bits of a hash of id and text, the order of a shuffled source."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), text))
    return docs.select(
        doc_id.alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, _KEY_BITS // 4), 16, 10).cast("long").alias("key"),
    )


def _running(rows: DataFrame, order: list, sums: dict[str, str], label: str) -> DataFrame:
    """``rows`` with, for each new column of ``sums``, the sum of an expression over all rows before in ``order``.

    Ranges of the order are summed apart and shifted by the ranges before, of which there are few.
    """
    ranged = materialize(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), label)
    totals = ranged.groupBy("__range").agg(*[F.sum(F.expr(e)).alias(f"__all_{c}") for c, e in sums.items()])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("__range", *[F.coalesce(F.sum(f"__all_{c}").over(before), F.lit(0)).alias(f"__all_{c}") for c in sums])
    own = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({c: F.coalesce(F.sum(F.expr(e)).over(own), F.lit(0)) for c, e in sums.items()})
    # One row for each range, as many as the shuffle has partitions.
    out = out.join(F.broadcast(shifts), "__range")
    return out.withColumns({c: F.col(c) + F.col(f"__all_{c}") for c in sums}).drop("__range", *[f"__all_{c}" for c in sums])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Sources (source, source_size) with nth (in code-point order, null last, from 0), weight, target and take.

    The targets share the sum of all sizes by weight. A target stops at ``most_times`` its source's size; the excess is
    shared by weight among the others until none is above. ``take`` is the target in whole words. Each round is one
    aggregation over the sources that ends when no further source is stopped.
    """
    order = [F.col("source").isNull(), F.col("source")]
    rows = _running(sizes, order, {"nth": "1L"}, "mix-sources")
    turn = F.array(*[F.lit(w).cast("long") for w in weights])
    rows = materialize(rows.withColumn("weight", F.get(turn, (F.col("nth") % len(weights)).cast("int"))), "mix-weights")
    whole = lambda c: c.cast("decimal(19,0)")
    # A source is stopped where weight * rest / left > most_times * size; decimals keep the products exact.
    rest, left, stopped = 0, 1, -1
    total = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    rest, left = total["size"] or 0, total["weight"] or 1
    while True:
        above = whole(F.col("weight")) * whole(F.lit(rest)) > whole(F.lit(most_times) * F.col("source_size")) * whole(F.lit(left))
        got = rows.where(above).agg(F.count("*").alias("n"), F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
        if got["n"] == stopped:
            break
        stopped = got["n"]
        rest, left = (total["size"] or 0) - most_times * (got["size"] or 0), (total["weight"] or 1) - (got["weight"] or 0)
    cap = F.lit(most_times).cast("long") * F.col("source_size")
    part = F.col("weight") * F.lit(rest).cast("long")
    return rows.select(
        "source",
        "source_size",
        "nth",
        "weight",
        F.when(above, cap.cast("double")).otherwise(part.cast("double") / F.lit(left).cast("double")).alias("target"),
        F.when(above, cap).otherwise(F.call_function("div", part, F.lit(left).cast("long"))).alias("take"),
    )


def _slots(sources: DataFrame, n: int, stretch_bits: int) -> DataFrame:
    """nth, rank, slot: for each of ``n`` slots the source that it takes from and its number among that source's slots."""
    spark = sources.sparkSession
    k = max(1, math.ceil(math.log2(n))) if n > 1 else 1
    cut = max(0, k - CELL_BITS)
    grid = lambda c: F.call_function("div", c.cast("decimal(20,0)") * F.lit(1 << k).cast("decimal(18,0)"), F.col("all").cast("decimal(20,0)"))
    all_words = sources.agg(F.sum("take")).first()[0] or 1
    lines = sources.withColumn("all", F.lit(all_words)).select("nth", grid(F.col("before")).alias("low"), grid(F.col("before") + F.col("take")).alias("high"))
    lines = lines.where("low < high").select("*", F.explode(F.expr(f"sequence(shiftright(low, {cut}), shiftright(high - 1, {cut}))")).alias("cell"))
    lines = materialize(lines, "mix-cells")
    point = F.conv(F.reverse(F.lpad(F.bin("id"), k, "0")), 2, 10).cast("long")
    points = spark.range(n).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.shiftright("point", cut))
    found = points.join(maybe_broadcast(lines, lines.count(), 48), "cell").where("low <= point and point < high")
    found = materialize(found.select("nth", "slot", F.shiftright("slot", stretch_bits).alias("stretch")), "mix-slots")
    sizes = found.groupBy("nth", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("nth").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(sizes.select("nth", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")), "mix-stretches")
    own = F.row_number().over(Window.partitionBy("nth", "stretch").orderBy("slot")) - 1
    ranked = found.withColumn("own", own).join(maybe_broadcast(sizes, sizes.count(), 48), ["nth", "stretch"])
    return ranked.select("nth", (F.col("first") + F.col("own")).alias("rank"), "slot")


def schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    stretch_bits: int = STRETCH_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(pieces, places): what the mix takes, and where each row of ``docs`` lies in its source.

    ``pieces``: nth, at, copy (together the row), epoch, start and length (words of the document), slot, and late: a block
    whose rank the source has no slot for stands where its turn in the whole schedule is. ``places`` has one row per row
    of ``docs``: nth, at (words of the source before it), copy, doc_id, size, source_size, target, take.

    Words are what ASCII white space separates. Each source's taken words are its target in whole words, and no document
    is taken more than ``most_times``. A null text has no word. Null sources are one source. Rows that repeat are
    counted and dealt like any other, so a hot id or copy is one row until it is spread again. Equal input gives equal
    output, however it is split. Other columns are ignored; an empty table gives no rows.
    """
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_times)
    sources = _running(sources, [F.col("nth")], {"before": "take"}, "mix-targets")
    sources = materialize(sources, "mix-shares")
    small = maybe_broadcast(sources, sources.count(), 256)

    # Equal rows are one until their places are known.
    alike = rows.groupBy("source", "key", "doc_id", "size").agg(F.count("*").alias("copies"))
    known = alike.join(small, alike["source"].eqNullSafe(sources["source"])).select("nth", "key", "doc_id", "size", "copies", "source_size", "target", "take")
    n = rows.count()
    bits = max(0, math.ceil(math.log2(max(1, n))) - stretch_bits)
    known = materialize(known.withColumn("stretch", F.shiftright("key", _KEY_BITS - bits)), "mix-known")
    words = F.col("size") * F.col("copies")
    sums = known.groupBy("nth", "stretch").agg(F.sum(words).alias("words"))
    earlier = Window.partitionBy("nth").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(sums.select("nth", "stretch", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("first")), "mix-firsts")
    own = Window.partitionBy("nth", "stretch").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = known.withColumn("own", F.coalesce(F.sum(words).over(own), F.lit(0))).join(maybe_broadcast(sums, sums.count(), 48), ["nth", "stretch"])
    laid = laid.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    places = laid.select("nth", (F.col("first") + F.col("own") + F.col("copy") * F.col("size")).alias("at"), "copy", "doc_id", "size", "source_size", "target", "take")
    places = materialize(places, "mix-places")

    used = places.where("size > 0 and at < take").withColumn("epoch", F.explode(F.expr("sequence(0L, (take - 1 - at) div source_size)")))
    used = used.withColumn("begin", F.expr("epoch * source_size + at")).withColumn("end", F.expr("least(begin + size, take)"))
    cut = used.withColumn("rank", F.explode(F.expr(f"sequence(begin div {block_words}, (end - 1) div {block_words})")))
    cut = cut.select(
        "nth",
        "at",
        "copy",
        "epoch",
        "rank",
        "take",
        F.expr(f"greatest(rank * {block_words} - begin, 0L)").alias("start"),
        F.expr(f"least(end, (rank + 1) * {block_words}) - greatest(begin, rank * {block_words})").alias("length"),
    )
    blocks = F.expr(f"(take + {block_words - 1}) div {block_words}")
    slots = sources.agg(F.sum(blocks)).first()[0] or 0
    dealt = cut.join(_slots(sources, slots, stretch_bits), ["nth", "rank"], "left")
    wide = lambda c: c.cast("decimal(18,0)")
    turn = F.call_function("div", wide(2 * F.col("rank") + 1) * wide(F.lit(slots)), wide(2 * blocks))
    pieces = dealt.select("nth", "at", "copy", "epoch", "start", "length", F.coalesce("slot", turn).alias("slot"), F.col("slot").isNull().alias("late"))
    return pieces, places


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot, late: ``schedule`` by row of ``docs``.

    ``taken`` are the words that the mix takes of it, repeats counted, ``first_slot`` the earliest slot that has some (null:
    none), ``late`` how many of them lie in blocks without a slot of their own.
    """
    pieces, places = schedule(docs, **options)
    found = pieces.groupBy("nth", "at", "copy").agg(
        F.sum("length").alias("taken"), F.min("slot").alias("first_slot"), F.sum(F.when(F.col("late"), F.col("length")).otherwise(0)).alias("late")
    )
    # Rows without words share their place with the next row, which is theirs alone.
    out = places.join(found.withColumn("has", F.lit(True)), (places["nth"] == found["nth"]) & (places["at"] == found["at"]) & (places["copy"] == found["copy"]) & (places["size"] > 0), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", "size", "source_size", "target", zero("taken"), "first_slot", zero("late"))
