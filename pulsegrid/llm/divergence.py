"""Source divergence audit: how far each source's use of words lies from the others' in its language, in whole numbers.

Heavy-light split. Terms that stand in many groups make dense numpy tiles of terms by groups. The others are summed as if
no pair of groups shared any, from counts of counts, and each pair of a term's postings is corrected. All sums are of
integers, so the parts add up exactly whatever the split.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialize, maybe_broadcast, release, slices

#: Shares are counted in billionths.
SCALE = 1_000_000_000
#: A language keeps terms of so many documents.
LEAST_DOCS = 10
#: Terms of more groups of their language than this are heavy.
LIGHT = 8
#: Sides of a tile: heavy terms, and groups of each of its two blocks.
TILE, BLOCK = 512, 64
#: Counts that one slice of counts of counts has of a group.
SLICE = 4096
#: Counts that a task holds before it hands them on.
ENTRIES = 200_000

#: bytes.translate table: A-Z to a-z, other ASCII but a-z to a space, everything else as it is.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"
_SUMS = "lang string, g int, h int, value long"


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it); a row with a null term for each group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string()) for c in ("lang", "source", "term")] + [(c, pa.int64()) for c in ("n", "docs")])
        occurrences: dict = defaultdict(Counter)
        documents: dict = defaultdict(Counter)
        groups: Counter = Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in occurrences.items():
                has = documents[lang, source]
                columns = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)]
                columns.append(pa.array(list(terms), pa.binary()).cast(pa.string()))
                columns += [pa.array(list(terms.values()), pa.int64()), pa.array([has[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
            occurrences.clear()
            documents.clear()

        held = 0
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                    groups[lang, source] += 1
                    terms = text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()
                    if terms:
                        mine = occurrences[lang, source]
                        held -= len(mine)
                        mine.update(terms)
                        held += len(mine)
                        documents[lang, source].update(set(terms))
                if held > ENTRIES:
                    yield from counted()
                    held = 0
        yield from counted()
        if groups:
            names = [pa.array([k[i] for k in groups], pa.string()) for i in range(2)]
            numbers = [pa.array([0] * len(groups), pa.int64()), pa.array(list(groups.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays([*names, pa.nulls(len(groups), pa.string()), *numbers], schema=schema)
        release()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    found = docs.select(text("lang"), text("source"), text("text")).mapInArrow(work, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / total) by long division in thousands: exact for totals up to 9e15."""
    rest = count + 2
    out = F.lit(1).cast("long")
    for power in (1_000_000_000, 1_000_000, 1_000, 1):
        out = out + F.lit(power) * F.call_function("div", rest, total)
        rest = (rest % total) * 1000
    return out


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def share_of(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` of arrays."""
    rest, out = count + 2, 1
    for power in (1_000_000_000, 1_000_000, 1_000, 1):
        whole, rest = np.divmod(rest, total)
        out = out + power * whole
        rest = rest * 1000
    return out


def apart_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pairs(lang: str, a: np.ndarray, b: np.ndarray, sums: np.ndarray) -> pa.Table:
    g, h = np.broadcast_to(a[:, None], sums.shape), np.broadcast_to(b, sums.shape)
    once = g < h  # in a tile on the diagonal both blocks are the same
    g, h, sums = g[once], h[once], sums[once]
    return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "g": pa.array(g, pa.int32()), "h": pa.array(h, pa.int32()), "value": pa.array(sums, pa.int64())})


def _sides(key: tuple, markers: pa.Table, block: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The numbers and places (in ``markers``) of the groups of a tile's two blocks."""
    at = markers.column("at").to_numpy()
    sides = [np.flatnonzero(at // block == b.as_py()) for b in key[2:4]]
    return [(at[rows], rows) for rows in sides]


def dense_tile(key: tuple, table: pa.Table, block: int) -> pa.Table:
    """What a tile's terms add to ``base_tile`` for each pair of groups of its two blocks.

    Absent counts are zeros of the matrix; terms absent from both blocks have no row here and add nothing.
    """
    mark = table.column("term").is_null()
    markers, cells = table.filter(mark), table.filter(pc.invert(mark))
    total = markers.column("total").to_numpy()
    place = {g: i for i, g in enumerate(markers.column("at").to_pylist())}
    term = cells.column("term").combine_chunks().dictionary_encode()
    count = np.zeros((len(term.dictionary), len(total)), np.int64)
    columns = [place[g] for g in cells.column("at").to_pylist()]
    count[term.indices.to_numpy(), columns] = cells.column("n").to_numpy()
    p = share_of(count, total)
    (a, left), (b, right) = _sides(key, markers, block)
    sums = np.empty((len(a), len(b)), np.int64)
    for i, column in enumerate(left):
        sums[i] = apart_of(p[:, column, None], p[:, right]).sum(axis=0)
    none = share_of(np.zeros(len(total), np.int64), total)
    sums -= len(count) * apart_of(none[left][:, None], none[right])
    return _pairs(key[0].as_py(), a, b, sums)


def base_tile(key: tuple, table: pa.Table, block: int) -> pa.Table:
    """All kept terms' sums for each pair of groups as if heavy terms stood in neither and light ones in one at most.

    Slice 0 has the terms of neither, with negative multiplicity where terms in both count twice.
    """
    mark = table.column("n").is_null()
    markers, cells = table.filter(mark), table.filter(pc.invert(mark))
    total, own, kept = (markers.column(c).to_numpy() for c in ("total", "own", "kept"))
    (a, left), (b, right) = _sides(key, markers, block)
    if not total.any():  # no term is kept
        return _pairs(key[0].as_py(), a, b, np.zeros((len(a), len(b)), np.int64))
    none = share_of(np.zeros(len(total), np.int64), total)
    sums = np.zeros((len(a), len(b)), np.int64)
    if key[1].as_py() == 0:
        neither = kept[left][:, None] - own[left][:, None] - own[right]
        sums += neither * apart_of(none[left][:, None], none[right])
    at, n, times = (cells.column(c).to_numpy() for c in ("at", "n", "times"))
    order = np.argsort(at, kind="stable")
    at, n, times = at[order], n[order], times[order]
    for groups, rows, others, flip in ((a, left, right, False), (b, right, left, True)):
        begin, end = np.searchsorted(at, groups, "left"), np.searchsorted(at, groups, "right")
        for i, row in enumerate(rows):
            mine = share_of(n[begin[i] : end[i]], total[row])
            part = (apart_of(mine[:, None], none[others]) * times[begin[i] : end[i], None]).sum(axis=0)
            if flip:
                sums[:, i] += part
            else:
                sums[i] += part
    return _pairs(key[0].as_py(), a, b, sums)


def _dealt(rows: DataFrame, blocks: str, block: int) -> DataFrame:
    """Each row once for each block that its group's block forms a pair with: the columns low and high."""
    own = F.floor(F.col("at") / block).cast("int")
    rows = rows.withColumn("own_block", own).withColumn("other", F.explode(F.expr(f"sequence(0, {blocks} - 1)")))
    low, high = F.least("own_block", "other").alias("low"), F.greatest("own_block", "other").alias("high")
    return rows.select("*", low, high).drop("own_block", "other")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = 10, light: int = LIGHT, block: int = BLOCK, tile: int = TILE, slice_size: int = SLICE) -> DataFrame:
    """lang, source, part, item, value, rank: each source against the others of its language, and its terms.

    Columns text, lang and source of ``docs`` are read, null as empty. Terms are runs of letters and non-ASCII characters,
    A-Z lower-cased. A language keeps those of at least ``least_docs`` of its documents, V in all. A group is a language
    and source that occurs; its share of a term is p = 1 + floor(1e9 * (n + 2) / (N + 2 * V)), N its occurrences of kept
    terms; likewise a language's. Two shares lie floor((p - q) ** 2 / (p + q)) apart. Part ``pair`` has the sum of that
    over all kept terms for each other source, part ``term`` the ``top`` terms that the group uses more than its language
    does. Ranks are by value descending, then item. Shares are exact up to 9e15 occurrences.

    Empty texts and groups without kept terms count with n = 0; where a language keeps no term, pairs have 0. Repeated
    rows count each; ids aren't read. Very long texts are taken whole. Other columns are ignored; an empty table gives no
    rows. ``light``, ``block``, ``tile`` and ``slice_size`` split the work and don't change results.
    """
    counts = materialize(count_terms(docs), "divergence-counts")
    term = Window.partitionBy("lang", "term")
    kept = counts.where(F.col("term").isNotNull()).select(
        "*",
        F.sum("docs").over(term).alias("in_docs"),
        F.sum("n").over(term).alias("in_lang"),
        F.count("*").over(term).alias("groups"),
        F.row_number().over(term.orderBy("source")).alias("nth"),
    )
    kept = kept.where(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "in_lang", "groups", (F.col("nth") == 1).alias("first"))
    kept = materialize(kept, "divergence-kept")

    few, first = F.col("groups") <= light, F.col("first")
    sizes = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n"),
        F.count_if(few).alias("own"),
        F.count_if(first).alias("terms"),
        F.count_if(first & few).alias("light_terms"),
        F.countDistinct(F.when(few, F.col("n"))).alias("sorts"),
    )
    every = counts.where(F.col("term").isNull()).select("lang", "source").join(sizes, ["lang", "source"], "left").na.fill(0)
    lang = Window.partitionBy("lang")
    v = F.sum("terms").over(lang)
    groups = every.select(
        "lang",
        "source",
        (F.row_number().over(lang.orderBy("source")) - 1).alias("at"),
        "own",
        (F.col("n") + 2 * v).alias("total"),
        (F.sum("n").over(lang) + 2 * v).alias("lang_total"),
        v.alias("kept"),
        F.ceil((v - F.sum("light_terms").over(lang)) / tile).cast("int").alias("tiles"),
        F.ceil(F.count("*").over(lang) / block).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.max("sorts").over(lang) / slice_size), F.lit(1)).cast("int").alias("slices"),
    )
    groups = materialize(groups, "divergence-groups")
    small = maybe_broadcast(groups, groups.count(), 256)
    posted = kept.join(small, ["lang", "source"])

    marks = lambda n: groups.withColumn("tile", F.explode(F.expr(f"sequence(0, {n} - 1)")))
    key = ["lang", "tile", "low", "high"]
    cells = posted.where(~few).withColumn("tile", F.expr("cast(pmod(xxhash64(term), tiles) as int)"))
    cells = cells.select("lang", "tile", "at", "term", "n", "total", "blocks")
    heavy = cells.unionByName(marks("tiles").where("tiles > 0").select("lang", "tile", "at", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "blocks"))
    heavy = _dealt(heavy, "blocks", block).groupBy(*key).applyInArrow(lambda k, t: dense_tile(k, t, block), _SUMS)

    nothing = F.lit(None).cast("long")
    bins = posted.where(few).groupBy("lang", "at", "n", "total", "own", "kept", "blocks", "slices").agg(F.count("*").alias("times"))
    bins = bins.withColumn("tile", F.expr("cast(pmod(n, slices) as int)")).drop("slices")
    bins = bins.unionByName(marks("slices").select("lang", "at", "total", "own", "kept", "blocks", "tile", nothing.alias("n"), nothing.alias("times")))
    base = _dealt(bins, "blocks", block).groupBy(*key).applyInArrow(lambda k, t: base_tile(k, t, block), _SUMS)

    shares = posted.where(few & (F.col("groups") > 1)).select(
        "lang", "term", F.struct("at", share(F.col("n"), F.col("total")).alias("p"), share(F.lit(0).cast("long"), F.col("total")).alias("none")).alias("x")
    )
    postings = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # at most ``light`` of them
    both = postings.select("lang", "xs", F.explode("xs").alias("a")).select("lang", "a", F.explode("xs").alias("b")).where("a.at < b.at")
    more = apart(F.col("a.p"), F.col("b.p")) - apart(F.col("a.p"), F.col("b.none")) - apart(F.col("a.none"), F.col("b.p")) + apart(F.col("a.none"), F.col("b.none"))
    mended = both.select("lang", F.col("a.at").alias("g"), F.col("b.at").alias("h"), more.alias("value"))

    sums = heavy.unionByName(base).unionByName(mended).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    sums = materialize(sums, "divergence-sums")
    ways = sums.unionByName(sums.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    name = lambda c, out: small.select("lang", F.col("at").alias(c), F.col("source").alias(out))
    pairs = ways.join(name("g", "source"), ["lang", "g"]).join(name("h", "item"), ["lang", "h"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p, q = share(F.col("n"), F.col("total")), share(F.col("in_lang"), F.col("lang_total"))
    terms = posted.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", apart(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top))
