"""Periodic runs of words, found through Lyndon arrays over ordered alphabets, and texts with the repeats taken out.

After Ellert and Fischer, "Linear time runs over general ordered alphabets" (ICALP 2021): every run has a root that is
the longest Lyndon word at its place under one of the two orders of the alphabet, so the next smaller suffix of each
place under both orders names all candidates, and the extensions that were matched to find it are used again. Words are
only compared; there is no suffix array, suffix tree or fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.common import id_and_text, release, slices

#: A run has so many words at least, and so many times its period.
MIN_LENGTH, MIN_EXPONENT = 6, 4
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def lyndon_array(s: Sequence[int]) -> tuple[list[int], list[int]]:
    """For each i the next smaller suffix's start (len(s): none) and how many symbols both suffixes share.

    From right to left along the chain of next smaller suffixes. An extension is matched only where the two that are
    known already agree, goes on from there, and jumps as soon as it has matched a whole distance whose onward match is
    known: as the final one of that place, or as one of those it passed (``passed``). Comparisons a symbol: about 5 on
    texts of repeats whatever their length; on Fibonacci and Thue-Morse words, the worst known, they grow by one with each
    fourfold length (9 at 7,500 symbols, 11 at 120,000).
    """
    m = len(s)
    after, shared = [m] * m, [0] * m
    passed: dict[tuple[int, int], int] = {}
    first = 0  # symbols that suffixes i and i + 1 share
    for i in range(m - 2, -1, -1):
        j = i + 1
        n = first = first + 1 if s[i] == s[j] else 0
        while j + n < m and s[i + n] < s[j + n]:
            if n >= j - i:
                passed[i, j] = n
            nearer, j, known = j, after[j], shared[j]
            if j == m:
                n = 0
                break
            if known < n:  # the suffix at j is smaller where the one at nearer was left
                n = known
                break
            if known == n:
                d = j - i
                while j + n < m and s[i + n] == s[j + n]:
                    n += 1
                    if n == d:
                        onward = shared[j] if after[j] == j + d else passed.get((j, j + d))
                        if onward is not None:
                            n = d + onward
                            break
        after[i], shared[i] = j, n
    return after, shared


def runs(s: Sequence[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal repetition of at least both bounds; ``min_exponent`` is 2 or more."""
    top, m, found = max(s, default=0), len(s), set()
    for t in (s, [top - x for x in s]):
        after, shared = lyndon_array(t)
        for i, j in enumerate(after):
            d = j - i
            # The first root starts less than a period after its run.
            if shared[i] <= (min_exponent - 2) * d or j == m:
                continue
            if i >= d and after[i - d] == i and shared[i - d] == shared[i] + d:
                continue  # a later root of the same run
            start = i
            while start and s[start - 1] == s[start - 1 + d]:
                start -= 1
            length = j + shared[i] - start
            if length >= max(min_length, min_exponent * d):
                found.add((start, length, d))
    return sorted(found)


def stretches(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """(begin, end) rows of the parts of texts that can hold runs of exponent 4 and length 6 or more.

    In such a run, whatever its period, each three words in a row stand three times or more. So words that no such
    triple covers are in no run, and no run reaches over them: the parts between them have the same runs as the whole.
    ``ids`` are the words of texts one after another, ``owner`` the text of each.
    """
    n = len(ids)
    if n < MIN_LENGTH:
        return np.empty((0, 2), np.int64)
    k = int(ids.max()) + 1
    pair = ids[:-1] * k + ids[1:]
    if k >= 1 << 21:  # triples wouldn't fit; pairs are numbered anew
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    triple = pair[:-1] * k + ids[2:]
    begin = np.flatnonzero(owner[:-2] == owner[2:])
    triple = triple[begin]
    order = np.argsort(triple, kind="stable")  # equal ones in order of place, so those of a text stand together
    value, text = triple[order], owner[begin[order]]
    if not len(order):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])])
    size = np.diff(np.r_[new, len(order)])
    often = begin[order[np.repeat(size >= 3, size)]]
    covered = np.zeros(n + 1, bool)
    for offset in range(3):
        covered[often + offset] = True
    # A part ends where a word isn't covered and where a text ends.
    inside, last = covered[:n], np.r_[owner[1:] != owner[:-1], True]
    begins = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | last[:-1]])
    ends = np.flatnonzero(inside & (~covered[1:] | last)) + 1
    parts = np.c_[begins, ends]
    return parts[parts[:, 1] - parts[:, 0] >= MIN_LENGTH]


def runs_of_texts(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; bounds under MIN_LENGTH or MIN_EXPONENT are for whole texts, as ``stretches`` needs those."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(sizes) - sizes
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for t in texts for w in t), np.int64, int(sizes.sum()))
    if min_length >= MIN_LENGTH and min_exponent >= MIN_EXPONENT:
        owner = np.repeat(np.arange(len(texts)), sizes)
        parts = stretches(ids, owner)
        owners = owner[parts[:, 0]].tolist()
    else:
        parts, owners = np.c_[at, at + sizes], range(len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (begin, end), text in zip(parts.tolist(), owners):
        shift = begin - int(at[text])
        out[text] += [(start + shift, length, period) for start, length, period in runs(ids[begin:end].tolist(), min_length, min_exponent)]
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if found:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed, one row per row of ``docs``.

    Words are what ASCII white space separates. A run is a maximal stretch in which words a smallest period apart are
    equal, of at least ``min_length`` words and ``min_exponent`` times its period. ``collapsed`` has the words that no
    run holds after its first period, joined by one space.

    A null text counts as empty; texts without words have no run and an empty ``collapsed``. Texts of any length are
    taken whole; one must fit in a task. Rows that repeat, tie or have a null id give a row each. Other columns are
    ignored, an empty table gives none. There is no shuffle: each row is worked out where it is read.
    """
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
            ("collapsed", pa.string()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in part.column(1).to_pylist()]
                found = runs_of_texts(texts, min_length, min_exponent)
                rows = [[{"start": a, "length": n, "period": p} for a, n, p in f] for f in found]
                kept = pa.array([collapsed(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(rows, arrow.field("runs").type), kept], schema=arrow)
        release()

    return id_and_text(docs, id_col, text_col).mapInArrow(work, SCHEMA)
