"""The source divergence audit against brute force in whole numbers."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.llm import divergence


def terms_of(text):
    import re

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_audit(rows, least_docs, top=10):
    n, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source, words = lang or "", source or "", terms_of(text)
        groups.add((lang, source))
        n.update((lang, source, w) for w in words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (other, w), c in docs.items() if other == lang and c >= least_docs]
        sources = sorted((s for other, s in groups if other == lang), key=lambda s: s.encode())
        size = {s: sum(n[lang, s, w] for w in kept) for s in sources}
        both = sum(size.values())
        p = {(s, w): 1 + 10**9 * (n[lang, s, w] + 2) // (size[s] + 2 * len(kept)) for s in sources for w in kept}
        q = {w: 1 + 10**9 * (sum(n[lang, s, w] for s in sources) + 2) // (both + 2 * len(kept)) for w in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s, w], p[o, w]) for w in kept), o) for o in sources if o != s]
            words = [(f(p[s, w], q[w]), w) for w in kept if n[lang, s, w] and p[s, w] > q[w]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", words, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked)]
    return sorted(out)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefg" for b in ("", "x", "é", "日", "Q")]
    rows = []
    for _ in range(n):
        source = rng.choice(sources)
        own = words[: 8 + 3 * (sources.index(source) % 9)]
        rows.append((rng.choice(["en", "en", "de", None]), source, " ".join(rng.choices(own, k=rng.randint(0, 12))) + rng.choice([".", " 12", "\t_X_"])))
    return rows


@pytest.mark.parametrize("light,block,tile,slice_size", [(8, 64, 2048, 4096), (2, 3, 4, 2), (0, 64, 5, 1), (99, 4, 7, 3)])
def test_audit_equals_brute_force_however_it_is_split(spark, light, block, tile, slice_size):
    sources = [f"s{i}" for i in range(11)] + [None, "", "é"]
    rows = corpus(1, 400, sources) + [("xx", "one", "rare words only"), ("xx", "two", None), ("en", "bare", ""), ("yy", "alone", "a " * 30), ("en", "s1", "ax " * 5000)]
    docs = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, n int, term string")
    got = divergence.audit(docs, 5, light=light, block=block, tile=tile, slice_size=slice_size).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, 5)


def test_audit_of_an_empty_table_and_of_repeats(spark):
    docs = spark.createDataFrame([("en", "a", "b c"), ("en", "z", "b")] * 6 + [(None, None, None)] * 2, "lang string, source string, text string")
    assert divergence.audit(docs.where("false")).count() == 0
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute_audit([tuple(r) for r in docs.collect()], 10)


def test_counts_handed_on_early_add_up(spark, monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 3)
    rows = corpus(2, 60, ["a", "b"])
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    work = divergence.count_terms(docs).where("term is not null").collect()
    want = Counter((a or "", b or "", w) for a, b, t in rows for w in terms_of(t))
    assert {(r.lang, r.source, r.term): r.n for r in work} == dict(want)


@given(st.integers(0, 10**13), st.integers(0, 10**15))
def test_shares_are_exact(count, more):
    total = count + 2 + more
    assert int(divergence.share_of(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 2) // total


def test_shares_are_exact_in_columns(spark):
    rng = random.Random(5)
    rows = [(c := rng.randrange(10 ** rng.randint(1, 13)), c + 2 + rng.randrange(10 ** rng.randint(1, 15))) for _ in range(300)]
    out = spark.createDataFrame(rows, "c long, t long").select("c", "t", divergence.share(F.col("c"), F.col("t")).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.c + 2) // r.t for r in out)
