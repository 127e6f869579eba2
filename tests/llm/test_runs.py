"""Periodic runs against brute force, on families that are hard for suffix comparisons, and as a query."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import periodic_runs
from tests.llm.test_llm import ODD, prose, table


def brute_runs(s, least=6, times=4):
    out, n = [], len(s)
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if s[i] != s[i + q]:
                i += 1
                continue
            a = i
            while i < n - q and s[i] == s[i + q]:
                i += 1
            length = i - a + q
            part = s[a : a + length]
            if length >= max(least, times * q) and all(part[p:] != part[: length - p] for p in range(1, q)):
                out.append((a, length, q))
    return sorted(out)


def brute_collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 6), st.integers(0, 30))
@settings(max_examples=400, deadline=None)
def test_runs_equal_brute_force(s, p, a):
    s = s[:a] + [s[a + (i - a) % p] if a + (i - a) % p < len(s) else 0 for i in range(a, len(s))]
    after, shared = periodic_runs.lyndon_array(s)
    for i, j in enumerate(after):
        assert j == next((k for k in range(i + 1, len(s)) if s[k:] < s[i:]), len(s))
        assert j == len(s) or shared[i] == next((k for k in range(len(s) - j) if s[i + k] != s[j + k]), len(s) - j)
    assert periodic_runs.runs(s) == brute_runs(s)
    assert periodic_runs.runs(s, 2, 2) == brute_runs(s, 2, 2)
    words = [b"%d" % x for x in s]
    assert periodic_runs.runs_of_texts([words, [], words[::-1], words]) == [brute_runs(s), [], brute_runs(s[::-1]), brute_runs(s)]
    assert periodic_runs.runs_of_texts([words, words], 2, 2) == [brute_runs(s, 2, 2)] * 2


class Counted(int):
    """A symbol that counts how often it is compared."""

    seen = 0

    def __eq__(self, other):
        Counted.seen += 1
        return int.__eq__(self, other)

    def __lt__(self, other):
        Counted.seen += 1
        return int.__lt__(self, other)

    __hash__ = int.__hash__


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("name", ["one", "two", "rising end", "falling end", "fibonacci", "thue", "random", "blocks", "growing", "nested"])
def test_comparisons_stay_few(name):
    n = 30_000
    s = {
        "one": [0] * n,
        "two": [0, 1] * (n // 2),
        "rising end": [0, 0, 1] * (n // 3) + [0, 0, 2],
        "falling end": [0, 0, 1] * (n // 3) + [0, 0, 0],
        "fibonacci": fibonacci(n),
        "thue": [i.bit_count() % 2 for i in range(n)],
        "random": random.Random(1).choices(range(2), k=n),
        "blocks": ([0] * 300 + [1]) * (n // 301) + [0] * 300 + [2],
        "growing": [x for k in range(200) for x in [0, 0, 1] * k + [2]],
        "nested": (fibonacci(500) * 6 + [2]) * (n // 3001),
    }[name]
    Counted.seen = 0
    periodic_runs.lyndon_array([Counted(x) for x in s])
    assert Counted.seen <= (10 if name in ("fibonacci", "thue", "nested") else 6) * len(s)


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_periodic_runs_query(spark, tmp_path):
    from pulsegrid.llm import queries

    rng = random.Random(3)
    texts = ODD + ["a a a a a a", "a b " * 9 + "c", "x a b c\t\na b c a b c a b c y", "é é é é é é é 日 日", "a a a a a"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(1, 60))) for _ in range(150)] + [prose(i, 40) for i in range(40)]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    hits = 0
    for i, text in enumerate(texts):
        words = changed(i, (text or "").encode().split())
        found = brute_runs(words)
        hits += bool(found) and zlib.crc32(str(i).encode()) % 10 == 0
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        milli = best[1] and 1000 * best[1] // best[2]
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *best, milli), i
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = brute_collapsed([w.decode() for w in words], found)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert hits >= 5


def test_periodic_runs_null_repeated_and_empty(spark):
    rows = [(None, "a " * 8), (None, "a " * 8), (7, "a " * 8), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic_runs.find_runs(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        ("7", 0, [], ""),
        ("7", 8, [(0, 8, 1)], "a"),
        ("None", 8, [(0, 8, 1)], "a"),
        ("None", 8, [(0, 8, 1)], "a"),
    ]
    assert periodic_runs.find_runs(docs.where("false")).count() == 0
