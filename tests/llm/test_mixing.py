"""Source mixing: targets, what is taken, the schedule's evenness, and the odd cases."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Rounds in fractions: stop those above, share the rest by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        open_ = sum(weight[s] for s in names if s not in stopped)
        target = {s: Fraction(most * sizes[s]) if s in stopped else Fraction(weight[s] * rest, open_) for s in names}
        more = {s for s in names if target[s] > most * sizes[s]}
        if not more:
            return target
        stopped |= more


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice([f"s{i}", f"é{i}", f"日{i}"]): rng.choice([0, 1, 7, 10 ** rng.randint(1, 13)]) for i in range(rng.choice([1, 5, 40]))} | {None: 5}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want)
    for s, t in want.items():
        assert got[s].take == int(t) and got[s].target == pytest.approx(float(t), rel=1e-14)


def texts(seed, n, sources):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.choice([0, 1, 3, 20, 90])), rng.choice(sources)) for i in range(n)]


ODD = [(None, "a b c", "s1"), (None, "a b c", "s1"), (5, "same words", "s2"), (5, "same words", "s2"), (6, None, "s0"), (7, "", None), (8, "x " * 7000, "s3"), (9, "only one", "tiny"), (10, " \n", "blank")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, nth int, key string")


def test_mix(spark):
    rows = texts(1, 600, ["s0", "s0", "s0", "s1", "s2", "s3", "s4", None]) + ODD
    got = mixing.mix(frame(spark, rows), block_words=32).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    by_target = defaultdict(int)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.first_slot is None) == (r.taken == 0)
        by_target[r.target, r.source_size] += r.taken
    assert by_target == {(float(want[s]), sizes[s]): int(want[s]) for s in want}


def test_equal_input_gives_equal_output(spark):
    rows = texts(2, 300, ["a", "b", None]) + ODD
    one = mixing.mix(frame(spark, rows).repartition(7), block_words=16)
    random.Random(4).shuffle(rows)
    two = mixing.mix(frame(spark, rows).coalesce(1), block_words=16, stretch_bits=3)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_pieces_cover_what_is_taken_once(spark):
    rows = texts(3, 200, ["a", "a", "b", "c", "d"])
    pieces, places = mixing.schedule(frame(spark, rows), block_words=16, stretch_bits=4)
    size = {(r.nth, r.at, r.copy): r.size for r in places.collect() if r["size"]}
    blocks, spans = defaultdict(int), defaultdict(list)
    for r in pieces.collect():
        blocks[r.nth, r.slot, r.late] += r.length
        spans[r.nth, r.at, r.copy, r.epoch].append((r.start, r.length))
    # Every slot holds at most a block, and all but the last of a source are full.
    assert max(blocks.values()) == 16 and sum(n < 16 for n in blocks.values()) <= 4
    for (nth, at, copy, _), parts in spans.items():
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end <= size[nth, at, copy]


def test_the_schedule_is_even_all_along(spark):
    """In every first stretch of slots each source has its share of them, but for a few."""
    rows = [(i, "w " * 40, s) for i, s in enumerate(["a"] * 300 + ["b"] * 300 + ["c"] * 300)]
    pieces, places = mixing.schedule(frame(spark, rows), block_words=10)
    share = {r.nth: r.target / 36_000 for r in places.collect()}
    slots = sorted({(r.slot, r.nth) for r in pieces.where("not late").collect()})
    assert len(slots) > 3500
    seen = Counter()
    for i, (_, nth) in enumerate(slots, 1):
        seen[nth] += 1
        assert all(abs(seen[s] - i * share[s]) < 8 for s in share)
    assert pieces.where("late").agg(F.sum("length")).first()[0] is None or pieces.where("late").agg(F.sum("length")).first()[0] < 100


def test_empty_tables_and_tables_without_words(spark):
    docs = frame(spark, ODD)
    assert mixing.mix(docs.where("false")).count() == 0
    assert [(r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(docs.where("doc_id = 6")).collect()] == [(6, 0, 0.0, 0)]
    assert [(r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(docs.where("doc_id = 9")).collect()] == [(9, 2, 2.0, 2)]
