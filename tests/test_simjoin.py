import random

import pytest
from pyspark.sql import functions as F

from pageloom.operators.pairs import minhash_pairs
from pageloom.operators.simjoin import similar_sets

SETS = "k long, s array<long>"


def alike(sets, threshold):
    out = {}
    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and len(set(x) & set(y)) >= threshold * len(set(x) | set(y)):
                out[a, b] = len(set(x) & set(y))
    return out


def random_sets(seed, n=90):
    chance = random.Random(seed)
    made = []
    while len(made) < n:
        base = chance.sample(range(chance.choice([30, 200, 5000])), chance.randint(1, 25))
        for _ in range(chance.choice([1, 1, 3, 6])):
            own = {x for x in base if chance.random() < chance.choice([1, 0.9, 0.6])} | set(chance.sample(range(10_000, 10_300), chance.randint(0, 6)))
            # one element that nearly all have
            made.append(sorted(own | {7} if chance.random() < 0.9 else own))
    return list(enumerate([list(s) for s in dict.fromkeys(map(tuple, made)) if s][:n]))


@pytest.mark.parametrize("threshold", [0.2, 0.45, 0.75, 1.0])
def test_every_pair_against_brute_force(spark, threshold):
    sets = random_sets(int(threshold * 100))
    frame = spark.createDataFrame([*sets, (900, []), (901, None)], SETS).selectExpr("*", "1 as n", "2 as e").repartition(3)
    got = {(r.a, r.b): r.shared for r in similar_sets(frame, "k", "s", threshold).collect()}
    assert got == alike(sets, threshold)
    assert threshold > 0.5 or len(got) > 50


def test_thresholds_met_exactly_and_bad_ones(spark):
    sets = [(1, [1, 2, 3]), (2, [2, 3, 4]), (3, [5]), (4, [6, 5]), (5, [10, 11, 12, 13, 14, 15, 16, 17, 18, 19]), (6, [10, 11, 12, 13, 14, 15, 16, 17, 18])]
    frame = spark.createDataFrame(sets, SETS)
    assert {(r.a, r.b) for r in similar_sets(frame, "k", "s", 0.5).collect()} == {(1, 2), (3, 4), (5, 6)}
    assert {(r.a, r.b) for r in similar_sets(frame, "k", "s", 0.9).collect()} == {(5, 6)}
    assert similar_sets(frame.limit(0), "k", "s", 0.5).count() == 0
    for bad in (0, 1.1):
        with pytest.raises(ValueError, match="threshold"):
            similar_sets(frame, "k", "s", bad)


def test_recall_of_the_sketch(spark):
    """Pairs at and above the threshold; the exact join says which there are."""
    chance = random.Random(1)
    sets = []
    for i in range(250):
        base, rest = chance.sample(range(1 << 40), 200), chance.sample(range(1 << 41, 1 << 42), 400)
        cut = chance.randint(0, 75)  # Jaccard from 0.45 to 1
        sets += [(2 * i, base), (2 * i + 1, sorted(base[cut:] + rest[:cut]))]
    frame = spark.createDataFrame(sets, SETS)
    every = similar_sets(frame, "k", "s", 0.45).select("a", "b", "jaccard").cache()
    found = minhash_pairs(frame, "k", "s").select("a", "b")
    assert found.exceptAll(every.select("a", "b")).count() == 0
    missed = every.join(found, ["a", "b"], "left_anti")
    n, low = every.count(), every.filter("jaccard < 0.55").count()
    assert n > 200 and low > 30
    assert missed.count() <= 0.02 * n and missed.filter("jaccard < 0.55").count() <= 0.08 * low
    assert every.agg(F.min("jaccard")).first()[0] >= 0.45


def test_sketched_pairs_over_several_lots_and_cells(spark, monkeypatch):
    from pageloom.operators import pairs

    monkeypatch.setattr(pairs, "LOT", 4)
    monkeypatch.setattr(pairs, "BUCKET", 3)
    base = list(range(400))
    sets = [(i, [x for x in base if x != i] + [1000 + i]) for i in range(30)] + [(50, list(range(5000, 5300)))]
    got = {(r.a, r.b): r.shared for r in minhash_pairs(spark.createDataFrame(sets, SETS), "k", "s", 0.75).collect()}
    assert got == alike(sets, 0.75) and len(got) == 435


def test_pieces_are_crc32_of_utf8():
    from zlib import crc32

    from pageloom.functions.similarity import pieces

    for t in ("", "abcd", "abcde", "aäßß€漢字😀z aäßß€", "plain plain text"):
        assert pieces(t).tolist() == sorted({crc32(t[i : i + 5].encode()) for i in range(len(t) - 4)})
