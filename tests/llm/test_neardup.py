import random
import re

import numpy as np
import pytest

from pageloom.llm import neardup
from pageloom.llm.neardup import components, near_duplicates, sketch

from oracle import binary_digits

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def group(rng, n, edits, words=150, start=0):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"x{rng.random()}"
        out.append((start + i, " ".join(w)))
    return out


def test_sketch_agrees_as_the_similarity():
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 2**63, 400).astype(np.uint64) for _ in range(200)]
    b = [np.concatenate([s[:340], rng.integers(0, 2**63, 60).astype(np.uint64)]) for s in a]
    agree = (sketch(a) == sketch(b)).mean()
    assert abs(agree - 340 / 460) < 0.02
    one = sketch([np.array([7], np.uint64), np.array([7], np.uint64), np.zeros(0, np.uint64)])
    assert (one[0] == one[1]).all() and (one[0] != np.iinfo(np.uint64).max).all() and not one[2].any()


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    rng = random.Random(11)
    docs = group(rng, 120, 10) + group(rng, 60, 5, 60, 200) + group(rng, 40, 3, 12, 300) + [(400 + i, f"solo {i} " * 7) for i in range(10)]
    docs += [(500, None), (501, ""), (502, " \n"), (503, "A b c"), (504, "a B\tc"), (505, "a b c d"), (506, docs[0][1].upper()), (507, docs[0][1]), (508, "z " * 20_000), (509, "z " * 30_000)]
    want = brute(docs)
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs] + [(507, docs[0][1], 1, 2)], "doc_id long, text string, node int, bands int").repartition(4)
    rows = near_duplicates(d).collect()
    assert len(rows) == len(docs) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert near_duplicates(d.limit(0)).count() == 0


def test_members_of_a_leader_are_all_checked(spark):
    """Two clusters that a third text leads: links among members that are not linked to the leader."""
    rng = random.Random(2)
    docs = group(rng, 300, 14, 146)
    want = brute(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == want


def test_components_of_a_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 150] + [(1000, 1000)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert all(got[i] == (0 if i <= 150 else 151) for i in range(n + 1))


def test_open_members_meet_blocks_of_all_kinds(spark, monkeypatch):
    """Few members to a block and a lot, and most of them not linked to their leader."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(neardup, "LOT", 5)
    rng = random.Random(4)
    docs = group(rng, 90, 24, 150) + group(rng, 40, 18, 110, 200)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute(docs)


def test_hash_does_not_decide_for_unequal_texts(spark):
    docs = [(1, binary_digits(1024, "ab")), (2, binary_digits(1024, "ba")), (3, binary_digits(2048, "ab")), (4, binary_digits(2048, "ba"))]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}


def test_words_built_to_collide_and_ids_that_are_no_numbers(spark):
    docs = [(1, "rs18bf38il5pj3jo a b c d"), (2, "srlliwch$|ea;:~+ a b c d"), (3, "RS18bf38il5pj3jo a b c D")]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    with pytest.raises(TypeError, match="integer"):
        near_duplicates(spark.createDataFrame([("x", "a")], "doc_id string, text string"))


def test_an_id_with_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, a), (None, "q"), (9, a)]
    rows = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(2)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == sorted([(1, 36, 1), (1, 36, 1), (2, 37, 1), (3, 37, 1), (0, 36, 1), (0, 1, 0), (9, 36, 1)])
