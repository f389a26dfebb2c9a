import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from oracle import binary_digits

from pageloom.llm import periodic


def brute(x, least=24, times=3):
    """Every stretch that agrees with itself q words on, for each q, if no smaller q does for the whole stretch."""
    n, found = len(x), {}
    for q in range(1, n // times + 1):
        t = q
        while t < n:
            if x[t] != x[t - q]:
                t += 1
                continue
            begin = t
            while t < n and x[t] == x[t - q]:
                t += 1
            span = (begin - q, t)
            if span[1] - span[0] >= 2 * q and span not in found:
                found[span] = q
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(least, times * q))


def words_of(seed):
    chance = random.Random(seed)
    x = []
    while len(x) < chance.randint(30, 260):
        piece = [chance.randrange(chance.choice([1, 2, 3, 9])) for _ in range(chance.randint(1, 20))]
        x += piece * chance.choice([1, 1, 2, 3, 5, 9])
        x += [chance.randrange(1000) for _ in range(chance.randint(0, 8))]
    return x


def test_runs_against_brute_force():
    some = 0
    for seed in range(250):
        x = words_of(seed)
        want = brute(x)
        assert periodic.runs(np.array(x)) == want, seed
        some += len(want)
    assert some > 200


def test_other_thresholds_and_words_that_fool_hashes():
    for seed in range(60):
        x = words_of(seed)[:120]
        for least, times in ((4, 2), (9, 2), (6, 3), (10, 5)):
            assert periodic.runs(np.array(x), least, times) == brute(x, least, times), (seed, least, times)
    for text in (binary_digits(400, "ab"), "a" * 90, "ab" * 50 + "c" + "ab" * 50, "abaababaabaab" * 12):
        x = [ord(c) for c in text]
        assert periodic.runs(np.array(x)) == brute(x)


def test_parts_of_an_ordered_set():
    chance = random.Random(3)
    places = chance.sample(range(100_000), 5000)
    ends, seen = periodic.Ends(places[0]), [places[0]]
    for p in places[1:]:
        before, after = ends.add(p)
        assert before == max((s for s in seen if s < p), default=None) and after == min((s for s in seen if s > p), default=None)
        seen.append(p)
    assert [p for part in ends.parts for p in part] == sorted(places) and max(map(len, ends.parts)) <= periodic.PART


def test_long_periodic_text_is_quick():
    chance = random.Random(1)
    block = [chance.randrange(50_000) for _ in range(9000)]
    x = np.array([chance.randrange(50_000) for _ in range(5000)] + block * 4 + [7] * 3000)
    got = periodic.runs(x)
    assert [(r[1] >= 36_000, r[2]) for r in got] == [(True, 9000), (False, 1)]


def expected(doc_id, text):
    words = [w for w in (text or "").encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n_ for s, n_, q in found)]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ends = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *ends, sha("".join(f"{s},{n_},{q}\n" for s, n_, q in found).encode()), sha(b" ".join(kept)))


def test_query_against_brute_force(spark, tmp_path):
    chance = random.Random(8)
    rows = [(i, " ".join(f"w{w}" for w in words_of(i))) for i in range(80)]
    rows += [(None, "a " * 40), (None, None), (500, None), (501, ""), (502, " \t\x0b"), (503, "b\x0bb " * 30), (503, "b\x0bb " * 30), (504, "é x " * 12), (505, "z"), (506, "x y\n" * 3000)]
    rows += [(i, " ".join(str(chance.randrange(30)) for _ in range(60))) for i in range(600, 680)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "'x' as best", "2 as collapsed")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periodic.op12_suffix_automaton_runs(spark, str(tmp_path)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r[1] > 0 for r in got) > 40
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
