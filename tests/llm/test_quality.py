import math
import random
import re
import zlib
from collections import Counter

from oracle import binary_digits

from pageloom.llm.quality import quality_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if wins[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_base_counts_and_verdicts(spark):
    rng = random.Random(3)
    good = lambda n: " ".join(rng.choice("der die das und Haus Ähre läuft schnell heim".split()) for _ in range(n))
    junk = lambda n: " ".join(rng.choice("@@@ x#x $$$ BUY!!! |".split()) for _ in range(n))
    docs = [(i, good(rng.randrange(30, 200))) for i in range(60)] + [(100 + i, junk(120)) for i in range(10)]
    line = good(12)
    docs += [(200, None), (201, ""), (202, " \n \n"), (203, "\n\na\na\n \na b\n"), (204, f"{line}\n{line}\n{line}\n"), (205, good(40_000)), (206, good(19)), (0, docs[0][1]), (207, "é" * 5000)]
    d = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(100, 0, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_filter(d, labels, buckets=1 << 12).collect()
    assert len(rows) == len(docs)
    want = {i: base(t) for i, t in docs}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id], r
        n, _, _, _, rep = want[r.doc_id]
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        if r.doc_id < 60:
            assert r.kept == (not r.base_failed)
        if 100 <= r.doc_id < 110 or r.base_failed:
            assert not r.kept


def test_toxic_rows_are_caught_and_clean_rows_kept(spark):
    rng = random.Random(9)
    common = [f"w{i}" for i in range(400)]
    clean = lambda: " ".join(rng.choice(common) for _ in range(rng.randrange(80, 160)))
    # one word in eight is of a kind that trusted text never has
    toxic = lambda: " ".join(rng.choice(["vile", "scum", "filth"]) if rng.random() < 0.12 else rng.choice(common) for _ in range(120))
    docs = [(i, clean()) for i in range(600)] + [(1000 + i, toxic()) for i in range(40)]
    labels = [(i, 1, 0) for i in range(400)] + [(1000 + i, 1, 1) for i in range(40)]
    kept = {r.doc_id: r.kept for r in quality_filter(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert sum(not kept[1000 + i] for i in range(40)) >= 36
    assert sum(kept[i] for i in range(400)) >= 0.98 * 400 and sum(kept[i] for i in range(400, 600)) >= 0.9 * 200


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b " * 30)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_filter(d, labels).first().base_failed
    assert quality_filter(d.limit(0), labels).count() == 0


def test_lines_are_told_apart_by_their_bytes(spark):
    texts = [f"{binary_digits(n, 'ab')}\n{binary_digits(n, 'ba')}" for n in (1024, 2048)] + [f"{binary_digits(1024, 'ab')}\n" * 2]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality_filter(d, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert {r.doc_id: r.n_dup_lines for r in got} == {0: 0, 1: 0, 2: 1}


#: Two words that the hash of eight bytes at a time does not tell apart without a key.
ALIKE = ("rs18bf38il5pj3jo", "srlliwch$|ea;:~+")


def test_windows_are_told_apart_by_their_bytes(spark):
    rest = "b c d e f g h"
    texts = [f"{ALIKE[0]} {rest} x {ALIKE[1]} {rest}", f"{ALIKE[0]} {rest} x {ALIKE[0]} {rest}", f"{ALIKE[0]} {rest} {ALIKE[1]} {rest} {ALIKE[0]} {rest}"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_filter(d, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()}
    assert got == {i: base(t)[4] for i, t in enumerate(texts)} and got[0] == 0 and got[1] == 16


def test_verdicts_by_brute_force(spark):
    """Words and pairs counted in dicts; no bucket holds two n-grams of so few."""
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocab[: 6 + 6 * (i % 3 == 0)]) for _ in range(rng.randrange(20, 90)))) for i in range(900)]
    trusted = [i for i in range(900) if i % 3 == 1]
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id long, quality int, toxic int")
    grams = lambda t: [*(w := t.split()), *zip(w, w[1:], strict=False)]
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    raw, good = Counter(g for _, t in docs for g in grams(t)), Counter(g for i, t in docs if i in trusted and not held(i) for g in grams(t))
    scale = sum(good.values()) / sum(raw.values())
    ratio = {g: math.log((good[g] + 32) / (n * scale + 32)) for g, n in raw.items()}
    score = {i: sum(x for g in grams(t) if abs(x := ratio[g]) >= 0.3) / len(grams(t)) for i, t in docs}
    base_failed = {i: base(t)[0] < 20 or 100 * base(t)[4] > 30 * base(t)[0] for i, t in docs}
    own = sorted(math.floor(score[i] / 1e-5) for i in trusted if held(i))
    limit = own[int(len(own) * 0.01)] * 1e-5
    rows = {r.doc_id: r for r in quality_filter(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), labels).collect()}
    assert all(abs(rows[i].score - score[i]) < 1e-9 for i in score)
    assert {i: rows[i].kept for i in score} == {i: not base_failed[i] and score[i] >= limit for i in score}
    assert len({r.kept for r in rows.values()}) == 2
