import hashlib
import random
import re

from oracle import binary_digits

from pageloom.llm.decontaminate import _index, decontaminate, keep_clean

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, window=10):
    out = {}
    for doc, text in docs:
        w, hit, ids = WORD.findall(lowered(text)), set(), set()
        for item, t in items:
            v = WORD.findall(lowered(t))
            n = min(window, len(v))
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    ids.add(str(item))
        out[doc] = (len(w), len(hit), sorted(ids))
    return out


def cases():
    rng = random.Random(5)
    vocab = ["the", "of", "Ünd", "x1", "cat", "dog", "éa", "run"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([40, 25, 10, 9, 3, 1, 12, 30])] + [(8, None), (9, ""), (10, "..."), (1, "the cat")]
    docs = [(i, line(rng.randrange(0, 90))) for i in range(40)]
    docs += [(100 + i, f"{line(20)}, {(items[i][1] or '').upper()}! {line(15)}") for i in range(8)]
    docs += [(200, None), (201, ""), (202, "!!"), (203, line(30_000)), (204, items[0][1]), (205, items[0][1])]
    return docs, items


def test_against_brute_force_by_both_ways(spark):
    docs, items = cases()
    want = brute(docs, items)
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, n_words string").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 0):
        got = {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in decontaminate(d, it, broadcast_bytes=limit).collect()}
        assert got == want, limit
        left = keep_clean(d, it, broadcast_bytes=limit)
        assert left.columns == d.columns and {r.doc_id for r in left.collect()} == {i for i, x in want.items() if not x[1]}


def test_clashing_columns_and_an_id_with_two_texts_by_both_ways(spark):
    docs, items = cases()
    docs = [*docs, (7, items[0][1]), (None, items[1][1]), (None, "quite clean")]
    want = sorted(((i, t) for i, t in docs if not next(iter(brute([(i, t)], items).values()))[1]), key=str)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as _id", "2 as _key", "3 as _text", "4 as _doc", "5 as _gram", "6 as _item", "7 as n_hit").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as _id", "2 as _text")
    for limit in (1 << 20, 0):
        left = keep_clean(d, it, broadcast_bytes=limit)
        assert left.columns == d.columns and sorted((tuple(r)[:2] for r in left.collect()), key=str) == want, limit
        assert decontaminate(d, it, broadcast_bytes=limit).count() == len(docs)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    it = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(d, it).first().n_hit == 0
    assert decontaminate(d.limit(0), it).count() == 0
    assert hashlib.sha256(b"").hexdigest()


def test_hits_are_confirmed_by_their_bytes(spark):
    docs = [(n, f"see {binary_digits(n, 'ab')} here") for n in (1024, 2048)]
    items = [(n + k, binary_digits(n, two)) for n in (1024, 2048) for k, two in enumerate(("ba", "ab"))]
    d, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 0):
        got = {r.doc_id: (r.n_hit, list(r.item_ids)) for r in decontaminate(d, it, broadcast_bytes=limit).collect()}
        assert got == {1024: (1, ["1025"]), 2048: (1, ["2049"])}


def test_many_items_of_one_text_by_the_shuffle(spark):
    """More items than meet a text at a time, one word of all documents among them."""
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice("the cat ran far".split()) for _ in range(60))) for i in range(12)]
    items = [(i, " ".join(docs[i % 12][1].split()[i % 40 : i % 40 + rng.randrange(1, 14)])) for i in range(300)] + [(900, "the"), (901, "cat")]
    want = brute(docs, items)
    found = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), broadcast_bytes=0)
    assert {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in found.collect()} == want
    assert _index(found, spark.createDataFrame([(i, None) for i in range(1000)], "item_id long, text string"), "item_id", 10, 5, 1000) is None
