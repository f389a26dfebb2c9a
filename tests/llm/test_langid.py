import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import pytest

from pageloom.llm.langid import codewords, identify, keep_told, op5_ecoc_language_id, train
from pageloom.llm.text import mix

VOICES = {"aa": "the of and with this that from here", "bb": "der die und nicht für über ist ein", "cc": "le la et où çà que dans été", "dd": "el los ñu está por con una años", "ee": "zzx qqy wwk kkz xqy"}


def test_codewords_tell_all_apart():
    for n in (2, 3, 5, 7, 12):
        code = codewords(n)
        assert code.shape[0] == n and len({tuple(r) for r in code.tolist()}) == n
        assert all(len(set(c)) == 2 for c in code.T.tolist())


def test_held_out_accuracy_and_edges(spark, tmp_path):
    rng = random.Random(1)
    docs = []
    for i in range(600):
        lang = rng.choice(list(VOICES))
        docs.append((i, " ".join(rng.choice(VOICES[lang].split()) for _ in range(rng.randrange(5, 80))), lang))
    docs += [(1000, None, "aa"), (1001, "", None), (1002, "123 !!", "aa"), (1003, "the " * 40_000, None), (0, docs[0][1], docs[0][2]), (1004, "der die und", None), (None, "le la et que", "cc")]
    d = spark.createDataFrame([(*r, 1.0) for r in docs], "doc_id long, text string, lang string, score double").repartition(3)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op5_ecoc_language_id(spark, str(tmp_path)).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    truth = {i: lang for i, _, lang in docs[:600]}
    held = [r for r in rows if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    by = {r.doc_id: r.lang_pred for r in rows}
    assert [by[i] for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "aa", "bb"]
    assert {r.lang_pred for r in identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert identify(d.limit(0)).count() == 0


def test_letters_alone_make_a_language(spark):
    docs = [(i, VOICES["aa" if i % 2 else "bb"], "aa" if i % 2 else "bb") for i in range(40)] + [(100 + i, t, None) for i, t in enumerate(["²½", "Ⅷ", "٣ ४", "_", "ª", "中", "ñ"])]
    d = spark.createDataFrame([(*r, 1, 2, 3) for r in docs], "doc_id long, text string, lang string, lang_pred int, ambiguous int, bucket int")
    by = {r.doc_id: r.lang_pred for r in identify(d).collect()}
    assert [by[100 + i] == "und" for i in range(7)] == [True, True, True, True, False, False, False]


def test_answers_against_plain_python(spark):
    """Counts, codes, soft bits and losses once more with dicts and loops."""
    rng = random.Random(4)
    langs = sorted(VOICES)[:4]
    docs = [(i, " ".join(rng.choice(VOICES[langs[i % 4]].split()) for _ in range(rng.randrange(1, 30))), langs[i % 4]) for i in range(160)] + [(900, "the der le los", None), (901, "9", "aa")]
    buckets = 1 << 15

    def grams(text):
        data = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        return [int(mix(np.array([int.from_bytes(bytes([n]) + data[i : i + n], "big")], np.uint64))[0]) % buckets for n in (1, 2, 3) for i in range(len(data) - n + 1)]

    count = {x: Counter() for x in langs}
    for i, t, x in docs:
        if x and zlib.crc32(str(i).encode()) % 4 != 2:
            count[x].update(grams(t))
    total = {x: sum(c.values()) for x, c in count.items()}
    more = 0.5 / (sum(total.values()) / 4)
    p = {x: [(c[b] / total[x] + more) / (1 + more * buckets) for b in range(buckets)] for x, c in count.items()}
    code, weights, trust = codewords(4), [], []
    for bit in code.T.tolist():
        mean = lambda v, bit=bit: [sum(p[x][b] for x, k in zip(langs, bit, strict=True) if k == v) / bit.count(v) for b in range(buckets)]
        odds = [math.log(a / z) for a, z in zip(mean(1), mean(0), strict=True)]
        side = {x: sum(q * o for q, o in zip(p[x], odds, strict=True)) for x in langs}
        weights.append(odds)
        trust.append(max(min(min(side[x] for x, k in zip(langs, bit, strict=True) if k) - max(side[x] for x, k in zip(langs, bit, strict=True) if not k), 1.0), 0.01))
    want = {}
    for i, t, _ in docs:
        g = grams(t)
        bits = [sum(w[b] for b in g) / len(g) for w in weights]
        loss = {x: sum(v / sum(trust) * math.log1p(math.exp(-4 * (1 if k else -1) * m)) for v, k, m in zip(trust, code[n].tolist(), bits, strict=True)) for n, x in enumerate(langs)}
        part = {x: math.exp(-4 * (v - min(loss.values()))) for x, v in loss.items()}
        best = min(loss, key=loss.get)
        want[i] = (best, part[best] / sum(part.values())) if any(c.isalpha() for c in t) else ("und", 0.0)
    for r in identify(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)).collect():
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-4, (r, want[r.doc_id])


def test_scores_do_not_depend_on_the_partitions(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(VOICES[x].split()) for _ in range(rng.randrange(1, 60))), x) for i in range(200) for x in [rng.choice(list(VOICES))]]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert sorted(identify(d.repartition(1)).collect()) == sorted(identify(d.repartition(7)).collect())


def test_the_decoder_rejects_what_it_cannot_tell(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(VOICES[x].split()) for _ in range(30)), x) for i in range(200) for x in [list(VOICES)[i % 3]]]
    junk = [(1000 + i, t, None) for i, t in enumerate(["", "12 34", None, "ЖжЩщЖж", "中文字中文", "안녕하세요"])]
    d = spark.createDataFrame(docs + junk, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in keep_told(d, train(d)).collect()}
    assert kept == set(range(200))
    one = spark.createDataFrame([r for r in docs if r[2] == "aa"] + junk, "doc_id long, text string, lang string")
    assert {r.doc_id for r in keep_told(one, train(one)).collect()} == {r[0] for r in docs if r[2] == "aa"} | {1003, 1004, 1005}
    assert keep_told(d.limit(0), train(d.limit(0))).count() == 0
    with pytest.raises(ValueError, match="no language"):
        keep_told(d, train(d.limit(0)))
