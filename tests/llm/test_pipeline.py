import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from test_decontaminate import brute as contaminated
from test_neardup import brute as components
from tokenizers import Tokenizer

import corpus_pipeline
from pageloom.llm.mixing import mix

VOICES = {"aa": "the of and with this that from here", "bb": "der die und nicht für über ist ein"}


def test_stages_against_plain_python(spark, tmp_path):
    rng = random.Random(6)
    say = lambda lang, n: " ".join(rng.choice(VOICES[lang].split()) + str(rng.randrange(50)) for _ in range(n))
    docs = [(i, say(lang := rng.choice(["aa", "bb"]), rng.randrange(20, 80)), lang, f"s{i % 4}", i) for i in range(200)]
    items = [(1, say("aa", 15)), (2, say("bb", 30))]
    docs += [(300 + i, docs[i][1] + " tail", "aa", "s0", 1) for i in range(20)]
    docs += [(400 + i, f"{say('aa', 20)} {items[i % 2][1]}", "aa", "s1", 1) for i in range(6)]
    docs += [(500, None, "aa", "s1", 0), (501, "", None, None, 0), (502, "123 456", "aa", "s2", 3), (3, docs[3][1], docs[3][2], docs[3][3], 3)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = [r for r in docs if r[1] and any(c.isalpha() for c in r[1])]
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: (r[0], r[1])
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = got
        got = stage(spark, got, str(tmp_path)).cache()
        assert got.columns == d.columns
        if name == "near duplicates":
            comp = components([r[:2] for r in now])
            now = [r for r in now if comp[r[0]][1] == r[0]]
        if name == "benchmark decontamination":
            hit = contaminated([r[:2] for r in now], items)
            now = [r for r in now if not hit[r[0]][1]]
        if name == "mix of sources":
            copies = {r.doc_id: r.copies for r in mix(before).collect()}
            now = [r for r in now for _ in range(copies[r[0]])]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(now, key=key), name
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in now:
        ids = [*library.encode(r[1], add_special_tokens=False).ids, 1]
        want[r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_mix_takes_each_row_by_its_own_copies(spark):
    docs = [(None if i % 3 else i // 6, " ".join(["w"] * (1 + i % 4)), "aa", "abc"[i % 3 if i % 2 else 0], i) for i in range(120)] + [(7, "x y", "aa", "a", 900), (7, "x z", "aa", "a", 901), (7, "x y", "aa", "c", 902)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in corpus_pipeline.mixture(spark, d, "").collect())
    want = Counter()
    for r in mix(d).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    assert got == +want and {None, 7} <= {k[0] for k in got}


def test_stages_with_clashing_columns_and_on_an_empty_table(spark, tmp_path):
    names = "_id long, row string, size long, copies long, at long, part long, _source string, text2 string"
    docs = [(i, f"the of and {i} with this", "aa", f"s{i % 2}", i, i, "r", 1, 2, 3, 4, "z", "q") for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + names
    spark.createDataFrame([(1, "zz " * 12)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, []):
        d = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:4]:
            got = stage(spark, d, str(tmp_path))
            assert got.columns == d.columns
            assert set(got.collect()) <= set(d.collect())
        assert corpus_pipeline.tokens(spark, d, "").count() == len(rows)
    empty = tmp_path / "none"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
