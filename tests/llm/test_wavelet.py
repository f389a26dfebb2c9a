import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm import wavelet
from pageloom.llm.wavelet import WaveletMatrix, check_ids, token_files


def test_matrix_against_plain_array():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 511, 512, 513, 3000):
        ids = np.where(rng.random(n) < 0.5, rng.integers(0, 5, n), rng.integers(0, 49408, n)).astype(np.uint16)
        m = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes())
        assert np.array_equal(m.all_ids(), ids)
        for i in rng.integers(0, n, 20) if n else []:
            assert m.access(int(i)) == ids[i]
            assert m.rank(int(ids[i]), int(i)) == int((ids[:i] == ids[i]).sum())
        for token in (0, 3, 49407, 11):
            assert m.occurrences(token) == np.flatnonzero(ids == token).tolist()


def test_files_read_back(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["The", "cat,", "naïve", "x1", "ÉTÉ", "don't", "\n"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    docs = [(i * 3, t) for i, t in enumerate(texts)] + [(5000, None), (5001, ""), (5002, "a " * 30_000), (9, texts[0]), (9, texts[0]), (None, "null id")]
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, start int").repartition(5)
    got = token_files(d, tokenizer=path, end_id=1).collect()
    library = Tokenizer.from_file(path)
    at, want = 0, []
    for i, t in sorted(docs, key=lambda x: (-1 if x[0] is None else x[0])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    key = lambda r: (-1 if r[0] is None else r[0], r[1], r[2])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert token_files(d.limit(0), tokenizer=path, end_id=1).count() == 0


def test_larger_vocabularies_are_refused():
    with pytest.raises(ValueError):
        WaveletMatrix.build(np.array([1, 1 << 16]))
    with pytest.raises(ValueError):
        check_ids(np.array([70_000]))


def test_a_part_of_several_shards(spark, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_IDS", 500)
    monkeypatch.setattr(wavelet, "MAX_PARTS", 2)
    docs = [(i, "the cat " * (i % 90)) for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    at = 0
    for r in sorted(token_files(d, tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=1).collect(), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens) == (at, 2 * (r.doc_id % 90) + 1)
        at += r.n_tokens
