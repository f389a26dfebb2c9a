import math
import random

import numpy as np
import pytest
from oracle import same
from pyspark.sql import functions as F

from pageloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(ints):
        if q is not None and q % every == 0:
            all_ = [(-sum(s * t for s, t in zip(x, y, strict=True)), c is None, c or 0, b, c) for b, (c, y) in enumerate(ints) if b != a and len(x) == len(y)]
            out += [(q, r + 1, c, -s) for r, (s, _, _, _, c) in enumerate(sorted(all_)[:k])]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def rows_of(seed, n, dim=12, kinds=4):
    chance = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    centres = [[chance.gauss(0, 1) for _ in range(dim)] for _ in range(kinds)]
    return [(i, [f32(chance.choice([0.2, 1, 1, 3]) * (c + chance.gauss(0, 0.3))) for c in centres[i % kinds]]) for i in range(n)]


def found(frame, **more):
    got = [tuple(r) for r in topk.top_inner_products(frame, F.col("id") % 50 == 0, **more).select("query_id", "rank", "vec_id", "score").collect()]
    return sorted(got, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize(("shard_bytes", "shard_rows"), [(1 << 25, 4096), (3000, 40)])
def test_against_brute_force_and_sql(spark, monkeypatch, shard_bytes, shard_rows):
    rows = rows_of(shard_rows, 700)
    same_ = rows[3][1]
    rows += [(i, same_) for i in range(1000, 1130)] + [(50, rows[1][1]), (50, rows[1][1]), (None, same_), (150, None), (200, [1.0, None] * 6), (250, [math.nan] * 12), (350, [math.inf] * 12)]
    rows += [(400 + i, [float(i), -1.0]) for i in range(0, 300, 10)] + [(5000, [2.5] * 7), (5050, []), (5051, []), (5100, [0.0] * 12), (-50, [-3.0] * 12)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as shard", "3 as head").repartition(5)
    assert found(frame, shard_bytes=shard_bytes, shard_rows=shard_rows) == brute(rows)
    # blocks of a few vectors only
    monkeypatch.setattr(topk, "BLOCK_BYTES", 64 * 9)
    assert found(frame, shard_bytes=shard_bytes, shard_rows=shard_rows) == brute(rows)
    same(topk.top_inner_products(frame, F.col("id") % 50 == 0), topk.ORACLE_SQL, {"embeddings": frame})


def test_bounds_leave_pairs_out_but_lose_none():
    chance = np.random.default_rng(4)
    x = np.floor(chance.normal(0, 1, (3000, 32)) * 256 * np.geomspace(1, 0.02, 32)) * chance.choice([1, 1, 4], (3000, 1))
    norm = np.sqrt((x * x).sum(1))
    order = np.argsort(-norm)
    x, norm = x[order], norm[order]
    ids = np.arange(3000)
    none = np.zeros(3000, bool)
    blocks = [topk.Block(ids[i : i + 250], ids[i : i + 250], none[:250], x[i : i + 250], norm[i : i + 250]) for i in range(0, 3000, 250)]
    turn, levels = topk.rotation(blocks[0].x), topk.levels_of(32)
    asked = topk.Block(ids[::50], ids[::50], none[::50], x[::50], norm[::50])
    taken, real = [], topk.exact
    topk.exact = lambda q, y, qi, xi: (taken.append(len(qi)), real(q, y, qi, xi))[1]
    try:
        best = topk.Best(asked, 5, np.full(60, topk.NONE))
        topk.search(best, [(b, topk.Rotated(b.x, turn, levels)) for b in blocks], turn, levels)
    finally:
        topk.exact = real
    score = x[::50] @ x.T
    score[np.arange(60), ids[::50]] = -np.inf
    want = [np.lexsort((ids, -s))[:5].tolist() for s in score]
    q, _, got, _, _ = best.held
    assert [got[q == i].tolist() for i in range(60)] == want
    assert sum(taken) < 0.2 * 60 * 3000


def test_large_numbers_and_errors(spark):
    big = [(i * 50, [4_000_000.0 + i * 256, -4_000_000.0]) for i in range(7)]
    assert found(spark.createDataFrame(big, SCHEMA)) == brute(big)
    with pytest.raises(Exception, match="32 bits"):
        found(spark.createDataFrame([(0, [1e30]), (1, [1.0])], SCHEMA))
    assert found(spark.createDataFrame([], SCHEMA)) == [] and found(spark.createDataFrame([(0, [1.0])], SCHEMA)) == []
    assert found(spark.createDataFrame([(0, [1.0]), (1, [2.0])], SCHEMA)) == [(0, 1, 1, 131072)]
