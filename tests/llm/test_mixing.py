import random

from oracle import same

from pageloom.llm import mixing
from pageloom.llm.mixing import op9_systematic_mixing, source_targets


def fill(sizes, weights, share=1.5, cap=2.0):
    """Reshare what is above until no target is above."""
    total, stopped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in stopped)
        w = sum(weights[s] for s in sizes if s not in stopped)
        target = {s: cap * sizes[s] if s in stopped else left * weights[s] / w for s in sizes}
        above = {s for s in sizes if s not in stopped and target[s] > cap * sizes[s]}
        if not above:
            return target
        stopped |= above


def test_targets_against_resharing(spark):
    rng = random.Random(7)
    for n in (1, 2, 5, 20):
        sizes = {f"s{i:02d}": int(10 ** rng.uniform(0, 6)) for i in range(n)}
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
        want = fill(sizes, weights)
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        for r in source_targets(frame).collect():
            assert abs(r.target - want[r.source]) <= 1e-9 * want[r.source] + 1e-9


def test_query_against_sql(spark, tmp_path):
    rng = random.Random(8)
    docs = [(i, "w " * int(10 ** rng.uniform(0, 3)), rng.choice(["a", "b", "b", "b", "ä", None])) for i in range(3000)]
    docs += [(5, docs[5][1], docs[5][2]), (90_000, None, "a"), (None, "x y", "b"), (90_001, "", "zero"), (90_002, "é é \x0b z", "b")]
    d = spark.createDataFrame([(*r, 3) for r in docs], "doc_id long, text string, source string, size int").repartition(3)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    q = op9_systematic_mixing(spark, str(tmp_path))
    same(q, mixing.ORACLE_SQL, {"documents": d})
    rows = q.collect()
    assert all(r.taken <= 2 * r.size for r in rows) and len(rows) == len(docs)
    targets = {r.target for r in rows}
    for t in targets:
        own = [r for r in rows if r.target == t]
        assert abs(sum(r.taken for r in own) - t) <= 0.02 * t + 2 * max(r.size for r in own)
    d.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert op9_systematic_mixing(spark, f"{tmp_path}/e").count() == 0
