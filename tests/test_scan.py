import random

import pytest
from pyspark.sql import functions as F

from pageloom.operators import ordered, scan


@pytest.fixture
def many_parts(spark):
    """Partitions stay as they are dealt out, so that groups lie in several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def rows_of(seed):
    chance = random.Random(seed)
    rows = [(g, o, chance.choice([None, None, chance.randrange(100)])) for g, n in ((1, 120), (2, 3), (3, 40), (None, 15), (4, 1)) for o in chance.sample(range(1000), n)]
    # a stretch without a value over several parts
    return [(g, o, None if g == 1 and 300 < o < 700 else v) for g, o, v in rows]


def test_scans_over_several_parts(many_parts):
    rows = rows_of(1)
    frame = many_parts.createDataFrame(rows, "g int, o int, v int").selectExpr("*", "'x' as _x").repartition(3)
    assert scan.parted(frame, "g", "o").filter("g = 1").select("_part").distinct().count() > 2
    got = scan.scanned(frame, "g", ["o"], s=scan.running_sum(F.col("v")), b=scan.running_sum(F.col("v"), own=False), l=scan.last_value(F.col("v")), p=scan.last_value(F.col("v"), own=False), n=scan.next_value(F.col("v")))
    near = scan.neighbours(frame, "v", "g", "o", 3)
    got, near = {(r.g, r.o): r for r in got.collect()}, {(r.g, r.o): r for r in near.collect()}
    assert len(got) == len(near) == len(rows)
    for g in {r[0] for r in rows}:
        line = sorted(r[1:] for r in rows if r[0] == g)
        for i, (o, _) in enumerate(line):
            before, after = [v for _, v in line[:i] if v is not None][::-1], [v for _, v in line[i + 1 :] if v is not None]
            upto = [v for _, v in line[: i + 1] if v is not None]
            r = got[g, o]
            assert (r.s, r.b, r.l, r.p, r.n) == (sum(upto), sum(before), upto[-1] if upto else None, before[0] if before else None, after[0] if after else None)
            assert (near[g, o]._before, near[g, o]._after) == (before[:3], after[:3])


def test_segments_over_several_parts(many_parts):
    rows = [(g, o, o % 7 == 3, f"t{o}") for g in (1, None) for o in range(90)]
    got = {(r.g, r.seq): (r.start, r.n_rows, r.body) for r in ordered.segments(many_parts.createDataFrame(rows, "g int, o int, h boolean, t string"), "g", "o", F.col("h"), "t").collect()}
    want = {}
    for g in (1, None):
        for k in range(13):
            part = [o for o in range(3 + 7 * k, min(10 + 7 * k, 90))]
            want[g, k + 1] = (part[0], len(part), "\n\n".join(f"t{o}" for o in part))
    assert got == want


def test_intervals_and_empty_tables(many_parts):
    frame = many_parts.createDataFrame([(1, i, "m" if i == 5 else None) for i in range(12)], "g int, o int, v string")
    got = {r.o: (r.interval.start, r.interval.end) for r in ordered.with_interval(frame, "v", F.lit("a"), F.lit("z"), "g", "o").collect()}
    assert got == {i: ("a", "m") if i < 5 else ("a", "z") if i == 5 else ("m", "z") for i in range(12)}
    assert scan.neighbours(frame.limit(0), "v", "g", "o").count() == 0 and scan.scanned(frame.limit(0), "g", ["o"], s=scan.running_sum(F.lit(1))).count() == 0
