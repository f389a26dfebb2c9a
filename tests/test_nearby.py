import difflib
import math
import random

import pytest

from pageloom.operators import sameas
from pageloom.operators.nearby import near_places, unit_of_offset


def test_unit_of_offset_against_taking_every_unit(spark):
    chance = random.Random(4)
    units, probes = [], []
    for doc in (1, 2, 3, None):
        at = 0
        for u in range(25):
            at += chance.choice([0, 0, 3, 40])
            units.append((doc, u, at, at + chance.choice([0, 1, 5, 30, 90])))
            at += chance.choice([0, 2, 10])
        probes += [(doc, chance.randrange(-5, 500), i) for i in range(120)]
    probes += [(9, 5, 1)]
    found = unit_of_offset(spark.createDataFrame(units, "doc int, unit int, start int, end int"), spark.createDataFrame(probes, "doc int, offset int, tag int").repartition(3), "doc")
    got = sorted((tuple(r) for r in found.select("doc", "offset", "tag", "unit").collect()), key=str)
    want = []
    for doc, offset, tag in probes:
        mine = [u for u in units if u[0] == doc]
        hit = [u[1] for u in mine if u[2] <= offset < u[3] + 2]
        want.append((doc, offset, tag, hit[0] if hit else mine[-1][1] if mine else None))
    assert got == sorted(want, key=str)
    assert len({(w[3], w[0]) for w in want}) > 20


def distance(a, b):
    half = lambda x, y: math.sin((math.radians(y) - math.radians(x)) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1, half(a[0], b[0]) + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * half(a[1], b[1]))))


@pytest.mark.parametrize("km", [0.4, 25, 700, 4000])
def test_places_near_a_point_against_every_pair(spark, km):
    chance = random.Random(int(km))
    centres = [(0, 0), (0, 180), (52, 13), (89.99, 40), (-89.995, -170), (90, 0), (-90, 12), (70, -179.999), (-33, 179.9)]
    step = km / 111
    near = lambda c: (max(-90.0, min(90.0, c[0] + chance.uniform(-2, 2) * step)), (c[1] + chance.uniform(-2, 2) * step / max(math.cos(math.radians(c[0])), 0.01) + 180) % 360 - 180)
    points = [(i, *near(chance.choice(centres))) for i in range(150)] + [(900, None, 1.0)]
    places = [(i, *near(chance.choice(centres))) for i in range(150)] + [(901, 1.0, None)] + [(1000 + i, *p) for i, p in enumerate([(90.0, 5.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0)])]
    want = {(p[0], q[0]) for p in points for q in places if None not in p and None not in q and distance(p[1:], q[1:]) <= km}
    found = near_places(spark.createDataFrame(points, "point int, lat double, lon double"), spark.createDataFrame(places, "place int, lat double, lon double"), km)
    got = [(r.point, r.place) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


@pytest.mark.parametrize("cutoff", [0.75, 0.6, 0.9])
def test_best_match_against_every_pair(spark, cutoff):
    chance = random.Random(7)
    base = ["Star", "Rotkehlchen", "Amsel", "Kohlmeise", "Blaumeise", "Weißstorch", "Schwarzstorch", "Uhu", "a", "", "Zilpzalp", "Rotmilan", "Schwarzmilan", "ab", "aab"]
    names = sorted({b if chance.random() < 0.3 else "".join(c if chance.random() < 0.85 else chance.choice("aerstn ") for c in b) for b in base * 8})
    asked = sorted({"".join(c for c in chance.choice(base) if chance.random() < 0.9) for _ in range(60)} | {"", "a", "b", "Uh", "Amsel"})
    frame = lambda x: spark.createDataFrame([(n,) for n in [*x, None, x[-1]]], "name string").repartition(3)
    got = {r.name: (r.match, r.ratio) for r in sameas.best_matches(frame(asked), frame(names), cutoff=cutoff).collect()}
    want = {}
    for n in asked:
        best = difflib.get_close_matches(n, names, n=1, cutoff=cutoff)
        if best:
            want[n] = (best[0], difflib.SequenceMatcher(None, n, best[0]).ratio())
    assert got == want and len(want) > 20


def test_no_pair_of_names_is_moved(spark, monkeypatch):
    monkeypatch.setattr(sameas, "LOT", 16)
    names = [f"Meise {i}" for i in range(90)] + [f"Meise am Bach {i}" for i in range(90)] + ["", "x"]
    asked = [n[:3] + n[4:] for n in names if n]
    frame = lambda x: spark.createDataFrame([(n,) for n in x], "name string")
    found = sameas.best_matches(frame(asked), frame(names))
    want = {n: m[0] for n in set(asked) if (m := difflib.get_close_matches(n, names, n=1, cutoff=0.75))}
    assert {r.name: r.match for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "MapInArrow" not in plan.replace("FlatMapGroupsInArrow", "")


def test_same_as_and_labels(spark):
    rows = [("b", "Dr. Karl  Noll.", 2), ("a", "Karl Noll", 2), ("c", "K. Noll", 9), ("d", "Frau Noll", 1), ("e", "[unleserlich]", 1), ("f", "Noll", 1), ("g", "N.N.", 3), ("h", "Wüst", 1), ("i", "W. Wüst", 2), ("j", None, 1), ("k", "karl noll", 1)]
    d = spark.createDataFrame(rows, "node string, name string, n int")
    keyed = d.select("node", "n", sameas.person_label(d.name).alias("label")).selectExpr("node", "n", "lower(label) as key")
    assert {tuple(r) for r in sameas.same_as(keyed).collect()} == {("b", "a"), ("k", "a")}
    assert {tuple(r) for r in sameas.person_review(d).collect()} == {("c", "a", "initial-vs-full"), ("h", "i", "bare-surname-unique")}
    assert sameas.same_as(keyed.limit(0)).count() == 0 and sameas.best_matches(d.limit(0), d).count() == 0


def test_places_are_searched_for_every_fiftieth_customer(spark):
    from pageloom.plans.nearby import places_near_points

    sf = "/root/testdata/sf0.01"
    asked = {r.point for r in places_near_points(spark, sf).select("point").distinct().collect()}
    assert asked and all(p % 50 == 0 for p in asked)
    assert asked <= {r.c_custkey for r in spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey").collect()}
