from pyspark.sql import functions as F

from pageloom.operators import places
from pageloom.operators.places import acceptance, geocodable, link_places, rejection_reason

SCHEMA = "label string, id string, source string, tier string, kind string, category string, name_tier string, fclass string, fcode string, cc string, population int, lat double, lon double, is_home boolean, has_home boolean, settlement_elsewhere boolean, n_entries int, f_near double, f_mid double, nearest_km double"


def row(label, id_, source, tier=None, name_tier=None, fclass="P", cc="DE", home=True, lat=48.2, n=0, near=0.0, mid=0.0, km=None, population=100, category="place"):
    return label, id_, source, tier, "settlement", category, name_tier, fclass, "PPL", cc, population, lat, 11.6, home, home, False, n, near, mid, km


def test_links(spark):
    rows = [
        row("Ismaning", "osm1", "osm+geonames", "strong"), row("Ismaning", "gn2", "geonames", None, "alternate"),
        row("Alone", "gn3", "geonames", None, "primary"), row("Twice", "gn4", "geonames", None, "primary"), row("Twice", "gn5", "geonames", None, "primary", lat=50.0),
        row("Bernried", "gn6", "geonames", None, "primary", n=3, near=0.0, mid=0.0, km=300.0), row("Bernried", "gn7", "geonames", None, "primary", lat=47.9, n=3, near=0.7, mid=0.9, km=5.0),
        row("Pub", "osm8", "osm", "weak", category="amenity"),
    ]
    got = {r.label: (r.id, r.confidence, r.status) for r in link_places(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"Ismaning": ("osm1", 0.95, "linked"), "Alone": ("gn3", 0.8, "linked"), "Twice": ("gn4", 0.5, "review"), "Bernried": ("gn7", 0.95, "linked"), "Pub": ("osm8", 0.45, "review")}


def test_labels(spark):
    names = ["Oberstdorf", "bei Füssen", "Hofgarten", "See", "Kochel 12", "x", "Ammersee", None]
    d = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[0] for r in d.select(geocodable(F.col("x"), ("see",))).collect()] == [True, False, False, False, False, False, True, False]
    d = spark.createDataFrame([("Rauhfutter",), ("Mchn",), (" ",), ("Lachmöwe",), ("Kochel. Herzogstandhaus 1555 m",)], "x string")
    assert [r[0] for r in d.select(rejection_reason(F.col("x"), F.col("x") == "Lachmöwe")).collect()] == ["garbage", "garbage", "empty", "bird", None]


def test_acceptance(spark):
    rows = [("EXACT", 95, "SPECIES", None, False), ("EXACT", 85, "SPECIES", None, False), ("FUZZY", 95, "SPECIES", None, False), ("EXACT", 99, "GENUS", None, False), ("EXACT", 99, "genus", "genus", True), ("HIGHERRANK", 99, "GENUS", None, False), ("HIGHERRANK", 99, "GENUS", None, True), ("NONE", 0, None, None, False)]
    d = spark.createDataFrame(rows, "m string, c int, r string, i string, p boolean")
    assert [r[0] for r in d.select(acceptance(*map(F.col, "mcrip"))).collect()] == ["linked", "review", "linked", "review", "linked", "linked-broad", "review", "review"]


def test_candidates_meet_as_places(spark, monkeypatch):
    """300 hits at three places and 300 records at four: distances are taken between places, and the record is the one that all pairs would give."""
    asked = spark.sparkContext.accumulator(0)

    def flat(a, b, c, d):
        asked.add(1)
        return 111.0 * (abs(a - c) + abs(b - d))

    monkeypatch.setattr(places, "km", F.udf(flat, "double"))
    hits = [("Ort", f"n/{i}", "place" if i % 2 else "natural", "water", "Ort", None, "x", 48.0 + i % 3, 11.0) for i in range(300)] + [("Ort", "n/0", "natural", "water", "Ort", None, "x", 50.0, 11.0)]
    gaz = [("ort", i, "Ort", "PH"[i // 2 % 2], "PPL", "DE", "02", 48.0 + i % 2 + 0.01, 11.0, None if i == 7 else i % 50 * 100, True) for i in range(300)]
    d = spark.createDataFrame
    got = places.place_candidates(
        d([("Ort", "settlement")], "label string, kind string"), d(hits, "label string, osm string, category string, type string, name string, name_de string, display_name string, lat double, lon double"),
        d(gaz, "key string, id long, name string, fclass string, fcode string, cc string, admin1 string, lat double, lon double, population long, is_primary boolean"), d([("Ort", 1, 48.0, 11.0)], "label string, entry int, lat double, lon double"),
    ).collect()
    want = {}
    for _, osm, category, *_, lat, _ in hits:
        near = [((g[3] != ("H" if category == "natural" else "P"), g[9] is not None, -(g[9] or 0), g[1]), g) for g in gaz if 111.0 * abs(g[7] - lat) <= 10]
        want[osm] = min([*near, *([want[osm]] if want.get(osm) else [])], default=None)
    found = [r for r in got if r.source != "geonames"]
    assert sorted((r.id, r.source, r.fclass, r.population, r.lat) for r in found if r.id != "n/0") == sorted((o, "osm+geonames", w[1][3], w[1][9], w[1][7]) if w else (o, "osm", None, None, 50.0) for o, w in want.items() if o != "n/0")
    assert {(r.source, r.fclass) for r in found if r.id == "n/0"} == {("osm+geonames", "H")} and len(got) - len(found) == 300 - len({w[1][1] for w in want.values() if w})
    assert asked.value < 400
