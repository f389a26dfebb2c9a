import json
from types import SimpleNamespace

from pyspark.sql import functions as F

from pageloom.operators import answers, nodes

FULL = {
    "entry_date": {"iso": "1917-04-07", "end_iso": "1917-04-06", "plausible": "ja"}, "entry_place": {"name": "Maising", "kind": "unknown"}, "entry_kind": "field_day",
    "persons": ["Kiel", {"name": "Förster Kiel", "role": "companion"}, {"name": "kiel", "role": "source"}, 3, {"name": "Adam", "role": "friend"}],
    "weather": [None, {"temperature_value": 3}, {"verbatim": "kalt", "temperature_value": "−3,5 Grad", "temperature_unit": "°R", "sky": "Himmel trüb", "precipitation": "kein Schnee", "wind": " "}],
    "observations": [
        None,
        {"vernacular_de": "Amsel", "observer": {"name": "Herr Kiel"}, "individual_count": 0, "count_min": "4", "count_max": 2, "taxon_rank": "Kiel", "record_type": "field-observation",
         "evidence": ["visual", {"kind": "auditory", "call_transcription": "tjück"}, {"kind": "auditory", "call_type": "Song"}, {"kind": "unknown"}], "behaviour": ["brütet", " "], "breeding_evidence": "probable", "event_time": "7h05"},
        {"vernacular_de": "Star", "observer": "Neu Mann", "individual_count": True, "confidence": 3, "event_time": "7:05 Uhr"},
        {"vernacular_de": "Fink", "observer": "Mann", "locality": "Wald", "individual_count": "2", "literature_citation": 1949, "habitat": "Au"},
        {"vernacular_de": "Rabe", "observer": "Der Schreiber", "record_type": "Literaturangabe", "sex": "MALE", "evidence": "specimen"}, {"x": 1}, "Elster",
    ],
    "travel_events": [
        {"legs": [{"arrival_place": "lost"}, {"departure_place": "B", "arrival_place": "C", "departure_time": "9.00", "arrival_time": "8.00"}, {"departure_place": "nowhere"}, {"arrival_place": "D", "transport_mode": "mit dem Zug", "via_places": ["x", None, "y"]}]},
        None, {"arrival_place": "E", "departure_place": "F"}, {"legs": [{"departure_place": "Q"}]}, "x",
    ],
}


def _rows(spark):
    rows = [
        (1, "1917-04-06", "Maising.", None, "Text", "Antwort: " + json.dumps(FULL, ensure_ascii=False) + " Ende"), (2, None, None, "P", "", '[{"vernacular_de":"Elster","individual_count":0,"occurrence_status":"absent"}]'),
        (3, "1917-01-01", None, "P", "", "keine"), (4, "1917-01-01", None, "P", None, None), (5, "1917-01-01", " bei A ", "P", None, '{"entry_place": "A", "entry_date": "1917-02-30", "persons": null, "travel_events": {"arrival_place": "Z"}, "weather": "Nebel"}'),
        (6, None, None, None, None, '{"entry_place": null, "observations": {"vernacular_de": "Uhu"}, "travel_events": [{"legs": [{"arrival_place": "Z"}]}]}'),
    ]
    return answers.parsed(spark.createDataFrame(rows, "entry int, entry_date string, location_raw string, place string, text string, raw string"), "raw")


def test_entry_fields(spark):
    got = {r.entry: r for r in answers.entry_fields(_rows(spark)).collect()}
    assert len(got) == 6
    a = got[1]
    assert (a.header_date, a.entry_date, a.entry_date_end, a.plausible, a.kind, a.place) == ("1917-04-06", "1917-04-07", None, True, "field-day", None)
    assert a.note == "Datum vom Modell korrigiert (Kopfzeile: 1917-04-06)"
    assert tuple(a.weather) == ("kalt", -3.5, "R", "none", None, "overcast")
    assert [tuple(got[i].place) for i in (2, 3, 4)] == [("P", "P", None)] * 3 and got[4].entry_date == "1917-01-01"
    assert tuple(got[5].place) == ("A", "bei A", "settlement") and got[5].entry_date == "1917-01-01" and got[5].note is None and got[5].weather.verbatim == "Nebel"
    assert got[6].place is None


def test_persons_and_observers(spark):
    got = [(r.entry, r.pos, r.name, r.role) for r in answers.persons(_rows(spark), ("der schreiber",)).orderBy("entry", "pos").collect()]
    # two are called Kiel, so a third name of that kind is a person of its own; Mann is the one who came before
    assert got == [(1, 0, "Kiel", None), (1, 1, "Förster Kiel", "companion"), (1, 2, "Adam", None), (1, 3, "Herr Kiel", "source"), (1, 4, "Neu Mann", "source")]


def test_observations(spark):
    got = {(r.entry, r.vernacular): SimpleNamespace(**r.asDict()) for r in answers.observations(_rows(spark), ("der schreiber",)).collect()}
    assert set(got) == {(1, "Amsel"), (1, "Star"), (1, "Fink"), (1, "Rabe"), (2, "Elster"), (6, "Uhu")}
    a, star, fink, rabe = (got[1, n] for n in ("Amsel", "Star", "Fink", "Rabe"))
    assert (a.index, a.count, a.count_min, a.count_max, a.rank, a.observer, a.event_time, a.flags, a.notes) == (1, 2, 2, 4, "unknown", "Herr Kiel", "07:05", ["record_type_conflict"], "Text")
    assert [tuple(e) for e in a.evidence] == [("visual", "Sichtbeobachtung", None, None), ("auditory", "Lautäußerung", "unknown", "tjück"), ("auditory", "Lautäußerung", "song", None)]
    assert (star.count, star.confidence, star.event_time, star.record_type, star.behaviour, star.evidence) == (None, 1.0, None, "third-party-report", [], [])
    assert (fink.observer, fink.count, fink.citation, fink.place.name, fink.locality.kind) == ("Neu Mann", 2, None, "Wald", "locality")
    assert (rabe.index, rabe.observer, rabe.record_type, rabe.sex, rabe.flags) == (4, None, "literature-record", "male", [])
    assert (got[2, "Elster"].count, got[2, "Elster"].status, got[2, "Elster"].notes, got[2, "Elster"].confidence, got[2, "Elster"].place.name) == (0, "absent", "Elster", None, "P")


def test_travel(spark):
    got = [tuple(r)[:10] for r in answers.travel(_rows(spark)).orderBy("entry", "event", "leg").collect()]
    assert got == [
        (1, 0, 0, 2, "B", "C", [], "unknown", "1917-04-07T09:00:00", None), (1, 0, 1, 2, "C", "D", ["x", "y"], "train", None, None), (1, 1, 0, 1, "F", "E", [], "unknown", None, None),
        (5, 0, 0, 1, "A", "Z", [], "unknown", None, None),
    ]


def test_empty_and_clashing_columns(spark):
    rows = _rows(spark).withColumn("index", F.lit(1)).withColumn("event", F.lit(1)).withColumn("role", F.lit("x"))
    assert answers.observations(rows).count() == 6 and answers.travel(rows).count() == 4 and answers.persons(rows.limit(0)).count() == 0
    assert answers.observations(rows.limit(0)).count() == 0 and answers.entry_fields(rows.limit(0)).count() == 0 and answers.travel(rows.limit(0)).count() == 0


def test_observation_nodes(spark):
    rows = answers.observations(_rows(spark), ("der schreiber",))
    found = nodes.observations(rows, "Schreiber")
    amsel = found.filter("p = 'rdfs:label' and o = 'Beobachtung Amsel'").first().s
    said = {(r.p, r.o) for r in found.filter(F.col("s") == amsel).collect()}
    assert {("dwc:reproductiveCondition", "breeding"), ("dwc:behavior", "brütet"), ("evidenceKind", "evidence_visual"), ("evidenceKind", "evidence_auditory"), ("dwc:individualCount", "2"), ("recordType", "field-observation"), ("dcterms:isPartOf", "entry_1")} <= said
    assert sum(p == "evidenceKind" for p, _ in said) == 2 and {o for p, o in said if p == "hasVocalisation"} == {f"vocalisation_{amsel}_0", f"vocalisation_{amsel}_1"}
    basis = {r.o for r in found.filter("p = 'dwc:basisOfRecord'").collect()}
    assert basis == {"HumanObservation", "MaterialCitation"}  # a specimen in the literature is of the literature
    # nobody is made up for what others report
    by = {r.s for r in found.filter("p = 'dwciri:recordedBy'").collect()}
    rabe = found.filter("p = 'rdfs:label' and o = 'Beobachtung Rabe'").first().s
    assert rabe not in by and amsel in by
    assert found.count() == found.distinct().count()


def test_shared_nodes(spark):
    taxa = spark.createDataFrame(
        [("Amsel", "Turdus merula", None, "species", True, "gazetteer", 0.9, 5, "EXACT", None), ("Amsel", "Turdus merula", None, "species", True, "gazetteer", 0.9, 5, "EXACT", None), ("Meise", None, None, "genus", None, "llm+gbif", None, 6, "HIGHERRANK", None),
         ("Ente", None, "unklar", None, None, "llm", None, None, None, "http://x")],
        "vernacular string, scientific string, note string, rank string, is_bird boolean, method string, confidence double, gbif_key int, match_type string, iri string",
    )
    found = nodes.taxa(taxa).collect()
    assert len(found) == len({(r.s, r.p, r.o) for r in found}) and len({r.s for r in found}) == 3
    got = [(r.p, r.o) for r in found]
    assert ("skos:exactMatch", "https://www.gbif.org/species/5") in got and ("skos:broadMatch", "https://www.gbif.org/species/6") in got and ("dwc:taxonID", "https://www.gbif.org/species/5") in got
    assert ("dwc:taxonID", "https://www.gbif.org/species/6") not in got and ("skos:note", "unklar") in got and ("skos:note", "wissenschaftlicher Name nicht aufgelöst") in got and ("owl:sameAs", "http://x") in got
    places = spark.createDataFrame([("A", "a", "settlement", 47.5, 11.0), ("A", "bei A", None, 47.5, 11.0), ("B", "B", None, None, 3.0), (None, "x", None, None, None)], "name string, verbatim string, kind string, lat double, lon double")
    got = {(r.p, r.o) for r in nodes.places(places).collect()}
    assert {("dwc:verbatimLocality", "a"), ("dwc:verbatimLocality", "bei A"), ("geo:lat", "47.5"), ("dwc:geodeticDatum", "WGS84")} <= got and ("geo:long", "3.0") not in got
    habitats = spark.createDataFrame([("Au", "http://e/G1", "broad"), ("Au", "http://e/G1", "broad"), ("Moor", "http://e/D", None), ("Feld", None, None)], "habitat string, class_iri string, match string")
    got = [(r.p, r.o) for r in nodes.habitats(habitats).collect()]
    assert got.count(("skos:broadMatch", "http://e/G1")) == 1 and ("skos:closeMatch", "http://e/D") in got and sum(p == "rdf:type" for p, _ in got) == 3
    persons = spark.createDataFrame([(1, "Kiel", "source"), (2, "Kiel", None), (1, "Kiel", "source")], "entry int, name string, role string")
    got = sorted((r.s, r.p) for r in nodes.persons(persons).collect() if r.s.startswith("entry"))
    assert got == [("entry_1", "mentionsPerson"), ("entry_1", "mentionsSource"), ("entry_2", "mentionsPerson")]


def test_entry_and_run_nodes(spark):
    schema = "entry string, entry_id string, entry_date string, entry_date_end string, verbatim_date string, plausible boolean, note string, kind string, place string, location_raw string, text string, volume int, start string, end string, page_uid string, page_id string, scan string, region_uid string"
    rows = [
        ("1", "L02-e1", "1919-05-01", None, "1. Mai", True, None, "field-day", "Kochel", "Kochel", "t", 2, "1919-01", "1920-02", "u1", "doc_1_L", "12", "u1-r3"),
        ("2", "", "1919-05-02", "1919-05-04", None, None, "unsicher", None, None, "am See", "", 2, "1919-01", "1920-02", None, None, None, "r9"),
        ("3", "L02-e3", None, None, None, None, None, None, None, None, None, 12, None, None, "u1", "doc_1_L", "", None), (None, "x", None, None, None, None, None, None, None, None, None, 1, None, None, None, None, None, None),
    ]
    got = {tuple(r) for r in nodes.entries(spark.createDataFrame(rows, schema), "Tagebuch").collect()}
    say = lambda s: {(p, o) for t, p, o, _ in got if t == s}
    assert say("entry_1") >= {("rdfs:label", "Tagebucheintrag 1. Mai · Kochel"), ("dwc:eventDate", "1919-05-01"), ("dcterms:isPartOf", "page_u1"), ("hasSourceRegion", "region_u1-r3"), ("datePlausible", "true")}
    assert say("entry_2") == {("rdf:type", "DiaryEntry"), ("rdfs:label", "Tagebucheintrag 1919-05-02 · am See"), ("dwc:eventDate", "1919-05-02/1919-05-04"), ("skos:note", "unsicher"), ("dcterms:isPartOf", "volume_02"), ("hasSourceRegion", "region_r9")}
    assert ("rdfs:label", "Tagebucheintrag o. D.") in say("entry_3") and say("volume_02") == {("rdf:type", "DiaryVolume"), ("rdfs:label", "Tagebuch · Band 02"), ("dcterms:temporal", "1919-01/1920-02")}
    assert say("page_u1") >= {("rdfs:label", "Vol. 02 · scan 12 (doc_1_L)"), ("rdfs:label", "Vol. 12 (doc_1_L)")} and say("region_r9") == {("rdf:type", "SourceRegion"), ("rdfs:label", "Region r9")}
    assert ("dcterms:isPartOf", "page_u1") in say("region_u1-r3") and not any(t[0] == "volume_01" for t in got)
    schema = "model string, backend string, method string, started_at string, prompt string, prompt_sha256 string"
    runs = spark.createDataFrame([("Model X/2 ", "api", "m", "1999-01-01T00:00:00", "p", "abcdef0123456789"), ("", None, None, None, None, None)], schema)
    got = {tuple(r) for r in nodes.runs(runs).collect()}
    assert {o for _, p, o, _ in got if p == "prov:wasAssociatedWith"} == {"agent_model-x-2", "agent_unknown"} and ("prompt_abcdef012345", "dcterms:identifier", "abcdef0123456789", "string") in got
    made = nodes.generated(spark.createDataFrame([("o1", "rdf:type", "Observation", "iri"), ("o1", "x", "Observation", "iri"), ("p", "rdf:type", "Place", "iri")], "s string, p string, o string, kind string"), F.lit("run_1"))
    assert [tuple(r) for r in made.collect()] == [("o1", "prov:wasGeneratedBy", "run_1", "iri")]


def test_an_answer_is_read_once(spark):
    """Neither an exploded array nor a filter is asked again below the step that reads the answer."""
    from pageloom.plans import answers as plans

    for query in (plans.person_triples, plans.weather_triples, plans.answer_persons, plans.answer_observations, plans.answer_travel, plans.observation_triples, plans.travel_triples):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("(?s)") == 1, query.__name__


def test_each_numbers_items_and_drops_empty_arrays(spark):
    from pageloom.operators.graph import each

    t = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, l array<string>")
    assert sorted(each(t, "l", "n", "x").select("k", "n", "x").collect(), key=lambda r: r.n) == [(1, 0, "a"), (1, 1, None)]


def test_taxa_are_dealt_out_before_their_triples_are_made(spark):
    from pageloom.plans.answers import taxon_triples

    plan = taxon_triples(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression [lower(")
