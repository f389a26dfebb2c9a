"""Triples (s, p, o, kind) of entries and where they stand, of extraction runs, and of what the tables of answers hold: observations and their taxa, persons, places and habitats, journeys, weather.

All that a row states is one array that is exploded once. Observations, journeys
and weather belong to their entry alone, so theirs need no shuffle; what several
rows say of one taxon, place, person or habitat is dropped but once. Nothing is
stated of a value that is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import vocab
from pageloom.functions.ids import name_id, observation_id
from pageloom.operators.constraints import TYPE
from pageloom.operators.curation import match_predicate
from pageloom.operators.graph import each

# How a person of a role is mentioned, what a habitat's match to a class is, ranks that a classification may name.
MENTIONS = {"companion": "mentionsCompanion", "source": "mentionsSource", "collector": "mentionsCollector", "cited-author": "mentionsCitedAuthor", "other": "mentionsOther"}
HABITAT_MATCH = {"exact": "skos:exactMatch", "close": "skos:closeMatch", "broad": "skos:broadMatch"}
RANKS = ("kingdom", "phylum", "class", "order", "family", "genus")
SCHEME = "habitatScheme"
SPECIES = "https://www.gbif.org/species/"


def entry_node(entry: Column) -> Column:
    return F.concat(F.lit("entry_"), entry.cast("string"))


def _one(s: Column, p: Column | str, o: Column, kind: str) -> Column:
    p = F.lit(p) if isinstance(p, str) else p
    return F.struct(s.alias("s"), p.alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("kind"))


def _about(s: Column, statements: list) -> Column:
    return F.array(*[_one(s, *x) for x in statements])


def _stated(rows: DataFrame, *parts: Column) -> DataFrame:
    """The triples of all parts (arrays) of each row. No part states a thing twice; those of lists that may are made distinct by who makes them, as telling all of a row's triples apart would compare each with each."""
    there = F.filter(F.concat(*parts), lambda t: t["o"].isNotNull())
    return each(rows.select(there.alias("_l")), "_l", "_n", "t").select("t.*")


def _record(entry: Column) -> list:
    return [("dcterms:isPartOf", entry, "iri"), ("prov:wasDerivedFrom", entry, "iri")]


def _said(value: Column, then: Column | str) -> Column:
    """What stands only where the value does."""
    return F.when(value.isNotNull(), then)


def entries(rows: DataFrame, collection: str) -> DataFrame:
    """Entries with the volume, page and region of the page that they stand in.

    rows: entry, entry_id, entry_date, entry_date_end, verbatim_date, plausible,
    note, kind, place, location_raw, text, volume, start, end (the volume's span,
    YYYY-MM), page_uid, page_id, scan, region_uid. Several days are an interval;
    an entry without a page is part of its volume, and a region without a page of
    none. ``collection`` begins the volumes' labels.
    """
    node, number = entry_node(F.col("entry")), F.format_string("%02d", F.col("volume").cast("int"))
    volume, page, region = F.concat(F.lit("volume_"), number), F.concat(F.lit("page_"), F.col("page_uid")), F.concat(F.lit("region_"), F.col("region_uid"))
    several = F.col("entry_date_end").isNotNull() & (F.col("entry_date_end") != "")
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    where = F.coalesce("place", filled("location_raw"))
    label = F.concat(F.lit("Tagebucheintrag "), F.coalesce(filled("verbatim_date"), filled("entry_date"), F.lit("o. D.")), F.coalesce(F.concat(F.lit(" · "), where), F.lit("")))
    of_entry = _about(node, [
        (TYPE, F.lit("DiaryEntry"), "iri"), ("rdfs:label", label, "@de"), ("dcterms:identifier", filled("entry_id"), "string"), ("dwc:eventDate", F.when(several, F.concat_ws("/", "entry_date", "entry_date_end")), "string"),
        ("dwc:eventDate", F.when(~several, F.col("entry_date")), "date"), ("dwc:verbatimEventDate", filled("verbatim_date"), "string"), ("datePlausible", F.col("plausible"), "boolean"), ("skos:note", filled("note"), "@de"), ("entryKind", filled("kind"), "string"),
        ("entryPlace", _said(F.col("place"), name_id("place", F.col("place"))), "iri"), ("dwc:fieldNotes", filled("text"), "string"), ("dcterms:isPartOf", F.coalesce(page, volume), "iri"), ("hasSourceRegion", region, "iri"),
    ])
    span = F.when(F.col("start").isNotNull(), F.concat_ws("/", "start", "end"))
    of_volume = _about(volume, [(TYPE, F.lit("DiaryVolume"), "iri"), ("rdfs:label", F.concat(F.lit(f"{collection} · Band "), number), "@de"), ("dcterms:temporal", span, "string")])
    seen = F.concat(F.lit("Vol. "), number, F.coalesce(F.concat(F.lit(" · scan "), filled("scan")), F.lit("")), F.lit(" ("), F.coalesce("page_id", F.lit("")), F.lit(")"))
    of_page = _about(page, [(TYPE, _said(page, F.lit("DiaryPage")), "iri"), ("rdfs:label", _said(page, seen), "string"), ("dcterms:identifier", _said(page, filled("page_id")), "string"), ("dcterms:isPartOf", _said(page, volume), "iri")])
    of_region = _about(region, [(TYPE, _said(region, F.lit("SourceRegion")), "iri"), ("rdfs:label", F.concat(F.lit("Region "), F.col("region_uid")), "string"), ("dcterms:isPartOf", _said(region, page), "iri")])
    whole = rows.filter("entry is not null and volume is not null")
    # an entry is one row; what many entries say of their volume, page and region is dropped but once, before it is shuffled
    shared = whole.select("volume", "start", "end", "page_uid", "page_id", "scan", "region_uid").distinct()
    return _stated(whole, of_entry).unionByName(_stated(shared, of_volume, of_page, of_region).dropDuplicates())


def run_node(model: Column, prompt: Column, started: Column) -> Column:
    return F.concat(F.lit("run_"), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (model, prompt, started)])), 1, 12))


def runs(rows: DataFrame) -> DataFrame:
    """Extraction runs with their agent and prompt. rows: model, backend, method, started_at, prompt, prompt_sha256."""
    model = F.coalesce(F.nullif("model", F.lit("")), F.lit("unknown"))
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.trim(model)), "[^a-z0-9._-]+", "-"), r"^[-.]+|[-.]+$", "")
    run, agent = run_node(F.col("model"), F.col("prompt_sha256"), F.col("started_at")), F.concat(F.lit("agent_"), F.coalesce(F.nullif(slug, F.lit("")), F.lit("unknown")))
    sha = F.nullif(F.col("prompt_sha256"), F.lit(""))
    prompt = F.concat(F.lit("prompt_"), F.left(sha, F.lit(12)))
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    of_run = _about(run, [
        (TYPE, F.lit("prov:Activity"), "iri"), ("rdfs:label", F.concat(F.lit("Extraction run · "), model), "string"), ("rdfs:comment", filled("method"), "string"), ("prov:startedAtTime", filled("started_at"), "dateTime"),
        ("prov:wasAssociatedWith", agent, "iri"), ("prov:used", prompt, "iri"),
    ])
    of_agent = _about(agent, [(TYPE, F.lit("prov:SoftwareAgent"), "iri"), ("rdfs:label", model, "string"), ("backend", filled("backend"), "string")])
    of_prompt = _about(prompt, [(TYPE, _said(sha, F.lit("prov:Entity")), "iri"), ("rdfs:label", _said(sha, F.coalesce(filled("prompt"), F.lit("prompt"))), "string"), ("dcterms:identifier", sha, "string")])
    return _stated(rows, of_run, of_agent, of_prompt).dropDuplicates()


def generated(records: DataFrame, run: Column) -> DataFrame:
    """Which run made each record: the subjects of the types that come from a run. records: triples of observations, journeys and weather."""
    made = records.filter((F.col("p") == TYPE) & F.col("o").isin("Observation", "TravelEvent", "WeatherReport"))
    return made.select("s", F.lit("prov:wasGeneratedBy").alias("p"), run.alias("o"), F.lit("iri").alias("kind"))


def taxa(rows: DataFrame) -> DataFrame:
    """rows: vernacular, scientific, note, rank, is_bird, method, confidence, and of a link gbif_key, match_type, iri (null without one)."""
    # what is said of a taxon meets in one task before it is stated: rows are moved once, and no task holds the triples of a whole file
    t = rows.filter("vernacular is not null").repartition(F.lower("vernacular"))
    node, concept = name_id("taxon", F.col("vernacular")), F.concat(F.lit(SPECIES), F.col("gbif_key").cast("string"))
    link = match_predicate(F.coalesce("match_type", F.lit("")), F.coalesce("method", F.lit("")))
    return _stated(t, _about(node, [
        (TYPE, F.lit("Taxon"), "iri"), ("rdfs:label", F.col("vernacular"), "@de"), ("dwc:vernacularName", F.col("vernacular"), "@de"), ("dwc:scientificName", F.col("scientific"), "string"),
        ("skos:note", F.when(F.col("scientific").isNull(), F.coalesce("note", F.lit("wissenschaftlicher Name nicht aufgelöst"))), "@de"), ("dwc:taxonRank", F.col("rank"), "string"), ("isBird", F.col("is_bird"), "boolean"),
        ("matchMethod", F.col("method"), "string"), ("matchConfidence", F.col("confidence"), "decimal"), ("gbifMatchType", F.col("match_type"), "string"), ("owl:sameAs", F.col("iri"), "iri"),
        ("dwc:taxonID", F.when(~F.coalesce(F.col("match_type") == "HIGHERRANK", F.lit(False)), concept), "string"), (link, concept, "iri"),
    ])).dropDuplicates()


def places(rows: DataFrame) -> DataFrame:
    """rows: name, verbatim, kind, lat, lon."""
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    at = lambda c: F.when(there, F.col(c))
    return _stated(rows.filter("name is not null"), _about(name_id("place", F.col("name")), [
        (TYPE, F.lit("Place"), "iri"), ("rdfs:label", F.col("name"), "@de"), ("dwc:verbatimLocality", F.col("verbatim"), "string"), ("placeKind", F.col("kind"), "string"), ("geo:lat", at("lat"), "decimal"), ("geo:long", at("lon"), "decimal"),
        ("dwc:decimalLatitude", at("lat"), "decimal"), ("dwc:decimalLongitude", at("lon"), "decimal"), ("dwc:geodeticDatum", F.when(there, F.lit("WGS84")), "string"),
    ])).dropDuplicates()


def persons(rows: DataFrame) -> DataFrame:
    """Persons and how their entries mention them. rows: entry, name, role; the role belongs to the mention, not to the person."""
    named = rows.filter("name is not null")
    node, entry = name_id("person", F.col("name")), entry_node(F.col("entry"))
    own = [(TYPE, F.lit("Person"), "iri"), ("rdfs:label", F.col("name"), "string"), ("schema:name", F.col("name"), "string")]
    mentioned = [("mentionsPerson", node, "iri"), *[(p, F.when(F.col("role") == role, node), "iri") for role, p in MENTIONS.items()]]
    return _stated(named, _about(node, own), _about(entry, mentioned)).dropDuplicates()


def habitats(rows: DataFrame) -> DataFrame:
    """Shared concepts. rows: habitat, and of a link class_iri, match (null without one; a link of an unknown kind is close)."""
    node = name_id("habitat", F.col("habitat"))
    link = {p: F.when(F.coalesce("match", F.lit("close")) == m, F.col("class_iri")) for m, p in HABITAT_MATCH.items()}
    return _stated(rows.filter("habitat is not null"), _about(node, [
        (TYPE, F.lit("skos:Concept"), "iri"), ("rdfs:label", F.col("habitat"), "@de"), ("skos:prefLabel", F.col("habitat"), "@de"), ("skos:inScheme", F.lit(SCHEME), "iri"), *[(p, o, "iri") for p, o in link.items()],
    ])).dropDuplicates()


def observations(rows: DataFrame, diarist: str) -> DataFrame:
    """rows: as answers.observations gives them. The diarist is the observer of field observations that name none; nobody is made up for others."""
    uid, entry = observation_id(F.col("entry").cast("string"), F.lit(None).cast("string"), F.col("vernacular"), F.col("index")), entry_node(F.col("entry"))
    text = lambda c, p, kind="string": (p, F.col(c), kind)
    observer = F.coalesce("observer", F.when(F.col("record_type") == "field-observation", diarist))
    specimen = F.exists("evidence", lambda e: e["kind"] == "specimen")
    rows = rows.withColumn("_s", uid)
    s, locality = F.col("_s"), F.col("locality.name")
    said = _about(s, [
        (TYPE, F.lit("Observation"), "iri"), ("rdfs:label", F.concat(F.lit("Beobachtung "), F.col("vernacular")), "@de"), ("observedTaxon", name_id("taxon", F.col("vernacular")), "iri"), *_record(entry), text("notes", "verbatimNotes", "@de"),
        ("observedAt", _said(F.col("place.name"), name_id("place", F.col("place.name"))), "iri"), ("hasLocality", _said(locality, name_id("place", locality)), "iri"), ("dwc:verbatimLocality", F.col("locality.verbatim"), "string"),
        text("event_date", "dwc:eventDate", "date"), text("event_time", "dwc:eventTime"), text("status", "dwc:occurrenceStatus"), text("count", "dwc:individualCount", "integer"), text("count_min", "individualCountMin", "integer"),
        text("count_max", "individualCountMax", "integer"), text("qualifier", "countQualifier"), text("sex", "dwc:sex"), text("life_stage", "dwc:lifeStage"), text("vitality", "dwc:vitality"), text("hedge", "dwc:identificationQualifier"),
        text("breeding", "breedingEvidence"), ("dwc:reproductiveCondition", vocab.reproductive_condition(F.col("breeding"), F.col("behaviour")), "string"), text("movement", "movementKind"), text("direction", "flightDirection", "@de"),
        text("record_type", "recordType"), ("dwc:basisOfRecord", vocab.basis_of_record(F.col("record_type"), specimen), "string"), ("dwciri:recordedBy", _said(observer, name_id("person", observer)), "iri"),
        text("citation", "dwc:associatedReferences", "@de"), ("dwciri:habitat", _said(F.col("habitat"), name_id("habitat", F.col("habitat"))), "iri"), text("habitat", "dwc:habitat", "@de"),
    ])
    kinds = F.transform("evidence", lambda e: _one(s, "evidenceKind", F.concat(F.lit("evidence_"), e["kind"]), "iri"))
    does = F.transform("behaviour", lambda b: _one(s, "dwc:behavior", b, "@de"))

    def call(e: Column, n: Column) -> Column:
        node = F.concat_ws("_", F.lit("vocalisation"), s, n.cast("string"))
        own = [(TYPE, F.lit("Vocalisation"), "iri"), ("dcterms:isPartOf", s, "iri"), ("callType", e["call_type"], "string"), ("callTranscription", e["transcription"], "string")]
        return F.concat(_about(node, own), F.array(_one(s, "hasVocalisation", node, "iri")))

    # calls are counted by themselves, so two of one observation stay apart
    calls = F.flatten(F.transform(F.filter("evidence", lambda e: e["kind"] == "auditory"), call))
    return _stated(rows, said, F.array(_one(entry, "containsObservation", s, "iri")), F.array_distinct(kinds), F.array_distinct(does), calls)


def journeys(legs: DataFrame) -> DataFrame:
    """legs: as answers.travel gives them, each event's from 0 on. An event's label tells how many legs it has."""
    entry = entry_node(F.col("entry"))
    event = F.concat_ws("_", F.lit("travel"), F.col("entry").cast("string"), F.col("event").cast("string"))
    leg = F.concat_ws("_", F.lit("leg"), event, F.col("leg").cast("string"))
    place = lambda c: name_id("place", c)
    of_event = [(TYPE, F.lit("TravelEvent"), "iri"), ("rdfs:label", F.concat(F.lit("Reise · "), F.col("n_legs").cast("string"), F.lit(" Etappe(n)")), "@de"), *_record(entry)]
    of_leg = _about(leg, [
        (TYPE, F.lit("TravelLeg"), "iri"), ("dcterms:isPartOf", event, "iri"), ("departurePlace", place(F.col("departure")), "iri"), ("arrivalPlace", place(F.col("arrival")), "iri"), ("transportMode", F.col("mode"), "string"),
        ("departureTime", F.col("departure_time"), "dateTime"), ("arrivalTime", F.col("arrival_time"), "dateTime"), ("skos:note", F.col("verbatim"), "@de"),
    ])
    held = F.array(_one(entry, "containsTravelEvent", event, "iri"), _one(event, "hasLeg", leg, "iri"))
    via = F.transform("via", lambda v: _one(leg, "viaPlace", place(v), "iri"))
    first = F.filter(F.concat(_about(event, of_event), held), lambda t: (F.col("leg") == 0) | (t["p"] == "hasLeg"))
    return _stated(legs, first, of_leg, F.array_distinct(via))


def weather(fields: DataFrame) -> DataFrame:
    """fields: as answers.entry_fields gives them; undated entries state nothing."""
    # taken out of an array, as a plain filter would be asked below the step that reads the answer, which then is done again
    told = each(fields.select("entry", F.array(F.struct("entry_date", "weather")).alias("_l")), "_l", "_n", "_w").select("entry", "_w.*")
    there = told.filter("weather is not null and entry_date is not null")
    entry, node = entry_node(F.col("entry")), F.concat(F.lit("weather_"), F.col("entry").cast("string"))
    w = lambda c, p, kind="string": (p, F.col(f"weather.{c}"), kind)
    said = _about(node, [
        (TYPE, F.lit("WeatherReport"), "iri"), ("rdfs:label", F.concat(F.lit("Wetter "), F.col("entry_date")), "@de"), w("verbatim", "weatherVerbatim", "@de"), w("value", "temperatureValue", "decimal"), w("unit", "temperatureUnit"),
        w("precipitation", "precipitation"), w("wind", "wind", "@de"), w("sky", "skyCondition"), *_record(entry),
    ])
    return _stated(there, said, F.array(_one(entry, "hasWeather", node, "iri")))
