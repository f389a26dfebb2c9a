"""Model answers mapped to rows: an answer for each order, in the shapes that models give, with an item for each of its line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions.text import fill
from pageloom.operators import answers, nodes
from pageloom.plans.model import ENTRIES, entries
from pageloom.plans.registry import query, table

#: Items by l_linenumber % 6; the third and fourth name nothing.
_ITEMS = (
    '{"vernacular_de":"{{v}}","individual_count":{{c}},"observer":"{{o}}","evidence":[{"kind":"auditory"},"nest","smell"],"taxon_rank":"Species"}',
    '{"vernacular_de":" {{v}} ","count_min":{{c}},"count_max":3,"count_qualifier":"plural_unspecified","occurrence_status":"absent","taxon_rank":"tribe"}',
    '{"vernacular_de":"","individual_count":1}',
    '"{{v}}"',
    '{"vernacular_de":"{{v}}","individual_count":"0","literature_citation":"Orn. {{c}}","event_date":"1995-02-{{c}}","event_time":"{{c}}.15"}',
    '{"vernacular_de":"{{v}}","individual_count":{{c}}.5,"observer":{"name":"unbekannt"},"record_type":"Brief","locality":{"name":"{{o}}","kind":"region"},"confidence":{{c}},"is_bird":"ja"}',
)
#: Answers by o_orderkey % 5.
_ANSWERS = (
    '{"entry_date":{"iso":"{{d}}","end_iso":"{{e}}","plausible":"ja"},"entry_place":{"name":"{{place}}","kind":"unknown"},"entry_kind":"field_day","persons":["{{person}}",{"name":"{{low}}"},{"name":"Dr S2","role":"companion"},{"name":"Dr S2","role":"source"},7],'
    '"weather":{"verbatim":"Wetter","temperature_value":"{{t}} Grad","temperature_unit":"R.","precipitation":"kein Regen","sky":"Himmel trüb"},"observations":[{{items}}],'
    '"travel_events":[{"legs":[{"arrival_place":"lost"},{"departure_place":"S","arrival_place":"{{place}}"},{"arrival_place":"Z","transport_mode":"mit dem Dampfer"}]}]}',
    'Antwort: {"entry_date":"{{d}}","entry_place":"{{place}}","persons":"{{person}}","weather":["","Nebel"],"observations":[{{items}}],'
    '"travel_events":[null,{"legs":{"arrival_place":"Y","transport_mode":"mit der Bahn","departure_time":"{{hh}}.15","arrival_time":"9:30","via_places":["V",null,"{{person}}"]}}]}',
    '{"entry_kind":"Feldtag","weather":17,"observations":[{{items}}],"travel_events":[{"departure_place":"A","arrival_place":"B"},"x",{"arrival_place":"{{place}}"}]}',
    "[{{items}}]",
    "keine Antwort",
)


def _parsed(spark, sf_dir):
    o, c, n, li, p = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "lineitem", "part"))
    w = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    values = {"v": F.element_at(F.split("p_name", " "), 2), "c": F.col("l_quantity").cast("int").cast("string"), "o": F.concat(F.lit("S"), (F.col("l_suppkey") % 5).cast("string"))}
    item = F.coalesce(*[F.when(F.col("l_linenumber") % 6 == i, fill(x, values)) for i, x in enumerate(_ITEMS)])
    items = w.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", item.alias("item")).alias("x")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("x"))
    day = lambda plus: F.date_format(F.date_add(F.to_date("o_orderdate"), plus), "yyyy-MM-dd")
    k = F.col("o_orderkey")
    values = {
        "d": day((k % 2).cast("int")), "e": day((k % 3).cast("int")), "place": F.col("n_name"), "person": F.col("c_name"), "low": F.lower("c_name"), "t": (k % 200 - 100).cast("string"), "hh": (k % 30).cast("string"),
        "items": F.array_join(F.transform("x", lambda x: x["item"]), ","),
    }
    raw = F.coalesce(*[F.when(k % 5 == i, fill(x, values)) for i, x in enumerate(_ANSWERS)])
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(items, k == F.col("l_orderkey"), "left")
    rows = rows.select(k.alias("entry"), day(0).alias("entry_date"), F.concat(F.lit(" bei "), F.col("n_name")).alias("location_raw"), F.lit("daheim").alias("place"), F.lit("Text").alias("text"), raw.alias("raw"))
    return answers.parsed(rows, "raw")


_ORDERS = """o AS (SELECT o_orderkey AS entry, o_orderkey % 5 AS k, n_name AS pl, c_name AS person, o_orderdate::DATE AS h, o_orderdate::DATE + (o_orderkey % 2)::INT AS d, o_orderdate::DATE + (o_orderkey % 3)::INT AS e
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  x AS (SELECT *, CASE WHEN k < 2 THEN d ELSE h END AS dt, CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN pl ELSE 'daheim' END AS place FROM o)"""
#: Line items as the items that stay: what they are called, which number they have, who saw them.
_SEEN = """i AS (SELECT l_orderkey AS entry, l_linenumber % 6 AS m, l_quantity::INT AS c, split_part(p_name, ' ', 2) AS v, 'S' || (l_suppkey % 5) AS o,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS index FROM lineitem JOIN part ON l_partkey = p_partkey),
  s AS (SELECT i.*, x.*, CASE WHEN m = 0 THEN CASE WHEN k = 0 AND o = 'S2' THEN 'Dr S2' ELSE o END END AS observer FROM i JOIN x USING (entry) WHERE m NOT IN (2, 3) AND k < 4)"""


@query(f"""WITH {_ORDERS} SELECT entry, strftime(h, '%Y-%m-%d') AS header_date, strftime(dt, '%Y-%m-%d') AS entry_date, CASE WHEN k = 0 AND e >= d THEN strftime(e, '%Y-%m-%d') END AS entry_date_end, CASE WHEN k = 0 THEN true END AS plausible,
    CASE WHEN dt <> h THEN 'Datum vom Modell korrigiert (Kopfzeile: ' || strftime(h, '%Y-%m-%d') || ')' END AS note, place, CASE WHEN k = 1 THEN 'bei ' || pl ELSE place END AS written, CASE WHEN k = 1 THEN 'settlement' END AS place_kind,
    CASE WHEN k = 0 THEN 'field-day' END AS kind, CASE k WHEN 0 THEN 'Wetter' WHEN 1 THEN 'Nebel' END AS weather, CASE WHEN k = 0 AND entry % 200 - 100 BETWEEN -60 AND 60 THEN (entry % 200 - 100)::DOUBLE END AS temperature,
    CASE WHEN k = 0 AND entry % 200 - 100 BETWEEN -60 AND 60 THEN 'R' END AS unit, CASE WHEN k = 0 THEN 'none' END AS precipitation, CASE WHEN k = 0 THEN 'overcast' END AS sky FROM x""")
def answer_entries(spark, sf_dir):
    """An entry's own fields, the header's where the answer gives none."""
    f = answers.entry_fields(_parsed(spark, sf_dir))
    w = lambda a, b: F.col(f"weather.{a}").alias(b)
    return f.select(
        "entry", "header_date", "entry_date", "entry_date_end", "plausible", "note", F.col("place.name").alias("place"), F.col("place.verbatim").alias("written"), F.col("place.kind").alias("place_kind"), "kind",
        w("verbatim", "weather"), w("value", "temperature"), w("unit", "unit"), w("precipitation", "precipitation"), w("sky", "sky"),
    )


@query(f"""WITH {_ORDERS}, {_SEEN}, p AS (SELECT entry, -2 AS ord, person AS name, NULL AS role FROM x WHERE k < 2 UNION ALL SELECT entry, -1, 'Dr S2', 'companion' FROM x WHERE k = 0
    UNION ALL SELECT entry, min(index), observer, 'source' FROM s WHERE observer IS NOT NULL AND observer <> 'Dr S2' GROUP BY entry, observer)
  SELECT entry, (row_number() OVER (PARTITION BY entry ORDER BY ord) - 1)::INT AS pos, name, role FROM p""")
def answer_persons(spark, sf_dir):
    """Persons an answer names and observers it names besides them."""
    return answers.persons(_parsed(spark, sf_dir))


@query(rf"""WITH {_ORDERS}, {_SEEN} SELECT entry, index::INT AS index, trim(v) AS vernacular, CASE m WHEN 0 THEN 'species' WHEN 1 THEN 'unknown' END AS rank, CASE WHEN m = 5 THEN 1.0 END::DOUBLE AS confidence, CASE WHEN m = 5 THEN true END AS is_bird,
    CASE m WHEN 0 THEN c WHEN 1 THEN least(c, 3) END::BIGINT AS count, CASE WHEN m = 1 THEN least(c, 3) END::BIGINT AS count_min, CASE WHEN m = 1 THEN greatest(c, 3) END::BIGINT AS count_max, CASE WHEN m = 1 THEN 'plural-unspecified' END AS qualifier,
    CASE WHEN m = 1 THEN 'absent' ELSE 'present' END AS status, CASE WHEN m = 0 THEN 'auditory/unknown,nest/' ELSE '' END AS evidence, CASE m WHEN 0 THEN 'third-party-report' WHEN 4 THEN 'literature-record' WHEN 5 THEN 'third-party-report' ELSE 'field-observation' END AS record_type,
    observer, CASE WHEN m = 4 THEN 'Orn. ' || c END AS citation, CASE WHEN m = 5 THEN o ELSE place END AS place, CASE WHEN m = 5 THEN 'region' END AS locality_kind,
    CASE WHEN m = 4 AND c BETWEEN 10 AND 28 THEN '1995-02-' || c ELSE strftime(dt, '%Y-%m-%d') END AS event_date, CASE WHEN m = 4 AND c < 24 THEN lpad(c::VARCHAR, 2, '0') || ':15' END AS event_time FROM s""")
def answer_observations(spark, sf_dir):
    """Items of the answers as observations."""
    o = answers.observations(_parsed(spark, sf_dir))
    evidence = F.array_join(F.transform("evidence", lambda e: F.concat(e["kind"], F.lit("/"), F.coalesce(e["call_type"], F.lit("")))), ",")
    return o.select(
        "entry", "index", "vernacular", "rank", "confidence", "is_bird", "count", "count_min", "count_max", "qualifier", "status", evidence.alias("evidence"), "record_type", "observer", "citation",
        F.col("place.name").alias("place"), F.col("locality.kind").alias("locality_kind"), "event_date", "event_time",
    )


@query(f"""WITH {_ORDERS}, l AS (SELECT entry, 0 AS event, 0 AS leg, 'S' AS departure, pl AS arrival, '' AS via, 'unknown' AS mode, NULL AS a, NULL AS b FROM x WHERE k = 0 UNION ALL SELECT entry, 0, 1, pl, 'Z', '', 'boat', NULL, NULL FROM x WHERE k = 0
    UNION ALL SELECT entry, 0, 0, pl, 'Y', 'V,' || person, 'train', CASE WHEN entry % 30 < 24 THEN strftime(d, '%Y-%m-%dT') || lpad((entry % 30)::VARCHAR, 2, '0') || ':15:00' END, CASE WHEN entry % 30 NOT BETWEEN 10 AND 23 THEN strftime(d, '%Y-%m-%dT09:30:00') END FROM x WHERE k = 1
    UNION ALL SELECT entry, 0, 0, 'A', 'B', '', 'unknown', NULL, NULL FROM x WHERE k = 2 UNION ALL SELECT entry, 2, 0, 'daheim', pl, '', 'unknown', NULL, NULL FROM x WHERE k = 2)
  SELECT entry, event, leg, departure, arrival, via, mode, a AS departure_time, b AS arrival_time FROM l""")
def answer_travel(spark, sf_dir):
    """Legs of the answers' journeys."""
    t = answers.travel(_parsed(spark, sf_dir))
    return t.select("entry", "event", "leg", "departure", "arrival", F.array_join("via", ",").alias("via"), "mode", "departure_time", "arrival_time")


def _name(prefix: str, name: str) -> str:
    return f"'{prefix}_' || substr(sha1(lower({name})), 1, 12)"


def _stated(prefix: str, rows: str, subject: str, statements: list[tuple[str, str, str]]) -> str:
    """SQL of the statements about each row."""
    cols = ", ".join(f"unnest([{', '.join(x)}]) AS {n}" for x, n in zip(zip(*[(f"'{p}'", f"({o})::VARCHAR", f"'{k}'") for p, o, k in statements]), ("p", "o", "kind")))
    return f"{prefix} AS (SELECT {subject} AS s, {cols} FROM {rows})"


_ENTRY = "'entry_' || entry"
_LINKS = [("dcterms:isPartOf", _ENTRY, "iri"), ("prov:wasDerivedFrom", _ENTRY, "iri")]
_OBS = [
    ("rdf:type", "'Observation'", "iri"), ("rdfs:label", "'Beobachtung ' || v", "@de"), ("observedTaxon", _name("taxon", "v"), "iri"), *_LINKS, ("verbatimNotes", "'Text'", "@de"),
    ("observedAt", _name("place", "CASE WHEN m = 5 THEN o ELSE place END"), "iri"), ("hasLocality", f"CASE WHEN m = 5 THEN {_name('place', 'o')} END", "iri"), ("dwc:verbatimLocality", "CASE WHEN m = 5 THEN o END", "string"),
    ("dwc:eventDate", "CASE WHEN m = 4 AND c BETWEEN 10 AND 28 THEN '1995-02-' || c ELSE strftime(dt, '%Y-%m-%d') END", "date"), ("dwc:eventTime", "CASE WHEN m = 4 AND c < 24 THEN lpad(c::VARCHAR, 2, '0') || ':15' END", "string"),
    ("dwc:occurrenceStatus", "CASE WHEN m = 1 THEN 'absent' ELSE 'present' END", "string"), ("dwc:individualCount", "CASE m WHEN 0 THEN c WHEN 1 THEN least(c, 3) END", "integer"), ("individualCountMin", "CASE WHEN m = 1 THEN least(c, 3) END", "integer"),
    ("individualCountMax", "CASE WHEN m = 1 THEN greatest(c, 3) END", "integer"), ("countQualifier", "CASE WHEN m = 1 THEN 'plural-unspecified' END", "string"),
    ("recordType", "CASE m WHEN 0 THEN 'third-party-report' WHEN 4 THEN 'literature-record' WHEN 5 THEN 'third-party-report' ELSE 'field-observation' END", "string"),
    ("dwc:basisOfRecord", "CASE WHEN m = 4 THEN 'MaterialCitation' ELSE 'HumanObservation' END", "string"), ("dwciri:recordedBy", _name("person", "CASE WHEN m = 1 THEN 'Schreiber' ELSE observer END"), "iri"),
    ("dwc:associatedReferences", "CASE WHEN m = 4 THEN 'Orn. ' || c END", "@de"), ("evidenceKind", "CASE WHEN m = 0 THEN 'evidence_auditory' END", "iri"), ("evidenceKind", "CASE WHEN m = 0 THEN 'evidence_nest' END", "iri"),
    ("hasVocalisation", "CASE WHEN m = 0 THEN 'vocalisation_' || uid || '_0' END", "iri"),
]
_CALL = [("rdf:type", "'Vocalisation'", "iri"), ("dcterms:isPartOf", "uid", "iri"), ("callType", "'unknown'", "string")]


@query(f"""WITH {_ORDERS}, {_SEEN}, u AS (SELECT *, 'obs_' || substr(sha1(entry || '|' || v || '|' || index), 1, 12) AS uid FROM s), {_stated('t', 'u', 'uid', _OBS)}, {_stated('k', '(FROM u WHERE m = 0)', "'vocalisation_' || uid || '_0'", _CALL)}
  SELECT DISTINCT * FROM (FROM t UNION ALL FROM k UNION ALL SELECT {_ENTRY}, 'containsObservation', uid, 'iri' FROM u) WHERE o IS NOT NULL""")
def observation_triples(spark, sf_dir):
    """What the graph states of the answers' observations."""
    return nodes.observations(answers.observations(_parsed(spark, sf_dir)), "Schreiber")


_EVENT = "'travel_' || entry || '_' || event"
_LEG = [
    ("rdf:type", "'TravelLeg'", "iri"), ("dcterms:isPartOf", _EVENT, "iri"), ("departurePlace", _name("place", "a"), "iri"), ("arrivalPlace", _name("place", "b"), "iri"), ("transportMode", "mode", "string"),
    ("departureTime", "CASE WHEN mode = 'train' AND entry % 30 < 24 THEN strftime(d, '%Y-%m-%dT') || lpad((entry % 30)::VARCHAR, 2, '0') || ':15:00' END", "dateTime"),
    ("arrivalTime", "CASE WHEN mode = 'train' AND entry % 30 NOT BETWEEN 10 AND 23 THEN strftime(d, '%Y-%m-%dT09:30:00') END", "dateTime"),
    ("viaPlace", "CASE WHEN mode = 'train' THEN 'place_' || substr(sha1('v'), 1, 12) END", "iri"), ("viaPlace", f"CASE WHEN mode = 'train' THEN {_name('place', 'person')} END", "iri"),
]


@query(f"""WITH {_ORDERS}, l AS (SELECT *, 0 AS event, 0 AS leg, 'S' AS a, pl AS b, 'unknown' AS mode FROM x WHERE k = 0 UNION ALL SELECT *, 0, 1, pl, 'Z', 'boat' FROM x WHERE k = 0 UNION ALL SELECT *, 0, 0, pl, 'Y', 'train' FROM x WHERE k = 1
    UNION ALL SELECT *, 0, 0, 'A', 'B', 'unknown' FROM x WHERE k = 2 UNION ALL SELECT *, 2, 0, 'daheim', pl, 'unknown' FROM x WHERE k = 2),
  {_stated('t', 'l', f"'leg_' || {_EVENT} || '_' || leg", _LEG)}, e AS (SELECT entry, event, count(*) AS n FROM l GROUP BY ALL),
  {_stated('v', 'e', _EVENT, [("rdf:type", "'TravelEvent'", "iri"), ("rdfs:label", "'Reise · ' || n || ' Etappe(n)'", "@de"), *_LINKS])}
  SELECT DISTINCT * FROM (FROM t UNION ALL FROM v UNION ALL SELECT {_ENTRY}, 'containsTravelEvent', {_EVENT}, 'iri' FROM e UNION ALL SELECT {_EVENT}, 'hasLeg', 'leg_' || {_EVENT} || '_' || leg, 'iri' FROM l) WHERE o IS NOT NULL""")
def travel_triples(spark, sf_dir):
    """What the graph states of the answers' journeys."""
    return nodes.journeys(answers.travel(_parsed(spark, sf_dir)))


_WEATHER = [
    ("rdf:type", "'WeatherReport'", "iri"), ("rdfs:label", "'Wetter ' || strftime(dt, '%Y-%m-%d')", "@de"), ("weatherVerbatim", "CASE k WHEN 0 THEN 'Wetter' WHEN 1 THEN 'Nebel' END", "@de"),
    ("temperatureValue", "CASE WHEN k = 0 AND entry % 200 - 100 BETWEEN -60 AND 60 THEN (entry % 200 - 100)::DOUBLE END", "decimal"), ("temperatureUnit", "CASE WHEN k = 0 AND entry % 200 - 100 BETWEEN -60 AND 60 THEN 'R' END", "string"),
    ("precipitation", "CASE WHEN k = 0 THEN 'none' END", "string"), ("skyCondition", "CASE WHEN k = 0 THEN 'overcast' END", "string"), *_LINKS,
]


@query(f"WITH {_ORDERS}, {_stated('t', '(FROM x WHERE k < 2)', "'weather_' || entry", _WEATHER)} SELECT * FROM (FROM t UNION ALL SELECT {_ENTRY}, 'hasWeather', 'weather_' || entry, 'iri' FROM x WHERE k < 2) WHERE o IS NOT NULL")
def weather_triples(spark, sf_dir):
    """What the graph states of the answers' weather."""
    return nodes.weather(answers.entry_fields(_parsed(spark, sf_dir)))


_MENTIONS = "CASE role WHEN 'source' THEN 'mentionsSource' WHEN 'companion' THEN 'mentionsCompanion' END"


@query(f"""WITH {_ORDERS}, {_SEEN}, p AS (SELECT entry, person AS name, NULL AS role FROM x WHERE k < 2 UNION ALL SELECT entry, 'Dr S2', 'companion' FROM x WHERE k = 0 UNION ALL SELECT DISTINCT entry, observer, 'source' FROM s WHERE observer IS NOT NULL AND observer <> 'Dr S2'),
  n AS (SELECT *, {_name('person', 'name')} AS s FROM p)
  SELECT DISTINCT s, 'rdf:type' AS p, 'Person' AS o, 'iri' AS kind FROM n UNION SELECT s, unnest(['rdfs:label', 'schema:name']), name, 'string' FROM n UNION SELECT {_ENTRY}, 'mentionsPerson', s, 'iri' FROM n UNION SELECT {_ENTRY}, {_MENTIONS}, s, 'iri' FROM n WHERE role IS NOT NULL""")
def person_triples(spark, sf_dir):
    """What the graph states of the persons in the answers, and which entries mention them how."""
    return nodes.persons(answers.persons(_parsed(spark, sf_dir)))


_ENTRY_NODE, _VOLUME, _PAGE, _REGION = "'entry_' || ord", "'volume_' || vol", "'page_' || pg", "'region_' || rg"
_OF_ENTRY = [
    ("rdf:type", "'DiaryEntry'", "iri"), ("rdfs:label", "'Tagebucheintrag ' || coalesce(verbatim, entry_date, 'o. D.') || ' · ' || place", "@de"), ("dcterms:identifier", "entry_uid", "string"), ("dwc:eventDate", "CASE WHEN entry_date_end IS NOT NULL THEN entry_date || '/' || entry_date_end END", "string"),
    ("dwc:eventDate", "CASE WHEN entry_date_end IS NULL THEN entry_date END", "date"), ("dwc:verbatimEventDate", "verbatim", "string"), ("datePlausible", "CASE WHEN ord % 4 > 0 THEN ord % 4 = 1 END", "boolean"), ("entryKind", "kind", "string"),
    ("entryPlace", _name("place", "CASE WHEN ord % 3 > 0 THEN place END"), "iri"), ("dwc:fieldNotes", "'Text ' || ord", "string"), ("dcterms:isPartOf", f"coalesce({_PAGE}, {_VOLUME})", "iri"), ("hasSourceRegion", _REGION, "iri"),
]
_OF_VOLUME = [("rdf:type", "'DiaryVolume'", "iri"), ("rdfs:label", "'Tagebuch · Band ' || vol", "@de"), ("dcterms:temporal", "CASE WHEN volume % 2 = 0 THEN '1990-0' || (volume % 9 + 1) || '/1995-12' END", "string")]
_OF_PAGE = [("rdf:type", "'DiaryPage'", "iri"), ("rdfs:label", "'Vol. ' || vol || CASE WHEN ord % 2 = 0 THEN ' · scan 0' || (volume % 10) ELSE '' END || ' (' || doc || ')'", "string"), ("dcterms:identifier", "doc", "string"), ("dcterms:isPartOf", _VOLUME, "iri")]
_OF_REGION = [("rdf:type", "'SourceRegion'", "iri"), ("rdfs:label", "'Region ' || rg", "string"), ("dcterms:isPartOf", _PAGE, "iri")]


@query(f"""WITH {ENTRIES}, e AS (SELECT *, lpad(volume::VARCHAR, 2, '0') AS vol, CASE WHEN ord % 5 > 0 THEN doc || '_' || volume || '_' || (ord % 2) END AS pg, CASE WHEN ord % 7 < 3 THEN (ord % 11)::VARCHAR || 'r' || (ord % 5) END AS rg, CASE WHEN ord % 6 = 0 THEN 'am ' || entry_date END AS verbatim FROM entries),
  {_stated('a', 'e', _ENTRY_NODE, _OF_ENTRY)}, {_stated('b', 'e', _VOLUME, _OF_VOLUME)}, {_stated('c', '(FROM e WHERE pg IS NOT NULL)', _PAGE, _OF_PAGE)}, {_stated('d', '(FROM e WHERE rg IS NOT NULL)', _REGION, _OF_REGION)}
  SELECT DISTINCT * FROM (FROM a UNION ALL FROM b UNION ALL FROM c UNION ALL FROM d) WHERE o IS NOT NULL""")
def entry_triples(spark, sf_dir):
    """What the graph states of entries, their volumes, pages and regions of pages; some entries have no page, some no region, some no place."""
    e, n = entries(spark, sf_dir), F.col("ord")
    return nodes.entries(e.select(
        n.alias("entry"), F.col("entry_uid").alias("entry_id"), "entry_date", "entry_date_end", F.when(n % 6 == 0, F.concat(F.lit("am "), F.col("entry_date"))).alias("verbatim_date"), F.when(n % 4 > 0, n % 4 == 1).alias("plausible"), F.lit(None).cast("string").alias("note"),
        "kind", F.when(n % 3 > 0, F.col("place")).alias("place"), F.col("place").alias("location_raw"), F.concat(F.lit("Text "), n.cast("string")).alias("text"), "volume", F.when(F.col("volume") % 2 == 0, F.concat(F.lit("1990-0"), (F.col("volume") % 9 + 1).cast("string"))).alias("start"),
        F.lit("1995-12").alias("end"), F.when(n % 5 > 0, F.concat_ws("_", "doc", F.col("volume").cast("string"), (n % 2).cast("string"))).alias("page_uid"), F.col("doc").alias("page_id"), F.when(n % 2 == 0, F.concat(F.lit("0"), (F.col("volume") % 10).cast("string"))).alias("scan"),
        F.when(n % 7 < 3, F.concat((n % 11).cast("string"), F.lit("r"), (n % 5).cast("string"))).alias("region_uid"),
    ), "Tagebuch")


_TAXON = [
    ("rdf:type", "'Taxon'", "iri"), ("rdfs:label", "v", "@de"), ("dwc:vernacularName", "v", "@de"), ("dwc:scientificName", "sci", "string"), ("skos:note", "CASE WHEN sci IS NULL THEN coalesce(note, 'wissenschaftlicher Name nicht aufgelöst') END", "@de"), ("dwc:taxonRank", "'species'", "string"),
    ("isBird", "k % 9 > 0", "boolean"), ("matchMethod", "method", "string"), ("gbifMatchType", "mt", "string"), ("dwc:taxonID", "CASE WHEN mt <> 'HIGHERRANK' THEN 'https://www.gbif.org/species/' || gbif END", "string"),
]


@query(f"""WITH x AS (SELECT *, p_partkey AS k FROM part), t AS (SELECT p_name || ' ' || k AS v, k, CASE WHEN k % 3 > 0 THEN p_brand END AS sci, CASE WHEN k % 2 = 0 THEN p_type END AS note, CASE WHEN k % 4 = 1 THEN 'llm+gbif' ELSE 'gbif' END AS method,
    CASE WHEN k % 3 > 0 THEN ['EXACT', 'FUZZY', 'HIGHERRANK'][k % 5 % 3 + 1] END AS mt, CASE WHEN k % 3 > 0 THEN k END AS gbif FROM x), {_stated('a', 't', _name('taxon', 'v'), _TAXON)},
  b AS (SELECT {_name('taxon', 'v')}, CASE WHEN mt = 'HIGHERRANK' THEN 'skos:broadMatch' WHEN method = 'llm+gbif' OR mt = 'FUZZY' THEN 'skos:closeMatch' ELSE 'skos:exactMatch' END, 'https://www.gbif.org/species/' || gbif, 'iri' FROM t)
  SELECT * FROM (FROM a UNION ALL FROM b) WHERE o IS NOT NULL""")
def taxon_triples(spark, sf_dir):
    """What the graph states of taxa and their links: parts, a third of them not resolved."""
    k, linked = F.col("p_partkey"), F.col("p_partkey") % 3 > 0
    p = table(spark, sf_dir, "part")
    return nodes.taxa(p.select(
        F.concat_ws(" ", "p_name", k.cast("string")).alias("vernacular"), F.when(linked, F.col("p_brand")).alias("scientific"), F.when(k % 2 == 0, F.col("p_type")).alias("note"), F.lit("species").alias("rank"), (k % 9 > 0).alias("is_bird"), F.when(k % 4 == 1, "llm+gbif").otherwise("gbif").alias("method"),
        F.lit(None).cast("double").alias("confidence"), F.when(linked, k).alias("gbif_key"), F.when(linked, F.element_at(F.array(*map(F.lit, ("EXACT", "FUZZY", "HIGHERRANK"))), (k % 5 % 3 + 1).cast("int"))).alias("match_type"), F.lit(None).cast("string").alias("iri"),
    ))


_PLACE = [
    ("rdf:type", "'Place'", "iri"), ("rdfs:label", "name", "@de"), ("dwc:verbatimLocality", "upper(name)", "string"), ("placeKind", "kind", "string"), ("geo:lat", "lat", "decimal"), ("geo:long", "lon", "decimal"),
    ("dwc:decimalLatitude", "lat", "decimal"), ("dwc:decimalLongitude", "lon", "decimal"), ("dwc:geodeticDatum", "CASE WHEN lat IS NOT NULL THEN 'WGS84' END", "string"),
]


@query(f"WITH p AS (SELECT s_name AS name, CASE WHEN s_suppkey % 4 > 0 THEN 'settlement' END AS kind, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 90 + 0.5::DOUBLE END AS lat, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 180 + 0.25::DOUBLE END AS lon FROM supplier), {_stated('a', 'p', _name('place', 'name'), _PLACE)} SELECT * FROM a WHERE o IS NOT NULL")
def place_triples(spark, sf_dir):
    """What the graph states of places: suppliers, a third of them without coordinates, each seen twice."""
    k = F.col("s_suppkey")
    at = lambda n, plus: F.when(k % 3 > 0, k % n + plus)
    p = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.upper("s_name").alias("verbatim"), F.when(k % 4 > 0, "settlement").alias("kind"), at(90, 0.5).alias("lat"), at(180, 0.25).alias("lon"))
    return nodes.places(p.union(p))


_CONCEPT = [("rdf:type", "'skos:Concept'", "iri"), ("rdfs:label", "h", "@de"), ("skos:prefLabel", "h", "@de"), ("skos:inScheme", "'habitatScheme'", "iri"), *[(f"skos:{m}Match", f"CASE WHEN coalesce(m, 'close') = '{m}' THEN iri END", "iri") for m in ("exact", "close", "broad")]]


@query(f"WITH p AS (SELECT p_type || ' ' || p_size AS h, CASE WHEN p_size % 4 > 0 THEN 'eunis:' || p_size END AS iri, ['exact', 'broad', NULL, 'other'][p_size % 4 + 1] AS m FROM part), {_stated('a', 'p', _name('habitat', 'h'), _CONCEPT)} SELECT DISTINCT * FROM a WHERE o IS NOT NULL")
def habitat_triples(spark, sf_dir):
    """What the graph states of habitats as shared concepts, with links to classes; a link of an unknown kind is left out."""
    k = F.col("p_size")
    kind = F.element_at(F.array(F.lit("exact"), F.lit("broad"), F.lit(None), F.lit("other")), (k % 4 + 1).cast("int"))
    return nodes.habitats(table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_type", k.cast("string")).alias("habitat"), F.when(k % 4 > 0, F.concat(F.lit("eunis:"), k.cast("string"))).alias("class_iri"), kind.alias("match")))
