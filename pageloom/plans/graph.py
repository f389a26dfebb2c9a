"""Triples from tables, patterns over them, constraints and closures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.geo import wkt_point
from pageloom.operators import constraints as c
from pageloom.operators import graph as g
from pageloom.plans.model import ENTRIES, entries
from pageloom.plans.registry import query, table
from pageloom.sinks.graph import jsonld, ntriples, read_ntriples


def _triples(spark, sf_dir) -> DataFrame:
    e = entries(spark, sf_dir)
    place = lambda name: F.concat(F.lit("place/"), F.lower(name))
    of_entries = (e, F.concat(F.lit("entry/"), "entry_uid"), [
        (c.TYPE, F.lit("Entry"), "iri"), ("volume", F.col("volume"), "integer"), ("eventDate", F.col("entry_date"), "date"), ("kind", F.col("kind"), "string"), ("entryPlace", place(F.col("place")), "iri"),
        ("endDate", F.col("entry_date_end"), "date"), ("label", F.col("person"), "@de"),
    ])
    of_places = (e.select("place", "lat", "lon").distinct(), place(F.col("place")), [(c.TYPE, F.when(F.col("lat").isNotNull(), "Place"), "iri"), ("label", F.col("place"), "@de"), ("point", wkt_point(F.col("lat"), F.col("lon")), "wkt")])
    return g.triple_set(of_entries, of_places)


_TRIPLES = f"""WITH {ENTRIES}, t AS (
  SELECT 'entry/' || entry_uid AS s, unnest(['rdf:type', 'volume', 'eventDate', 'kind', 'entryPlace', 'endDate', 'label']) AS p,
    unnest(['Entry', volume::VARCHAR, entry_date, kind, 'place/' || lower(place), entry_date_end, person]) AS o, unnest(['iri', 'integer', 'date', 'string', 'iri', 'date', '@de']) AS kind FROM entries
  UNION ALL SELECT DISTINCT 'place/' || lower(place), 'label', place, '@de' FROM entries
  UNION ALL SELECT DISTINCT 'place/' || lower(place), 'rdf:type', 'Place', 'iri' FROM entries WHERE lat IS NOT NULL
  UNION ALL SELECT DISTINCT 'place/' || lower(place), 'point', 'POINT(' || lon || ' ' || lat || ')', 'wkt' FROM entries WHERE lat IS NOT NULL),
  g AS (SELECT DISTINCT * FROM t WHERE o IS NOT NULL)"""


@query(f"{_TRIPLES} SELECT * FROM g")
def triples_from_tables(spark, sf_dir):
    return _triples(spark, sf_dir)


@query(f"{_TRIPLES} SELECT p, kind, count(*) AS n FROM g GROUP BY ALL")
def triples_round_trip(spark, sf_dir):
    """Written as lines and read back."""
    return read_ntriples(ntriples(_triples(spark, sf_dir))).groupBy("p", "kind").agg(F.count("*").alias("n"))


@query(f"""{_TRIPLES}, v AS (SELECT s, p, list(o ORDER BY o) AS v FROM g GROUP BY ALL)
  SELECT '{{"@id":["' || s || '"],' || string_agg('"' || p || '":["' || array_to_string(v, '","') || '"]', ',' ORDER BY p) || '}}' AS value FROM v GROUP BY s""")
def graph_objects(spark, sf_dir):
    return jsonld(_triples(spark, sf_dir))


@query(f"{_TRIPLES} SELECT l.o AS place, count(*) AS n, count(q.o) AS n_located FROM g e JOIN g l ON e.o = l.s AND l.p = 'label' LEFT JOIN g q ON q.s = e.o AND q.p = 'point' WHERE e.p = 'entryPlace' GROUP BY 1")
def pattern_with_optional(spark, sf_dir):
    t = _triples(spark, sf_dir)
    of = lambda p, s, o: t.filter(F.col("p") == p).select(F.col("s").alias(s), F.col("o").alias(o))
    joined = of("entryPlace", "entry", "at").join(of("label", "at", "place"), "at").join(of("point", "at", "point"), "at", "left")
    return joined.groupBy("place").agg(F.count("*").alias("n"), F.count("point").alias("n_located"))


#: Of some entries: an end before the start, a second date, a place that is text; the class below names only entries as such.
_BROKEN = """b AS (SELECT * FROM g UNION ALL SELECT s, 'eventDate', '1890-01-01', 'date' FROM g WHERE p = 'volume' AND o = '3' UNION ALL SELECT s, 'endDate', '1900-01-01', 'date' FROM g WHERE p = 'volume' AND o IN ('5', '6')
  UNION ALL SELECT s, 'entryPlace', 'am Weiher', 'string' FROM g WHERE p = 'volume' AND o = '7')"""


def _broken(spark, sf_dir):
    t = g.settled(_triples(spark, sf_dir))
    of = lambda *volumes: t.filter((F.col("p") == "volume") & F.col("o").isin(*volumes)).select("s")
    add = lambda rows, p, o, kind: rows.select("s", F.lit(p).alias("p"), F.lit(o).alias("o"), F.lit(kind).alias("kind"))
    return t.union(add(of("3"), "eventDate", "1890-01-01", "date")).union(add(of("5", "6"), "endDate", "1900-01-01", "date")).union(add(of("7"), "entryPlace", "am Weiher", "string"))


@query(f"""{_TRIPLES}, {_BROKEN}, f AS (SELECT s FROM b WHERE p = 'rdf:type' AND o = 'Entry'), n AS (SELECT f.s, count_if(p = 'eventDate') AS dates FROM f JOIN b USING (s) GROUP BY f.s), v AS (
  SELECT 'Violation' AS severity, 'eventDate' AS path, CASE WHEN dates < 1 THEN 'minCount' ELSE 'maxCount' END AS "constraint" FROM n WHERE dates <> 1
  UNION ALL SELECT 'Warning', 'kind', 'in' FROM b WHERE p = 'kind' AND o NOT IN ('field-day', 'correspondence', 'species-digest')
  UNION ALL SELECT 'Violation', 'entryPlace', 'class' FROM b WHERE p = 'entryPlace' AND o NOT IN (SELECT s FROM b WHERE p = 'rdf:type' AND o = 'Place')
  UNION ALL SELECT 'Violation', 'entryPlace', 'nodeKind' FROM b WHERE p = 'entryPlace' AND kind <> 'iri'
  UNION ALL SELECT 'Warning', 'volume', 'maxInclusive' FROM b WHERE p = 'volume' AND o::INT > 30
  UNION ALL SELECT 'Warning', 'label', 'pattern' FROM b WHERE p = 'label' AND s IN (SELECT s FROM f) AND NOT regexp_matches(o, '[02468]$')
  UNION ALL SELECT 'Violation', 'kind', 'hasValue' FROM f WHERE s NOT IN (SELECT s FROM b WHERE p = 'kind' AND o = 'field-day')
  UNION ALL SELECT 'Info', 'eventDate|endDate', 'or' FROM f WHERE s NOT IN (SELECT s FROM b WHERE p IN ('eventDate', 'endDate'))
  UNION ALL SELECT 'Violation', 'eventDate|endDate', 'order' FROM b x JOIN b y ON x.s = y.s AND x.p = 'eventDate' AND y.p = 'endDate' WHERE y.o <= x.o)
  SELECT severity, path, "constraint", count(*) AS n, CASE severity WHEN 'Violation' THEN 0 WHEN 'Warning' THEN 1 ELSE 2 END AS rank FROM v GROUP BY ALL""")
def constraint_report(spark, sf_dir):
    shape = c.Shape("Entry").cardinality(["eventDate"], 1, 1).values("kind", F.col("o").isin("field-day", "correspondence", "species-digest"), "in", "Warning").object_class("entryPlace", "Place")
    shape = shape.values("volume", F.col("o").try_cast("int") <= 30, "maxInclusive", "Warning").values("label", F.col("o").rlike("[02468]$"), "pattern", "Warning").values("entryPlace", F.col("kind") == "iri", "nodeKind")
    shape = shape.has_value("kind", "field-day").any_path(["eventDate", "endDate"], "Info").not_after("eventDate", "endDate").cardinality(["point"], 0, 0)
    return shape.report(_broken(spark, sf_dir))


@query(f"{_TRIPLES}, r AS (SELECT s, p, CASE WHEN kind = 'iri' AND o LIKE 'place/nation_1%' THEN 'place/merged' ELSE o END AS o, kind FROM g), r2 AS (SELECT DISTINCT CASE WHEN s LIKE 'place/nation_1%' THEN 'place/merged' ELSE s END AS s, p, o, kind FROM r) SELECT p, kind, count(*) AS n FROM r2 GROUP BY ALL")
def graph_rewrite(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("place/"), F.lower("n_name")).alias("variant")).filter("variant like 'place/nation_1%'").withColumn("canonical", F.lit("place/merged"))
    return g.rewrite(_triples(spark, sf_dir), n).groupBy("p", "kind").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE up(code, ancestor, distance) AS (SELECT c_custkey, c_custkey // 4, 1 FROM customer WHERE c_custkey > 0
  UNION ALL SELECT code, ancestor // 4, distance + 1 FROM up WHERE ancestor > 0) SELECT code, ancestor, distance FROM up""")
def code_ancestors(spark, sf_dir):
    tree = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 4)).alias("parent"))
    return g.ancestors(tree)


def _rounds(n: int) -> str:
    """Labels after n rounds of spreading and jumping, more than the edges of the oracle's tables need."""
    out = ["e0 AS (SELECT DISTINCT l_orderkey AS x, 1000000000 + l_suppkey * 1000 + l_orderkey % 97 AS y FROM lineitem), e AS MATERIALIZED (SELECT x, y FROM e0 UNION ALL SELECT y, x FROM e0)"]
    out.append("l0 AS MATERIALIZED (SELECT x AS node, least(x, min(y)) AS c FROM e GROUP BY x)")
    for i in range(n):
        near = f"SELECT x, min(c) AS c FROM e JOIN l{i} ON y = node GROUP BY x"
        out.append(f"m{i} AS MATERIALIZED (SELECT node, least(l.c, n.c) AS c FROM l{i} l JOIN ({near}) n ON x = node), l{i + 1} AS MATERIALIZED (SELECT a.node, least(a.c, b.c) AS c FROM m{i} a JOIN m{i} b ON a.c = b.node)")
    return f"WITH {', '.join(out)} SELECT node, c AS component FROM l{n}"


@query(_rounds(9))
def components_of_edges(spark, sf_dir):
    """Orders joined by a supplier within a class of orders."""
    li = table(spark, sf_dir, "lineitem")
    return g.components(li.select(F.col("l_orderkey").alias("a"), (1000000000 + F.col("l_suppkey") * 1000 + F.col("l_orderkey") % 97).alias("b")))


@query(f"{_TRIPLES} SELECT s, p FROM g WHERE kind LIKE '@%' AND kind <> '@en' EXCEPT SELECT s, p FROM g WHERE s LIKE 'place/%'")
def language_filter(spark, sf_dir):
    t = _triples(spark, sf_dir)
    named = t.filter(F.col("kind").startswith("@") & (F.col("kind") != "@en")).select("s", "p")
    return named.subtract(t.filter(F.col("s").startswith("place/")).select("s", "p"))
