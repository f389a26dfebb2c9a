"""Lookups, merges, decisions and checks of quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions.geo import km
from pageloom.functions.ids import name_id
from pageloom.operators import lookup
from pageloom.operators.graph import chain_ends
from pageloom.operators.qa import qa_flags, surviving
from pageloom.plans.model import BOTH, ENTRIES, entries, observations
from pageloom.plans.registry import query, table


@query(f"{BOTH} SELECT obs_uid, coalesce(s, 'unresolved') AS scientific FROM obs LEFT JOIN (SELECT 'Brand#' || i AS taxon, 'Sp. ' || i AS s FROM range(1, 15) t(i)) USING (taxon)")
def lookup_with_default(spark, sf_dir):
    names = spark.range(1, 15).select(F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("taxon"), F.concat(F.lit("Sp. "), F.col("id").cast("string")).alias("scientific"))
    return lookup.with_default(observations(spark, sf_dir).select("obs_uid", "taxon"), names, "taxon", {"scientific": F.lit("unresolved")}).select("obs_uid", "scientific")


@query("""WITH t AS (SELECT p_brand AS taxon, p_name AS name, p_type AS src FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1),
  s AS (SELECT p_brand AS taxon, min(p_name) AS name FROM part WHERE p_size > 25 GROUP BY 1),
  k AS (SELECT DISTINCT p_brand AS taxon FROM part UNION SELECT 'Brand#none')
  SELECT k.taxon, CASE WHEN src IN ('SMALL', 'LARGE') THEN t.name ELSE s.name END AS name,
    CASE WHEN src IN ('SMALL', 'LARGE') THEN 'table:' || src WHEN s.name IS NOT NULL THEN 'seed' ELSE 'unresolved' END AS method,
    CASE WHEN t.taxon IS NOT NULL AND src NOT IN ('SMALL', 'LARGE') THEN 'source=' || src || '; unconfirmed' END AS note
  FROM k LEFT JOIN t USING (taxon) LEFT JOIN s USING (taxon)""")
def lookup_with_fallback(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("taxon"), F.col("p_name").alias("name"), F.col("p_type").alias("src"), "p_partkey", "p_size")
    first = lookup.first_per_key(p, "taxon", "p_partkey")
    seed = p.filter("p_size > 25").groupBy("taxon").agg(F.min("name").alias("name"))
    keys = p.select("taxon").distinct().union(spark.range(1).select(F.lit("Brand#none")))
    return lookup.with_fallback(keys, first, seed, "taxon", "src", ["SMALL", "LARGE"])


@query("""SELECT o_custkey AS name, count(*) AS uses FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) GROUP BY 1 ORDER BY uses DESC, name LIMIT 40""")
def uncached_within_budget(spark, sf_dir):
    uses = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("name")).agg(F.count("*").alias("uses"))
    cache = table(spark, sf_dir, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("name"))
    return lookup.within_budget(uses, cache, "name", "uses", 40)


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS entry, 'k' || (l_suppkey % 40) AS key, 'f' || (l_suppkey % 10) AS surname, l_suppkey::VARCHAR AS observer FROM lineitem),
  p AS (SELECT DISTINCT l_orderkey AS entry, l_partkey::VARCHAR AS name, 'k' || (l_partkey % 40) AS key, 'f' || (l_partkey % 10) AS surname FROM lineitem),
  x AS (SELECT entry, key, min(name) AS e FROM p GROUP BY ALL), u AS (SELECT entry, surname, min(name) AS o FROM p GROUP BY ALL HAVING count(DISTINCT name) = 1)
  SELECT entry, observer, coalesce(e, o, observer) AS person, coalesce(e, o) IS NULL AS is_new FROM m LEFT JOIN x USING (entry, key) LEFT JOIN u USING (entry, surname)""")
def observers_to_persons(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")

    def named(c: str, to: str):
        mod = lambda p, k: F.concat(F.lit(p), (F.col(c) % k).cast("string"))
        return li.select(F.col("l_orderkey").alias("entry"), F.col(c).cast("string").alias(to), mod("k", 40).alias("key"), mod("f", 10).alias("surname")).distinct()

    return lookup.resolve_observers(named("l_suppkey", "observer"), named("l_partkey", "name"))


_ROWS = """rows AS (SELECT 'nation: ' || n_name || ' -> ' || r_name AS merge_id, n_name AS variant, r_name AS canonical, CASE WHEN n_nationkey % 2 = 0 THEN 'auto' ELSE 'candidate' END AS status,
    n_nationkey AS k FROM nation JOIN region ON n_regionkey = r_regionkey),
  dec AS (SELECT merge_id, ['Yes', ' no ', 'keep', 'accept', ''][k % 5 + 1] AS decision FROM rows WHERE k % 3 <> 0),
  ok AS (SELECT variant, canonical FROM rows LEFT JOIN dec USING (merge_id) WHERE CASE WHEN status = 'auto' THEN lower(trim(coalesce(decision, ''))) NOT IN ('n', 'no', '0', 'reject', 'keep', 'separate')
    ELSE lower(trim(coalesce(decision, ''))) IN ('y', 'yes', 'merge', '1', 'accept') END)"""


def _merges(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("nation: "), "n_name", F.lit(" -> "), "r_name").alias("merge_id"), F.col("n_name").alias("variant"), F.col("r_name").alias("canonical"),
        F.when(F.col("n_nationkey") % 2 == 0, "auto").otherwise("candidate").alias("status"), F.col("n_nationkey").alias("k"),
    )
    said = F.element_at(F.array(*map(F.lit, ("Yes", " no ", "keep", "accept", ""))), F.col("k") % 5 + 1)
    return lookup.applied(rows, rows.filter("k % 3 <> 0").select("merge_id", said.alias("decision"))).select("variant", "canonical")


@query(f"WITH {_ROWS} SELECT * FROM ok")
def merge_decisions(spark, sf_dir):
    return _merges(spark, sf_dir)


@query(f"WITH {ENTRIES}, {_ROWS} SELECT coalesce(canonical, place) AS place, count(*) AS n FROM entries LEFT JOIN ok ON place = variant GROUP BY 1")
def references_repointed(spark, sf_dir):
    e = entries(spark, sf_dir).select("place")
    return lookup.repoint(e, _merges(spark, sf_dir), "place").groupBy("place").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE m AS (SELECT s_suppkey AS v, s_suppkey // 3 AS c FROM supplier WHERE s_suppkey >= 3),
  w(v, c) AS (SELECT v, c FROM m UNION SELECT w.v, m.c FROM w JOIN m ON w.c = m.v) SELECT v AS variant, min(c) AS canonical FROM w GROUP BY v""")
def chains_followed(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").filter("s_suppkey >= 3")
    return chain_ends(s.select(F.col("s_suppkey").alias("variant"), F.floor(F.col("s_suppkey") / 3).alias("canonical")))


@query("""WITH old AS (SELECT (c_custkey % 50)::VARCHAR AS id, c_custkey AS at_, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS decision FROM customer),
  k AS (SELECT id, arg_min(decision, at_) AS d FROM old WHERE decision <> '' GROUP BY id)
  SELECT n_nationkey::VARCHAR AS id, n_name AS label, coalesce(d, '') AS decision FROM nation LEFT JOIN k ON id = n_nationkey::VARCHAR""")
def review_carry_over(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 50).cast("string").alias("id"), "c_custkey", F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("decision"))
    new = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("label"), F.lit("").alias("decision"))
    return lookup.carry_decisions(new, old, "id", "c_custkey")


@query("""WITH c AS (SELECT s_suppkey AS id, s_nationkey AS key, 47 + (s_suppkey % 100) / 30 AS lat, 9 + s_nationkey / 4 AS lon, ['P', 'A', 'S'][(s_suppkey % 3 + 1)::INT] AS cls, s_acctbal AS pop FROM supplier),
  p AS (SELECT n_nationkey AS key, 48.5 AS la, 9 + n_nationkey / 4 AS lo FROM nation),
  d AS (SELECT p.key, id, 2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(la)) / 2), 2) + cos(radians(la)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(lo)) / 2), 2))) AS km, cls, pop FROM p JOIN c USING (key))
  SELECT key, id, round(km, 6) AS km FROM d WHERE km <= 100 QUALIFY row_number() OVER (PARTITION BY key ORDER BY CASE cls WHEN 'P' THEN 0 WHEN 'A' THEN 1 ELSE 5 END, km, -pop, id) = 1""")
def nearest_record_within_radius(spark, sf_dir):
    c = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("key"), (47 + (F.col("s_suppkey") % 100) / 30).alias("lat"), (9 + F.col("s_nationkey") / 4).alias("lon"),
        F.element_at(F.array(*map(F.lit, "PAS")), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("cls"), F.col("s_acctbal").alias("pop"),
    )
    p = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.lit(48.5).alias("la"), (9 + F.col("n_nationkey") / 4).alias("lo"))
    d = p.join(c, "key").withColumn("km", km(F.col("la"), F.col("lo"), F.col("lat"), F.col("lon"))).filter("km <= 100")
    rank = F.when(F.col("cls") == "P", 0).when(F.col("cls") == "A", 1).otherwise(5)
    return lookup.best(d, ["key"], rank, F.col("km"), -F.col("pop"), F.col("id")).select("key", "id", F.round("km", 6).alias("km"))


def _flagged(spark, sf_dir):
    e = entries(spark, sf_dir).withColumn("header_date", F.when(F.col("ord") % 5 == 0, F.lit("1999-01-01")).otherwise(F.col("entry_date"))).withColumn("plausible", F.col("ord") % 13 != 0)
    e = e.withColumn("location_raw", F.when(F.col("lat").isNull(), F.col("place"))).withColumn("place", F.when(F.col("lat").isNotNull(), F.col("place"))).withColumn("explained", F.col("volume") % 2 == 0)
    o = observations(spark, sf_dir).withColumn("is_bird", F.col("count") % 10 != 0).withColumn("confidence", F.col("count") / 50).withColumn("conflict", F.col("count") == 7)
    return e, o


@query(f"""{BOTH}, e AS (SELECT *, CASE WHEN ord % 5 = 0 THEN '1999-01-01' ELSE entry_date END AS header FROM entries),
  y AS (SELECT volume, entry_date[1:4]::INT AS year, row_number() OVER (PARTITION BY volume ORDER BY entry_date[1:4]::INT) - 1 AS k, count(*) OVER (PARTITION BY volume) AS n FROM entries WHERE entry_date IS NOT NULL),
  m AS (SELECT volume, year AS median FROM y WHERE k = n // 2),
  left_ AS (SELECT entry_uid, count(*) AS c FROM obs WHERE count % 10 <> 0 AND NOT (family IS NULL AND count / 50 < 0.3) GROUP BY 1),
  f AS (SELECT 'implausible_date' AS reason, 'excluded' AS action FROM e WHERE ord % 13 = 0
    UNION ALL SELECT 'date_corrected', 'flagged' FROM e WHERE ord % 13 <> 0 AND header <> entry_date
    UNION ALL SELECT 'misdate', 'flagged' FROM e JOIN m USING (volume) WHERE entry_date IS NOT NULL AND NOT entry_date[1:4]::INT BETWEEN median - 2 AND median + 2
    UNION ALL SELECT 'nonplace', 'flagged' FROM e WHERE lat IS NULL
    UNION ALL SELECT 'non_bird', 'excluded' FROM obs JOIN e USING (entry_uid) WHERE count % 10 = 0
    UNION ALL SELECT 'low_confidence_taxon', 'excluded' FROM obs JOIN e USING (entry_uid) WHERE count % 10 <> 0 AND family IS NULL AND count / 50 < 0.3
    UNION ALL SELECT 'record_type_conflict', 'flagged' FROM obs JOIN e USING (entry_uid) WHERE count = 7 AND NOT (family IS NULL AND count / 50 < 0.3)
    UNION ALL SELECT CASE WHEN volume % 2 = 0 THEN 'no_observations' ELSE 'empty' END, 'flagged' FROM e LEFT JOIN left_ USING (entry_uid) WHERE c IS NULL)
  SELECT reason, action, count(*) AS n FROM f GROUP BY ALL""")
def qa_summary(spark, sf_dir):
    return qa_flags(*_flagged(spark, sf_dir)).groupBy("reason", "action").agg(F.count("*").alias("n"))


@query(f"WITH {ENTRIES} SELECT entry_uid FROM entries WHERE ord % 13 <> 0")
def qa_survivors(spark, sf_dir):
    e, o = _flagged(spark, sf_dir)
    return surviving(e, qa_flags(e, o)).select("entry_uid")


@query("SELECT c_name AS name, 'person_' || substr(sha1(lower(c_name)), 1, 12) AS uid FROM customer")
def name_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), name_id("person", F.col("c_name")).alias("uid"))


@query("""WITH ev AS (SELECT l_orderkey % 500 AS entry, p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey), l AS (SELECT DISTINCT entry, name FROM ev),
  a AS (SELECT l.name, l.entry, o.name AS anchor FROM l JOIN l o ON l.entry = o.entry AND l.name <> o.name)
  SELECT name, count(DISTINCT entry) AS n_entries, count(DISTINCT anchor) AS n_anchors FROM a GROUP BY name""")
def context_anchors(spark, sf_dir):
    ev = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select((F.col("l_orderkey") % 500).alias("entry"), F.col("p_brand").alias("name"))
    return lookup.context_anchors(ev, "entry", "name")
