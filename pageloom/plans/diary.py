"""The competency questions and the aggregates of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import aggregates as agg
from pageloom.plans.model import BOTH, ENTRIES, entries, observations
from pageloom.plans.registry import query, table
from pageloom.sinks.archive import event_date


@query(f"{BOTH} SELECT taxon, count(*) AS n FROM obs GROUP BY taxon ORDER BY n DESC, taxon")
def cq1_species_frequency(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("taxon").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "taxon")


@query(f"""{BOTH} SELECT CASE WHEN entry_date_end <> entry_date THEN entry_date || '/' || entry_date_end ELSE entry_date END AS date, count(*) AS n
  FROM entries JOIN obs USING (entry_uid) WHERE entry_date IS NOT NULL GROUP BY 1 ORDER BY 1""")
def cq2_observations_by_date(spark, sf_dir):
    e = entries(spark, sf_dir).filter("entry_date is not null").select("entry_uid", event_date(F.col("entry_date"), F.col("entry_date_end")).alias("date"))
    return observations(spark, sf_dir).join(e, "entry_uid").groupBy("date").agg(F.count("*").alias("n")).orderBy("date")


@query(f"{BOTH} SELECT coalesce(locality, place) AS place, taxon, count(*) AS n FROM obs JOIN entries USING (entry_uid) GROUP BY ALL")
def cq3_observations_at_place(spark, sf_dir):
    joined = observations(spark, sf_dir).join(entries(spark, sf_dir).select("entry_uid", "place"), "entry_uid")
    return joined.groupBy(F.coalesce("locality", "place").alias("place"), "taxon").agg(F.count("*").alias("n"))


@query(f"{BOTH} SELECT obs_uid, taxon, call AS call_type FROM obs WHERE evidence = 'auditory'")
def cq4_auditory(spark, sf_dir):
    return observations(spark, sf_dir).filter("evidence = 'auditory'").select("obs_uid", "taxon", F.col("call").alias("call_type"))


@query(f"{BOTH} SELECT DISTINCT taxon || '/' || observer || '/' || count AS name FROM obs o WHERE NOT EXISTS (SELECT 1 FROM obs f WHERE f.taxon = o.taxon AND f.observer = o.observer AND f.count = o.count AND f.family IS NOT NULL)")
def cq5_unresolved(spark, sf_dir):
    obs = observations(spark, sf_dir)
    kind = ["taxon", "observer", "count"]
    named = obs.filter("family is not null").select(*kind).distinct()
    return obs.select(*kind).distinct().join(named, kind, "left_anti").select(F.concat_ws("/", *kind).alias("name"))


@query(f"{BOTH} SELECT obs_uid, entry_date, doc AS page, volume FROM obs JOIN entries USING (entry_uid) WHERE entry_date IS NOT NULL ORDER BY obs_uid LIMIT 25")
def cq6_provenance(spark, sf_dir):
    e = entries(spark, sf_dir).filter("entry_date is not null").select("entry_uid", "entry_date", F.col("doc").alias("page"), "volume")
    return observations(spark, sf_dir).join(e, "entry_uid").select("obs_uid", "entry_date", "page", "volume").orderBy("obs_uid").limit(25)


@query(f"{BOTH} SELECT obs_uid, coalesce(locality, place) AS effective, locality AS own, place AS entry_place FROM obs LEFT JOIN entries USING (entry_uid)")
def cq7_own_locality(spark, sf_dir):
    joined = observations(spark, sf_dir).join(entries(spark, sf_dir).select("entry_uid", "place"), "entry_uid", "left")
    return joined.select("obs_uid", F.coalesce("locality", "place").alias("effective"), F.col("locality").alias("own"), F.col("place").alias("entry_place"))


@query(f"{BOTH} SELECT obs_uid, taxon, entry_date, locality FROM obs JOIN entries USING (entry_uid) WHERE status = 'absent' AND entry_date IS NOT NULL")
def cq8_absences(spark, sf_dir):
    e = entries(spark, sf_dir).filter("entry_date is not null").select("entry_uid", "entry_date")
    return observations(spark, sf_dir).filter("status = 'absent'").join(e, "entry_uid").select("obs_uid", "taxon", "entry_date", "locality")


@query(f"{BOTH} SELECT family, count(*) AS n FROM obs WHERE family IS NOT NULL GROUP BY family")
def cq9_by_family(spark, sf_dir):
    return observations(spark, sf_dir).filter("family is not null").groupBy("family").agg(F.count("*").alias("n"))


@query(f"{BOTH} SELECT habitat, string_agg(DISTINCT taxon, ', ' ORDER BY taxon) AS taxa, count(*) AS n FROM obs GROUP BY habitat")
def cq10_taxa_by_habitat(spark, sf_dir):
    return observations(spark, sf_dir).groupBy("habitat").agg(agg.distinct_join("taxon").alias("taxa"), F.count("*").alias("n"))


@query(f"WITH {ENTRIES} SELECT person, role, count(DISTINCT entry_uid) AS n FROM entries WHERE role IN ('building', 'furniture') GROUP BY person, role")
def cq11_persons_by_role(spark, sf_dir):
    e = entries(spark, sf_dir).filter(F.col("role").isin("building", "furniture"))
    return e.groupBy("person", "role").agg(F.count_distinct("entry_uid").alias("n"))


@query(f"""WITH {ENTRIES}, counted AS (SELECT doc, volume, count(*) AS n, min(ord) AS f FROM entries GROUP BY doc, volume)
  SELECT doc, volume, n FROM counted QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n DESC, f) = 1""")
def mode_first_seen(spark, sf_dir):
    return agg.mode_first(entries(spark, sf_dir), "doc", "volume", "ord").select("doc", "volume", "n")


@query(f"""WITH {ENTRIES}, y AS (SELECT volume, entry_date[1:4]::INT AS year FROM entries WHERE entry_date IS NOT NULL),
  r AS (SELECT volume, year, row_number() OVER (PARTITION BY volume ORDER BY year) - 1 AS at_, count(*) OVER (PARTITION BY volume) AS n FROM y)
  SELECT volume, year AS median FROM r WHERE at_ = n // 2""")
def upper_median_per_group(spark, sf_dir):
    e = entries(spark, sf_dir).select("volume", F.substring("entry_date", 1, 4).cast("int").alias("year"))
    return agg.upper_median(e, "volume", "year")


@query("""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) - 1 AS at_, count(*) OVER (PARTITION BY user_id) AS n FROM events)
  SELECT user_id, max(value) FILTER (at_ = floor(n * 0.02)) AS low, max(value) FILTER (at_ = least(n - 1, floor(n * (1 - 0.02)))) AS high FROM r GROUP BY user_id""")
def rank_percentiles(spark, sf_dir):
    return agg.tail_ranks(table(spark, sf_dir, "events"), "user_id", "value")


@query("""WITH f AS (SELECT user_id, event_type, min(event_id) AS o FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o) AS k FROM f)
  SELECT user_id, string_agg(event_type, '; ' ORDER BY k) AS notes FROM r WHERE k <= 3 GROUP BY user_id""")
def first_distinct_notes(spark, sf_dir):
    return agg.first_distinct(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@query("SELECT user_id, string_agg(event_type, ';' ORDER BY event_id) AS media FROM events GROUP BY user_id")
def ordered_list(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(agg.ordered_join("event_id", "event_type", ";").alias("media"))


@query(f"""WITH {ENTRIES} SELECT volume, min(entry_date) AS first, max(greatest(entry_date, coalesce(entry_date_end, entry_date))) AS last, min(lat) AS south, max(lat) AS north, min(lon) AS west, max(lon) AS east
  FROM entries GROUP BY volume""")
def coverage_and_bounding_box(spark, sf_dir):
    last = F.greatest("entry_date", F.coalesce("entry_date_end", "entry_date"))
    return entries(spark, sf_dir).groupBy("volume").agg(
        F.min("entry_date").alias("first"), F.max(last).alias("last"), F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"),
    )


@query(f"""{BOTH}, u AS (SELECT place AS name, 'entry' AS r FROM entries UNION ALL SELECT locality, 'own' FROM obs WHERE locality IS NOT NULL)
  SELECT name, count(*) FILTER (r = 'entry') AS n_entry, count(*) FILTER (r = 'own') AS n_own, count(*) AS uses FROM u GROUP BY name""")
def usage_by_role(spark, sf_dir):
    return agg.usage((entries(spark, sf_dir), "place", "entry"), (observations(spark, sf_dir), "locality", "own"))


@query("SELECT event_type AS kind, key, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS key FROM events) GROUP BY ALL")
def key_census(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), "props")
    return agg.key_census(e, "kind", "props")


@query(f"""WITH {ENTRIES} SELECT volume, count(*) AS n, round(100.0 * count(entry_date) / count(*), 1)::DOUBLE AS pct_dated, round(100.0 * count(lat) / count(*), 1)::DOUBLE AS pct_located,
  count(*) FILTER (kind = 'other') AS n_other FROM entries GROUP BY volume""")
def coverage_report(spark, sf_dir):
    pct = lambda c: F.round(F.lit(100.0) * F.count(c) / F.count("*"), 1)
    return entries(spark, sf_dir).groupBy("volume").agg(F.count("*").alias("n"), pct("entry_date").alias("pct_dated"), pct("lat").alias("pct_located"), F.count_if(F.col("kind") == "other").alias("n_other"))


@query(f"""{BOTH} SELECT taxon, round(avg((family IS NOT NULL)::INT), 6) AS family, round(avg((call IS NOT NULL)::INT), 6) AS call, round(avg((locality IS NOT NULL)::INT), 6) AS locality FROM obs GROUP BY taxon""")
def fill_rates(spark, sf_dir):
    return agg.fill_rates(observations(spark, sf_dir), "taxon", ["family", "call", "locality"])


@query(f"WITH {ENTRIES} SELECT doc, count(DISTINCT volume) AS n_groups FROM entries GROUP BY doc HAVING count(DISTINCT volume) > 1")
def keys_in_several_groups(spark, sf_dir):
    return agg.in_several(entries(spark, sf_dir), "doc", "volume")


@query("SELECT l_orderkey || '-' || l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"))
    return agg.duplicate_keys(li, "key")


@query(f"""{BOTH}, a AS (SELECT taxon, count(*) AS n FROM obs WHERE evidence = 'auditory' AND status = 'absent' AND call IS NOT NULL GROUP BY 1),
  b AS (SELECT taxon, count(*) AS n FROM obs WHERE evidence = 'visual' AND habitat = 'bolt' GROUP BY 1)
  SELECT taxon, coalesce(a.n, 0) AS n_first, coalesce(b.n, 0) AS n_second FROM a FULL JOIN b USING (taxon)""")
def compare_backends(spark, sf_dir):
    obs = observations(spark, sf_dir)
    a = obs.filter("evidence = 'auditory' and status = 'absent' and call is not null").groupBy("taxon").agg(F.count("*").alias("n_first"))
    b = obs.filter("evidence = 'visual' and habitat = 'bolt'").groupBy("taxon").agg(F.count("*").alias("n_second"))
    return a.join(b, "taxon", "full_outer").select("taxon", F.coalesce("n_first", F.lit(0)).alias("n_first"), F.coalesce("n_second", F.lit(0)).alias("n_second"))
