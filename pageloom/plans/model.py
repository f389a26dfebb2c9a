"""The driver's tables read as a diary: orders are entries, line items observations, parts taxa, nations places, customers persons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.ids import content_id, observation_id
from pageloom.plans.registry import table


def day(c: str, plus: int = 0):
    return F.date_format(F.date_add(F.to_date(c), plus), "yyyy-MM-dd")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    dated = F.col("o_orderstatus") != "P"
    kind = F.element_at(F.array(*map(F.lit, ("field-day", "correspondence", "other", "species-digest", "retrospective"))), F.substring("o_orderpriority", 1, 1).cast("int"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        content_id("e", F.col("o_orderkey")).alias("entry_uid"), F.col("o_orderkey").alias("ord"), (F.col("o_custkey") % 34).cast("int").alias("volume"),
        F.when(dated, day("o_orderdate")).alias("entry_date"), F.when(dated & (F.col("o_orderkey") % 7 == 0), day("o_orderdate", 2)).alias("entry_date_end"),
        kind.alias("kind"), F.col("n_name").alias("place"), F.col("c_name").alias("person"), F.lower("c_mktsegment").alias("role"),
        F.when(F.col("n_nationkey") % 3 != 0, 47 + F.col("n_nationkey") / 8).alias("lat"), F.when(F.col("n_nationkey") % 3 != 0, 9 + F.col("n_nationkey") / 4).alias("lon"),
        F.concat(F.lit("doc"), (F.col("o_custkey") % 97).cast("string")).alias("doc"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation"))
    # every column follows from these, so equal rows go before the joins and the id is made only where it is asked for
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("l_quantity"), "l_returnflag", "l_linestatus").distinct()
    joined = li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    uid = content_id("e", F.col("l_orderkey"))
    key = F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").cast("string"), "l_returnflag", "l_linestatus")
    return joined.select(
        observation_id(uid, F.lit(None).cast("string"), F.col("p_brand"), key).alias("obs_uid"), uid.alias("entry_uid"), F.col("l_linenumber").alias("pos"), F.col("p_brand").alias("taxon"),
        F.when(F.col("p_size") % 5 != 0, F.lower("p_type")).alias("family"), F.col("l_quantity").cast("int").alias("count"),
        F.when(F.col("l_returnflag") == "R", "absent").otherwise("present").alias("status"), F.when(F.col("l_linestatus") == "O", "auditory").otherwise("visual").alias("evidence"),
        F.when(F.col("l_partkey") % 3 == 0, "song").alias("call"), F.when(F.col("l_suppkey") % 2 == 0, F.col("n_name")).alias("locality"), F.col("s_name").alias("observer"),
        F.element_at(F.split("p_name", " "), 2).alias("habitat"),
    )


ENTRIES = """entries AS (
  SELECT 'e_' || substr(sha1('hog-v1' || chr(31) || o_orderkey), 1, 12) AS entry_uid, o_orderkey AS ord, (o_custkey % 34)::INT AS volume,
    CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS entry_date,
    CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 7 = 0 THEN strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') END AS entry_date_end,
    ['field-day', 'correspondence', 'other', 'species-digest', 'retrospective'][o_orderpriority[1:1]::INT] AS kind,
    n_name AS place, c_name AS person, lower(c_mktsegment) AS role,
    CASE WHEN n_nationkey % 3 <> 0 THEN 47 + n_nationkey / 8 END AS lat, CASE WHEN n_nationkey % 3 <> 0 THEN 9 + n_nationkey / 4 END AS lon,
    'doc' || (o_custkey % 97) AS doc
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

OBSERVATIONS = """obs AS (
  SELECT DISTINCT 'obs_' || substr(sha1(uid || '|' || p_brand || '|' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::INT || '-' || l_returnflag || '-' || l_linestatus), 1, 12) AS obs_uid, uid AS entry_uid,
    l_linenumber AS pos, p_brand AS taxon, CASE WHEN p_size % 5 <> 0 THEN lower(p_type) END AS family, l_quantity::INT AS count,
    CASE WHEN l_returnflag = 'R' THEN 'absent' ELSE 'present' END AS status, CASE WHEN l_linestatus = 'O' THEN 'auditory' ELSE 'visual' END AS evidence,
    CASE WHEN l_partkey % 3 = 0 THEN 'song' END AS call, CASE WHEN l_suppkey % 2 = 0 THEN n_name END AS locality, s_name AS observer, split_part(p_name, ' ', 2) AS habitat
  FROM (SELECT *, 'e_' || substr(sha1('hog-v1' || chr(31) || l_orderkey), 1, 12) AS uid FROM lineitem)
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""
BOTH = f"WITH {ENTRIES}, {OBSERVATIONS}"
