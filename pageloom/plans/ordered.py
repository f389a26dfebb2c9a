"""Order-sensitive operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.operators import ordered, scan
from pageloom.operators.graph import settled
from pageloom.plans.model import ENTRIES, entries
from pageloom.plans.registry import query, table


@query("""SELECT conv_id, turn, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off,
  max(CASE WHEN role <> 'assistant' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header FROM conversations""")
def stream_offsets_and_last_header(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.length("text") + 2).alias("n"), F.when(F.col("role") != "assistant", F.col("turn")).alias("h"))
    found = scan.scanned(c, "conv_id", ["turn"], off=scan.running_sum(F.col("n"), own=False), header=scan.last_value(F.col("h")))
    return found.select("conv_id", "turn", "off", "header")


@query("""WITH n AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS seq FROM conversations),
  s AS (SELECT conv_id, seq, min(turn) AS start, count(*) AS n_rows, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS body FROM n WHERE seq > 0 GROUP BY ALL)
  SELECT 'L' || lpad(conv_id::VARCHAR, 6, '0') || '-e' || lpad(seq::VARCHAR, 4, '0') AS entry_id, start, n_rows, md5(body) AS body, length(body)::BIGINT AS n_chars FROM s""")
def segment_by_header(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    s = ordered.segments(c, "conv_id", "turn", F.col("role") == "user", "text")
    name = F.concat(F.lit("L"), F.lpad(F.col("conv_id").cast("string"), 6, "0"), F.lit("-e"), F.lpad(F.col("seq").cast("string"), 4, "0"))
    return s.select(name.alias("entry_id"), "start", "n_rows", F.md5("body").alias("body"), F.col("n_chars").cast("long").alias("n_chars"))


@query("""WITH v AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events WHERE event_type = 'click'),
  e AS (SELECT e.user_id, e.event_id, count(v.k) AS before, max((v.event_id = e.event_id)::INT) AS own FROM events e LEFT JOIN v ON v.user_id = e.user_id AND v.event_id < e.event_id + 1 GROUP BY ALL),
  p AS (SELECT user_id, event_id, before - coalesce(own, 0) AS b, before AS a FROM e)
  SELECT p.user_id, p.event_id, concat_ws(',', p1.event_id, p2.event_id, n1.event_id, n2.event_id) AS near FROM p
  LEFT JOIN v p1 ON p1.user_id = p.user_id AND p1.k = b LEFT JOIN v p2 ON p2.user_id = p.user_id AND p2.k = b - 1
  LEFT JOIN v n1 ON n1.user_id = p.user_id AND n1.k = a + 1 LEFT JOIN v n2 ON n2.user_id = p.user_id AND n2.k = a + 2""")
def nearest_valid_neighbours(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).alias("v"))
    near = ordered.with_valid_neighbours(e, "v", "user_id", "event_id", 2, "near")
    return near.select("user_id", "event_id", F.array_join("near", ",").alias("near"))


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d') END AS d FROM events),
  w AS (SELECT *, coalesce(max(d) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '2024-01-01') AS a,
    coalesce(min(d) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '2024-01-31') AS b FROM e)
  SELECT user_id, event_id, least(a, b) AS start, greatest(a, b) AS "end" FROM w""")
def positional_interval(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd")).alias("d"))
    return ordered.with_interval(e, "d", F.lit("2024-01-01"), F.lit("2024-01-31"), "user_id", "event_id", "i").select("user_id", "event_id", "i.start", "i.end")


def repaired(spark, sf_dir):
    e = entries(spark, sf_dir).select("ord", "volume", "entry_date", "kind")
    # volumes run over two years each, those of the order, so that every entry has one; one entry in nine is dated a century early, one in eleven decades late
    first = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), (F.floor(F.year("o_orderdate") / 2) * 2).cast("int").alias("first"))
    e = e.join(first, "ord").withColumn("volume", F.col("first") * 100 + F.col("volume"))
    year = F.substring("entry_date", 1, 4).cast("int")
    wrong = F.when(F.col("ord") % 9 == 0, year - 100).when(F.col("ord") % 11 == 0, year + 38).otherwise(year)
    e = e.withColumn("entry_date", F.concat(wrong.cast("string"), F.substring("entry_date", 5, 6)))
    e = e.withColumn("at", F.row_number().over(Window.partitionBy("volume").orderBy(F.substring("entry_date", 6, 5), "ord"))).drop("ord").withColumnRenamed("at", "ord")
    e = e.withColumn("verbatim", F.concat(F.substring("entry_date", 9, 2), F.lit(". "), F.substring("entry_date", 6, 2), F.lit(". "), F.substring("entry_date", 1, 4))).withColumn("historic", F.col("volume") % 2 == 0)
    e = settled(e)  # read for the spans, to find the ranges and to deal them out
    spans = e.select("volume", "first").distinct().select("volume", F.concat(F.col("first").cast("string"), F.lit("-01")).alias("start"), F.concat((F.col("first") + 1).cast("string"), F.lit("-12")).alias("end"))
    e = e.drop("first")
    return ordered.repair_years(e, spans)


#: The nearest valid dates on both sides, a vote of their years, and the routes of what lies outside its volume's span.
_REPAIR = f"""WITH {ENTRIES}, f AS (SELECT e.* EXCLUDE (volume), year(o_orderdate) // 2 * 2 AS first, year(o_orderdate) // 2 * 200 + e.volume AS volume FROM entries e JOIN orders ON o_orderkey = ord),
  d AS (SELECT volume, first, kind, ord, entry_date[5:] AS md, CASE WHEN ord % 9 = 0 THEN entry_date[1:4]::INT - 100 WHEN ord % 11 = 0 THEN entry_date[1:4]::INT + 38 ELSE entry_date[1:4]::INT END AS y FROM f),
  r AS (SELECT volume, first, kind, y::VARCHAR || md AS dt, volume % 2 = 0 AS historic, row_number() OVER (PARTITION BY volume ORDER BY substr(y::VARCHAR || md, 6, 5) NULLS FIRST, ord) AS ord FROM d),
  m AS (SELECT *, dt[1:4]::INT * 12 + dt[6:7]::INT AS mi, first * 12 + 1 AS lo, (first + 1) * 12 + 12 AS hi, first || '-01-01' AS d0, (first + 1) || '-12-31' AS d1, min(first) OVER () || '-01' AS all0, (max(first) OVER () + 1) * 12 + 12 AS all1 FROM r),
  i AS (SELECT *, coalesce(mi BETWEEN lo - 1 AND hi + 1, false) AS inside FROM m), v AS (SELECT volume, ord, dt, row_number() OVER (PARTITION BY volume ORDER BY ord) AS k FROM i WHERE inside),
  b AS (SELECT *, sum(inside::INT) OVER (PARTITION BY volume ORDER BY ord ROWS UNBOUNDED PRECEDING) AS upto FROM i), n AS (SELECT b.*, p1.dt AS p1, p2.dt AS p2, n1.dt AS n1, n2.dt AS n2 FROM b
    LEFT JOIN v p1 ON p1.volume = b.volume AND p1.k = upto - inside::INT LEFT JOIN v p2 ON p2.volume = b.volume AND p2.k = upto - inside::INT - 1 LEFT JOIN v n1 ON n1.volume = b.volume AND n1.k = upto + 1 LEFT JOIN v n2 ON n2.volume = b.volume AND n2.k = upto + 2),
  w AS (SELECT *, list_filter([p1, p2, n1, n2], lambda x: x IS NOT NULL) AS near FROM n), y AS (SELECT *, list_transform(near, lambda x: x[1:4]) AS ys FROM w),
  t AS (SELECT *, list_max(list_transform(ys, lambda a: len(list_filter(ys, lambda c: c = a)))) AS votes FROM y), u AS (SELECT *, list_filter(ys, lambda a: len(list_filter(ys, lambda c: c = a)) = votes)[1] AS year FROM t),
  z AS (SELECT *, year || dt[5:] AS fix, dt[1:7] < all0 AS early FROM u),
  q AS (SELECT *, early OR mi > all1 + 1 AS outside, len(near) > 0 AND votes >= least(2, len(near)) AND NOT (early AND kind IN ('species-digest', 'retrospective') AND historic)
      AND (dt[1:1] <> year[1:1])::INT + (dt[2:2] <> year[2:2])::INT + (dt[3:3] <> year[3:3])::INT + (dt[4:4] <> year[4:4])::INT <= 2 AND try_cast(fix AS DATE) IS NOT NULL AND fix[1:4]::INT * 12 + fix[6:7]::INT BETWEEN lo - 1 AND hi + 1
      AND len(list_filter(near, lambda x: abs(fix[1:4]::INT * 12 + fix[6:7]::INT - x[1:4]::INT * 12 - x[6:7]::INT) > 3)) = 0 AS fixed FROM z),
  s AS (SELECT *, CASE WHEN dt IS NULL OR inside THEN NULL WHEN coalesce(fixed, false) THEN 'date_year_corrected' WHEN outside AND kind = 'other' THEN 'date_out_of_span' WHEN outside THEN 'date_from_position' ELSE 'date_out_of_coverage' END AS reason FROM q),
  o AS (SELECT *, CASE reason WHEN 'date_year_corrected' THEN fix WHEN 'date_from_position' THEN least(coalesce(p1, d0), coalesce(n1, d1)) ELSE dt END AS new_date FROM s)
  SELECT volume, reason, count(*) AS n, min(new_date) AS first, max(new_date) AS last FROM o GROUP BY ALL"""


@query(_REPAIR)
def year_repair(spark, sf_dir):
    return repaired(spark, sf_dir).groupBy("volume", "reason").agg(F.count("*").alias("n"), F.min("new_date").alias("first"), F.max("new_date").alias("last"))


@query("""WITH legs AS (SELECT l_orderkey AS event, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS pos,
    CASE WHEN l_partkey % 2 = 0 THEN 'p' || l_partkey END AS departure, CASE WHEN l_suppkey % 3 <> 0 THEN 's' || l_suppkey END AS arrival, CASE WHEN l_orderkey % 4 = 0 THEN 'home' END AS place FROM lineitem),
  a AS (SELECT *, arrival IS NOT NULL AND max((arrival IS NOT NULL AND (departure IS NOT NULL OR place IS NOT NULL))::INT) OVER (PARTITION BY event ORDER BY pos ROWS UNBOUNDED PRECEDING) = 1 AS alive FROM legs),
  b AS (SELECT *, last_value(CASE WHEN alive THEN arrival END IGNORE NULLS) OVER (PARTITION BY event ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM a)
  SELECT event, pos, coalesce(departure, prev, place) AS departure, arrival FROM b WHERE alive""")
def travel_departures(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    name = lambda p, c, ok: F.when(ok, F.concat(F.lit(p), F.col(c).cast("string")))
    legs = li.select(
        F.col("l_orderkey").alias("event"), F.row_number().over(w).alias("pos"), name("p", "l_partkey", F.col("l_partkey") % 2 == 0).alias("departure"),
        name("s", "l_suppkey", F.col("l_suppkey") % 3 != 0).alias("arrival"), F.when(F.col("l_orderkey") % 4 == 0, "home").alias("entry_place"),
    )
    return ordered.travel_departures(legs).select("event", "pos", "departure", "arrival")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def first_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return ordered.first_wins(e, ["user_id", "event_type"], "event_id")


@query("""WITH u AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k, lead(n, 1, 0) OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS nx FROM u)
  SELECT user_id, event_type, n FROM r WHERE k = 1 AND n >= 5 AND n >= 1.2 * greatest(nx, 1)""")
def dominant_member(spark, sf_dir):
    u = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return ordered.dominant(u, "user_id", "event_type", "n", 5, 1.2)


@query(f"WITH {ENTRIES} SELECT volume, ord, 'L' || lpad(volume::VARCHAR, 2, '0') || '-e' || lpad(row_number() OVER (PARTITION BY volume ORDER BY ord)::VARCHAR, 5, '0') AS entry_id FROM entries")
def entry_sequence(spark, sf_dir):
    e = scan.scanned(entries(spark, sf_dir).select("volume", "ord"), "volume", ["ord"], i=scan.running_sum(F.lit(1), own=False))
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return e.select("volume", "ord", F.concat(F.lit("L"), pad(F.col("volume"), 2), F.lit("-e"), pad(F.col("i") + 1, 5)).alias("entry_id"))
