"""Merges of spellings over the driver's names."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions.text import fold
from pageloom.operators.persons import resolve_persons
from pageloom.operators.resolve import group_merges, inherit
from pageloom.plans.registry import query, table

_NAMES = """n AS (SELECT p_name AS name, lower(p_name) AS key, count(*) AS uses FROM part GROUP BY ALL UNION ALL SELECT upper(p_name), lower(p_name), count(*) FROM part WHERE p_size > 25 GROUP BY ALL)"""


def _names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    both = p.select(F.col("p_name").alias("name")).union(p.filter("p_size > 25").select(F.upper("p_name")))
    return both.groupBy("name").agg(F.count("*").alias("uses")).withColumn("key", fold(F.col("name")))


@query(f"WITH {_NAMES}, b AS (SELECT key, name AS canonical FROM n QUALIFY row_number() OVER (PARTITION BY key ORDER BY uses DESC, name DESC) = 1) SELECT name AS variant, canonical, uses AS n_variant FROM n JOIN b USING (key) WHERE name <> canonical")
def merges_by_key(spark, sf_dir):
    return group_merges(_names(spark, sf_dir), "key", "fold").select("variant", "canonical", "n_variant")


@query(f"WITH {_NAMES} SELECT key, arg_min(CASE WHEN uses % 2 = 0 THEN uses END, CASE WHEN uses % 2 = 0 THEN (-uses, name) END) AS value FROM n GROUP BY key")
def inherited_attributes(spark, sf_dir):
    n = _names(spark, sf_dir).withColumn("value", F.when(F.col("uses") % 2 == 0, F.col("uses")))
    return inherit(n, "key", "value")


_FORMS = ("Adolf ", "A. ", "", "Karl ", "Dr. Karl ", "Frau ", "K. A. ", "Adolf Karl ", "K. ", "Dr. ", "Alois ")

#: Initials in the order of the names: each step sees the uses that those before it have brought to a full name.
_INITIALS = ("A. ", "K. A. ", "K. ")


def _initial_step(i: int) -> str:
    grown = "".join(f" + coalesce((SELECT sum(h.own_u) FROM hit{j} h WHERE h.c = fit.c), 0)" for j in range(i))
    return f"""rank{i} AS (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY u DESC, c) AS r, lead(u) OVER (w ORDER BY u DESC, c) AS second FROM (SELECT l1, own_u, ini, c, base{grown} AS u FROM fit WHERE form = '{_INITIALS[i]}') WINDOW w AS (PARTITION BY l1)),
  hit{i} AS (SELECT l1, own_u, c, CASE WHEN n = 1 THEN 'initial-unique' ELSE 'dominant' END AS rule FROM rank{i} WHERE r = 1 AND (n = 1 OR (u >= 5 AND u >= 5 * greatest(second, 1)))),"""


_PERSONS = f"""p AS (SELECT {list(_FORMS)}[(c_custkey * 7 + c_nationkey) % {len(_FORMS)} + 1] || 'Nam' || translate((c_custkey // 7 % 60)::VARCHAR, '0123456789', 'abcdefghij') AS name FROM customer),
  n AS (SELECT name, count(*) AS uses, list_filter(string_split(replace(lower(regexp_replace(name, '^Dr\\. ', '')), '.', ''), ' '), lambda x: x <> '') AS t FROM p GROUP BY name),
  k AS (SELECT name, uses, array_to_string(t, ' ') AS key, t[1] = 'frau' AS gendered, t[-1] AS surname, list_filter(t[:-2], lambda x: length(x) = 1) AS ini, list_filter(t[:-2], lambda x: length(x) > 1 AND x <> 'frau') AS firsts FROM n),
  c1 AS (SELECT *, min(name) OVER (PARTITION BY key) AS l1, sum(uses) OVER (PARTITION BY key) AS u1 FROM k),
  fit AS (SELECT DISTINCT a.l1, a.ini, a.u1 AS own_u, regexp_extract(a.name, '^([AK][.] )+') AS form, b.l1 AS c, b.u1 AS base FROM c1 a JOIN c1 b ON a.surname = b.surname AND len(a.ini) > 0 AND len(a.firsts) = 0 AND len(b.firsts) > 0 AND NOT b.gendered
    AND len(list_filter(a.ini, lambda i: len(list_filter(b.firsts, lambda f: starts_with(f, i))) = 0)) = 0),
  {" ".join(map(_initial_step, range(len(_INITIALS))))}
  rank_ini AS ({" UNION ALL ".join(f"SELECT * FROM rank{i}" for i in range(len(_INITIALS)))}), hit_ini AS ({" UNION ALL ".join(f"SELECT * FROM hit{i}" for i in range(len(_INITIALS)))}),
  c3 AS (SELECT c1.*, coalesce(hit_ini.c, c1.l1) AS l3 FROM c1 LEFT JOIN hit_ini USING (l1)), s3 AS (SELECT l3, sum(uses) AS u3, max(len(firsts)) > 0 AS full_ FROM c3 GROUP BY l3),
  bare AS (SELECT DISTINCT surname, l3 AS own FROM c3 WHERE len(ini) = 0 AND len(firsts) = 0 AND NOT gendered), other AS (SELECT DISTINCT b.surname, b.own, c3.l3 AS c, u3 AS u FROM bare b JOIN c3 ON c3.surname = b.surname AND NOT gendered AND c3.l3 <> b.own JOIN s3 ON s3.l3 = c3.l3),
  rank4 AS (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY u DESC, c) AS r, lead(u) OVER (w ORDER BY u DESC, c) AS second FROM other WINDOW w AS (PARTITION BY surname)),
  hit4 AS (SELECT own, c, CASE WHEN n = 1 THEN 'surname-unique' ELSE 'dominant' END AS rule FROM rank4 WHERE r = 1 AND (n = 1 OR (u >= 5 AND u >= 5 * greatest(second, 1)))),
  c4 AS (SELECT c3.*, coalesce(hit4.c, c3.l3) AS l4 FROM c3 LEFT JOIN hit4 ON l3 = own),
  ruled AS (SELECT c4.*, CASE WHEN h4.own IS NOT NULL AND name = (SELECT min(x.name) FROM c3 x WHERE x.l3 = h4.own) THEN h4.rule WHEN h3.l1 IS NOT NULL AND name = c4.l1 THEN h3.rule WHEN name <> c4.l1 THEN 'same-key' END AS rule
    FROM c4 LEFT JOIN hit4 h4 ON h4.own = c4.l3 LEFT JOIN hit_ini h3 ON h3.l1 = c4.l1),
  best AS (SELECT *, first_value(name) OVER b AS canonical, first_value(uses) OVER b AS n_canonical, first_value(rule) OVER b AS theirs, sum(uses) OVER (PARTITION BY l4) AS cu, max(len(firsts)) OVER (PARTITION BY l4) > 0 AS full_ FROM ruled
    WINDOW b AS (PARTITION BY l4 ORDER BY gendered, list_contains(string_split(key, ' '), 'frau'), len(firsts) DESC, length(array_to_string(firsts, '')) + len(ini) DESC, uses DESC, length(name), name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  open_ AS (SELECT l1 AS own, c, 'initial-ambiguous' AS rule, 'initials ' || array_to_string(ini, '') || ' match several full names' AS detail FROM rank_ini WHERE l1 NOT IN (SELECT l1 FROM hit_ini)
    UNION ALL SELECT own, c, 'surname-ambiguous', 'bare surname; ' || n || ' persons share it' FROM rank4 WHERE own NOT IN (SELECT own FROM hit4))"""


@query(rf"""WITH {_PERSONS} SELECT name AS variant, canonical, coalesce(rule, theirs, 'same-key') AS rule, 'auto' AS status, uses::BIGINT AS n_variant, n_canonical::BIGINT AS n_canonical, '' AS detail FROM best WHERE name <> canonical
  UNION ALL SELECT a.canonical, b.canonical, o.rule, 'candidate', a.cu::BIGINT, b.cu::BIGINT, o.detail FROM open_ o JOIN best a ON a.name = o.own JOIN best b ON b.name = o.c WHERE a.l4 <> b.l4 AND NOT a.full_""")
def person_name_merges(spark, sf_dir):
    """Customers as persons: full names, initials, bare surnames, titles and forms of address, by every rule that needs no authority id."""
    c = table(spark, sf_dir, "customer")
    form = F.element_at(F.array(*map(F.lit, _FORMS)), ((F.col("c_custkey") * 7 + F.col("c_nationkey")) % len(_FORMS) + 1).cast("int"))
    surname = F.concat(F.lit("Nam"), F.translate((F.floor(F.col("c_custkey") / 7) % 60).cast("string"), "0123456789", "abcdefghij"))
    return resolve_persons(c.groupBy(F.concat(form, surname).alias("name")).agg(F.count("*").alias("uses"))).rows
