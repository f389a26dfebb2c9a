"""Scalar functions over real columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import dates, geo, ids, names, text, vocab
from pageloom.plans.registry import query, table


@query("""SELECT doc_id, 'p_' || substr(sha1('hog-v1' || chr(31) || source || chr(31) || doc_id), 1, 12) AS uid,
  sha256('["' || source || '", "' || lang || '"]') AS response_key FROM documents""")
def content_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", ids.content_id("p", F.col("source"), F.col("doc_id")).alias("uid"), ids.response_key(F.col("source"), F.col("lang")).alias("response_key"))


@query(r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)</?(?:u|sup|sub|b|i|em|strong)\s*>', '', 'g'), '([\pL\pN_])-[ \t]*\n+[ \t]*([a-zäöüß])', '\1\2', 'g'), '\s*\n+\s*', ' ', 'g'), '[ \t]{2,}', ' ', 'g'))) AS clean FROM pages""")
def strip_markup(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_markup(F.col("html"))).alias("clean"))


@query(r"""WITH f AS (SELECT doc_id, replace(replace(replace(replace(lower(text), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss') AS t, lower(trim(text, ' ')) AS g FROM documents)
  SELECT doc_id, md5(trim(regexp_replace(regexp_replace(replace(replace(t, 'st. ', 'sankt '), 'st.', 'sankt '), '[^\pL\pN_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS key,
  md5(trim(regexp_replace(replace(replace(replace(strip_accents(g), 'ß', 'ss'), 'æ', 'ae'), 'ø', 'o'), '[^a-z0-9]+', ' ', 'g'))) AS gazetteer FROM f""")
def fold_keys(spark, sf_dir):
    whole = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.fold(whole)).alias("key"), F.md5(text.fold_gazetteer(whole)).alias("gazetteer"))


def _case(value: str, vocabulary, cues) -> str:
    """The SQL of ordered cues."""
    inside = ", ".join(f"'{v}'" for v in vocabulary)
    whens = " ".join("WHEN " + " OR ".join(f"contains({value}, '{c}')" for c in words) + f" THEN '{term}'" for term, words in cues)
    return f"CASE WHEN {value} = '' THEN NULL WHEN {value} IN ({inside}) THEN {value} {whens} END"


_PHRASES = ["Schneeregen am Abend", "kein Regen", "Regen, kein Wind", "trocken", "FOG", "ohne jeden Schnee", "heiter bis wolkig", "bedeckt", "", "mit dem Kraftwagen", "zu Fuß", "Eisenbahn", "Bericht von Müller", "Literatur", "own", "clear", "train", "Dampfer"]
_PHRASE_SQL = "[" + ", ".join(f"'{p}'" for p in _PHRASES) + "]"


@query(f"""WITH v AS (SELECT event_id, lower(trim({_PHRASE_SQL}[event_id % {len(_PHRASES)} + 1])) AS x FROM events)
  SELECT event_id, {_case("x", vocab.SKY_CONDITIONS, vocab.SKY_CUES)} AS sky, {_case("x", vocab.RECORD_TYPES, vocab.RECORD_TYPE_CUES)} AS record,
  coalesce({_case("x", vocab.TRANSPORT_MODES, vocab.TRANSPORT_CUES)}, 'unknown') AS mode,
  CASE WHEN x IN ('kein regen', 'ohne jeden schnee') THEN 'none' ELSE {_case("x", vocab.PRECIPITATION_TYPES, vocab.PRECIPITATION_CUES)} END AS rain FROM v""")
def cue_fold(spark, sf_dir):
    said = F.element_at(F.array(*map(F.lit, _PHRASES)), (F.col("event_id") % len(_PHRASES) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", vocab.sky(said).alias("sky"), vocab.record_type(said).alias("record"), vocab.transport_mode(said).alias("mode"), vocab.precipitation(said).alias("rain"))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') THEN replace(lower(o_orderpriority), ' ', '-') END AS enum FROM orders")
def enum_membership(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", vocab.enum(F.col("o_orderpriority"), ("1-urgent", "2-high", "4-not-specified")).alias("enum"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS norm, strftime(o_orderdate, '%Y-%m-%d') AS german, CASE WHEN day(o_orderdate) > 12 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS swapped,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 5 MONTH, '%Y-%m') AS earlier, abs((year(o_orderdate) - 1998) * 12 + month(o_orderdate) - 3)::INT AS months FROM orders""")
def date_parsing(spark, sf_dir):
    months = list(dates.GERMAN_MONTHS)
    name = F.element_at(F.array(*[F.lit([m for m in months if dates.GERMAN_MONTHS[m] == k][0]) for k in range(1, 13)]), F.month("o_orderdate"))
    roman = F.element_at(F.array(*map(F.lit, dates.ROMAN)), F.month("o_orderdate"))
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    swapped = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-"), F.date_format("o_orderdate", "dd"), F.lit("-"), F.date_format("o_orderdate", "MM"))
    back = F.concat(F.left(swapped, F.lit(5)), F.right(swapped, F.lit(2)), F.lit("-"), F.substring(swapped, 6, 2))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.header_date(F.concat_ws(" ", F.concat(F.dayofmonth("o_orderdate").cast("string"), F.lit(".")), F.upper(roman), F.year("o_orderdate").cast("string")))["date_norm"].alias("norm"),
        dates.german_date(F.concat(F.dayofmonth("o_orderdate").cast("string"), F.lit(". "), F.initcap(name), F.lit(" "), F.year("o_orderdate").cast("string"))).alias("german"),
        F.when(dates.iso_or_null(swapped).isNotNull(), back).alias("swapped"), dates.add_months(iso, -5).alias("earlier"), dates.months_between(iso, F.lit("1998-03")).alias("months"),
    )


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, CASE WHEN json_extract_string(props, '$.k')::BIGINT >= 50 THEN json_extract_string(props, '$.k')::BIGINT END AS big,
  least(1.0, greatest(0.0, json_extract_string(props, '$.k')::DOUBLE / 40)) AS share FROM events""")
def json_fields(spark, sf_dir):
    k = F.get_json_object(text.json_body(F.concat(F.lit("answer: "), "props", F.lit(" end"))), "$.k")
    return table(spark, sf_dir, "events").select("event_id", vocab.as_int(k).alias("k"), vocab.as_int(k, 50).alias("big"), vocab.as_share((k.cast("double") / 40).cast("string")).alias("share"))


@query(r"""SELECT c_custkey, 'customer ' || lpad(c_custkey::VARCHAR, 9, '0') AS key, lpad(c_custkey::VARCHAR, 9, '0') AS surname, 'customer' AS firsts FROM customer""")
def person_keys(spark, sf_dir):
    titled = F.concat(F.element_at(F.array(*map(F.lit, ("Prof. Dr. ", "Herr ", "Forstmeister ", ""))), (F.col("c_custkey") % 4 + 1).cast("int")), "c_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", names.person_key(titled).alias("key"))
    parts = names.person_parts(F.col("key"))
    return c.select("c_custkey", "key", parts["surname"].alias("surname"), F.array_join(parts["firsts"], " ").alias("firsts"))


@query("""SELECT s_suppkey, round(2 * 6371.0 * asin(sqrt(pow(sin((radians(s_nationkey) - radians(48.5)) / 2), 2) + cos(radians(48.5)) * cos(radians(s_nationkey)) * pow(sin((radians(s_suppkey % 90) - radians(9.0)) / 2), 2))), 6) AS km FROM supplier""")
def great_circle(spark, sf_dir):
    lat, lon = F.col("s_nationkey").cast("double"), (F.col("s_suppkey") % 90).cast("double")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(geo.km(F.lit(48.5), F.lit(9.0), lat, lon), 6).alias("km"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug, CASE WHEN length(text) > 120 THEN text[1:120] || '…' ELSE text END AS preview,
  md5(regexp_replace(coalesce(text, ''), '[\t\n\r]', ' ', 'g')) AS cell, coalesce(regexp_extract_all(text, '\d+')[-1], '') AS last_number FROM documents""")
def text_cells(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(text.slug(F.col("text"))).alias("slug"), text.preview(F.col("text")).alias("preview"), F.md5(text.one_line(F.col("text"))).alias("cell"), text.last_number(F.col("text")).alias("last_number"))


@query("""WITH d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS a, (1990 + o_custkey % 20)::VARCHAR AS b FROM orders)
  SELECT o_orderkey, ((a[1:1] <> b[1:1])::INT + (a[2:2] <> b[2:2])::INT + (a[3:3] <> b[3:3])::INT + (a[4:4] <> b[4:4])::INT)::INT AS digits, a[3:4] AS token FROM d""")
def digit_distance(spark, sf_dir):
    year, other = F.date_format("o_orderdate", "yyyy"), (1990 + F.col("o_custkey") % 20).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.digit_distance(year, other).alias("digits"), dates.year_token(F.concat(F.lit("am 3. V. "), F.right(year, F.lit(2)), F.lit(" ."))).alias("token"))
