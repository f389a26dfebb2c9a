"""Observations read from text by rule, and entries cut out of a stream of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.operators import extract
from pageloom.plans.registry import query, table

#: A diary text for each order: a sentence for each line item, which names the part's thing as a bird would be named.
_TEXTS = """w AS (SELECT l_orderkey AS entry, l_linenumber AS n, l_partkey AS p, l_suppkey AS q, l_quantity::INT AS c, upper(split_part(p_name, ' ', 2)[1:1]) || split_part(p_name, ' ', 2)[2:] AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
  s AS (SELECT *, CASE n % 5 WHEN 0 THEN 'Am Weiher etwa ' || c || ' ' || v || 'en gehört.' WHEN 1 THEN c || ' ' || v || ' sangen im Wald!' WHEN 2 THEN 'Mehrere ' || v || 's beim Nest.'
    WHEN 3 THEN 'Zwei ' || v || 'er erlegt?' ELSE 'Weit über den See ' || v || 'ei und ' || v || 'n' END AS s FROM w),
  t AS (SELECT entry, string_agg(s, ' ' ORDER BY n, p, q, c) AS t FROM s GROUP BY entry)"""


def _texts(spark, sf_dir):
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    v = F.element_at(F.split("p_name", " "), 2)
    name = F.concat(F.upper(F.left(v, F.lit(1))), F.substring(v, 2, 100))
    w = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("entry"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("q"), F.col("l_quantity").cast("int").alias("c"),
        name.alias("v"),
    )
    c, v, n = F.col("c").cast("string"), F.col("v"), F.col("n") % 5
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    s = F.when(n == 0, say("Am Weiher etwa ", c, " ", v, "en gehört.")).when(n == 1, say(c, " ", v, " sangen im Wald!")).when(n == 2, say("Mehrere ", v, "s beim Nest."))
    s = s.when(n == 3, say("Zwei ", v, "er erlegt?")).otherwise(say("Weit über den See ", v, "ei und ", v, "n"))
    parts = F.sort_array(F.collect_list(F.struct("n", "p", "q", "c", s.alias("s"))))
    names = p.join(li, F.col("l_partkey") == F.col("p_partkey"), "left_semi").select(name.alias("v")).distinct().select(F.col("v").alias("vernacular"), F.xxhash64("v").alias("ord"))
    return w.groupBy("entry").agg(F.array_join(F.transform(parts, lambda x: x["s"]), " ").alias("t")), names


@query(rf"""WITH {_TEXTS}, g AS (SELECT DISTINCT v, translate(replace(lower(v), 'ß', 'ss'), 'äöüv', 'aouw') AS stem FROM w),
  f AS (SELECT v, stem || e AS form FROM g, unnest(['', 's', 'e', 'n', 'en', 'er']) AS x(e) QUALIFY row_number() OVER (PARTITION BY stem || e ORDER BY len(stem) DESC) = 1),
  l AS (SELECT entry, regexp_extract_all(t, '[^.!?]*[.!?]|[^.!?]+$') AS l FROM t), z AS (SELECT entry, unnest(l) AS s, unnest(range(len(l))) AS i FROM l),
  k AS (SELECT *, regexp_extract_all(s, '[A-Za-zÄÖÜäöüß]+') AS k FROM z), o AS (SELECT entry, i, s, unnest(k) AS verbatim, unnest(range(len(k))) AS j FROM k),
  m AS (SELECT entry, v AS vernacular, verbatim, i, j, trim(s) AS sentence FROM o JOIN f ON form = translate(replace(lower(verbatim), 'ß', 'ss'), 'äöüv', 'aouw') QUALIFY row_number() OVER (PARTITION BY entry, v ORDER BY i, j) = 1),
  a AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY i, j) - 1 AS index, lower(sentence) AS low, lower(sentence[greatest(strpos(sentence, verbatim) - 40, 1):strpos(sentence, verbatim) - 1]) AS win FROM m)
  SELECT entry, index, vernacular, verbatim, CASE WHEN contains(low, 'nest') THEN 'nest' WHEN contains(low, 'erlegt') THEN 'specimen' WHEN contains(low, 'gehört') OR contains(low, 'sang') THEN 'auditory' ELSE 'visual' END AS evidence,
    CASE WHEN contains(low, 'sang') THEN 'song' WHEN contains(low, 'gehört') THEN 'call' END AS call_type, CASE WHEN contains(low, 'sang') THEN 'sang' WHEN contains(low, 'gehört') THEN 'gehört' END AS transcription, contains(low, 'nest') AS breeding,
    CASE WHEN contains(win, 'mehrere') THEN NULL WHEN regexp_matches(win, '\b\d{{1,4}}\b') THEN regexp_extract(win, '\b(\d{{1,4}})\b', 1)::INT WHEN regexp_matches(win, '\bzwei\b') THEN 2 END AS count,
    CASE WHEN contains(win, 'mehrere') THEN 'plural-unspecified' WHEN regexp_matches(win, '\b\d{{1,4}}\b') THEN CASE WHEN contains(win, 'etwa') THEN 'approximate' ELSE 'exact' END WHEN regexp_matches(win, '\bzwei\b') THEN 'exact' END AS qualifier FROM a""")
def rule_observations(spark, sf_dir):
    """Mentions of names in the entries' texts, with what their sentences say of them."""
    rows, names = _texts(spark, sf_dir)
    found = extract.observed(extract.find_taxa(rows, "entry", "t", names))
    return found.select("entry", "index", "vernacular", "verbatim", F.array_join("evidence", ",").alias("evidence"), "call_type", "transcription", "breeding", "count", "qualifier")


#: A page for each order: with a header of one of the forms, of a form that is prose, with two or with none.
_ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII")
_PAGES = f"""h AS (SELECT o_orderkey AS page, o_custkey % 34 AS volume, n_name AS place, day(o_orderdate)::VARCHAR AS d, [{', '.join(f"'{r}'" for r in _ROMAN)}][month(o_orderdate)] AS m, year(o_orderdate)::VARCHAR AS y, chr(10) AS nl
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
  p AS (SELECT page, volume, CASE page % 7 WHEN 0 THEN d || '. ' || m || '. ' || y || ' ' || place || '. Heute Nebel.' || nl || 'zwei Stück' WHEN 1 THEN 'davor' || nl || d || '.' || m || '.' || y[3:4] || ' <u>' || place || '</u> und' || nl || 'weiter 12 Stück'
    WHEN 2 THEN d || '. April ' || y || ', vormittags nichts' || nl || 'Text' WHEN 3 THEN d || '. Mai ' || y || nl || 'nur Text' WHEN 4 THEN '- ' || d || '. ' || m || '. ' || y || ' Montag, ' || place || '  gut' || nl
    WHEN 5 THEN 'kein Kopf' || nl || 'wei-' || nl || 'ter 5' ELSE d || '. ' || m || ' ' || y || ': ' || place || nl || 'alt' || nl || d || '. Mai ' || y || '. Dort' || nl || 'neu' END AS t FROM h)"""
_STARTS = r"""ls AS (SELECT page, volume, string_split(t, chr(10)) AS l FROM p), li AS (SELECT page, volume, unnest(l) AS line, unnest(range(len(l))) AS k FROM ls),
  lo AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY page ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS "offset",
    regexp_extract(line, '^(?:- )?(\d{1,2}\. ?(?:VIII|XII|VII|III|XI|IX|IV|VI|II|X|V|I|April|Mai)\.?[ .]*(?:19\d\d|20\d\d|\d\d))[.:]?(.*)$', ['date', 'rest']) AS e FROM li),
  lr AS (SELECT *, e.date AS date, trim(e.rest) AS r, regexp_replace(trim(e.rest), '^Montag, ', '') AS bare FROM lo WHERE e.date <> ''),
  st AS (SELECT page, volume, "offset", "offset" + length(line) AS "end", date, r, bare, CASE WHEN r = '' THEN '' WHEN bare LIKE '<u>%' THEN regexp_extract(bare, '<u>(.*)</u>', 1) ELSE string_split_regex(string_split_regex(bare, '\.(\s|$)')[1], '\s\s+')[1] END AS location FROM lr WHERE r[1:1] <> ','),
  sd AS (SELECT *, regexp_extract(date, '^(\d+)\. ?([A-Za-z]+)[ .]*(\d+)$', ['d', 'm', 'y']) AS x FROM st)"""


def _diary(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    d, y, place, nl = F.dayofmonth("o_orderdate").cast("string"), F.year("o_orderdate").cast("string"), F.col("n_name"), "\n"
    m, k = F.element_at(F.array(*map(F.lit, _ROMAN)), F.month("o_orderdate")), F.col("o_orderkey") % 7
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    t = F.when(k == 0, say(d, ". ", m, ". ", y, " ", place, ". Heute Nebel.", nl, "zwei Stück")).when(k == 1, say("davor", nl, d, ".", m, ".", F.substring(y, 3, 2), " <u>", place, "</u> und", nl, "weiter 12 Stück"))
    t = t.when(k == 2, say(d, ". April ", y, ", vormittags nichts", nl, "Text")).when(k == 3, say(d, ". Mai ", y, nl, "nur Text")).when(k == 4, say("- ", d, ". ", m, ". ", y, " Montag, ", place, "  gut", nl))
    t = t.when(k == 5, say("kein Kopf", nl, "wei-", nl, "ter 5")).otherwise(say(d, ". ", m, " ", y, ": ", place, nl, "alt", nl, d, ". Mai ", y, ". Dort", nl, "neu"))
    return joined.select(F.col("o_orderkey").alias("page"), (F.col("o_custkey") % 34).alias("volume"), t.alias("t"))


@query(rf"""WITH {_PAGES}, {_STARTS} SELECT page, "offset", "end", date, location, CASE WHEN location = '' THEN 'date-only' WHEN r LIKE '<u>%' THEN 'underlined' ELSE 'plain' END AS variant,
    CASE WHEN r = '' THEN 'date-only' WHEN bare LIKE '<u>%' THEN 'underlined' WHEN bare <> r THEN 'weekday-stripped' ELSE 'plain' END AS loc_source,
    CASE WHEN length(x.y) = 2 THEN '19' ELSE '' END || x.y || '-' || lpad(CASE x.m WHEN 'April' THEN 4 WHEN 'Mai' THEN 5 ELSE list_position([{', '.join(f"'{r}'" for r in _ROMAN)}], x.m) END::VARCHAR, 2, '0') || '-' || lpad(x.d, 2, '0') AS date_norm,
    CASE WHEN x.m IN ('April', 'Mai') THEN 'name' ELSE 'roman' END AS month_source FROM sd""")
def header_starts(spark, sf_dir):
    """Every entry header of every page, with its place in the page."""
    return extract.entry_starts(_diary(spark, sf_dir), "page", "t").select("page", "offset", "end", "date", "location", "variant", "loc_source", "date_norm", "month_source")


@query(rf"""WITH {_PAGES}, {_STARTS}, po AS (SELECT *, coalesce(sum(length(t) + 2) OVER (PARTITION BY volume ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM p),
  vs AS (SELECT volume, string_agg(t, chr(10) || chr(10) ORDER BY page) AS whole FROM p GROUP BY volume),
  g AS (SELECT st.volume, st.page, st."offset", base + st."offset" AS a, row_number() OVER (PARTITION BY st.volume ORDER BY st.page, st."offset") AS seq, lead(base + st."offset") OVER (PARTITION BY st.volume ORDER BY st.page, st."offset") AS b FROM st JOIN po USING (page)),
  w AS (SELECT volume, seq, page, "offset", substr(whole, a::BIGINT + 1, (coalesce(b, length(whole)) - a)::BIGINT) AS raw FROM g JOIN vs USING (volume)),
  c AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '^\s+|\s+$', '', 'g'), '(?i)</?(?:u|sup|sub|b|i|em|strong)\s*>', '', 'g'),
    '([\p{{L}}\p{{N}}_])-[ \t]*\n+[ \t]*([a-zäöüß])', '\1\2', 'g'), '\s*\n+\s*', ' ', 'g'), '[ \t]{{2,}}', ' ', 'g')) AS clean FROM w)
  SELECT volume, seq, page, "offset", md5(clean) AS body, length(clean) AS n_chars, len(regexp_extract_all(clean, '\S+')) AS n_words FROM c""")
def entries_from_headers(spark, sf_dir):
    """The volumes' streams of pages cut at their headers."""
    pages = _diary(spark, sf_dir)
    found = extract.resegmented(pages, extract.entry_starts(pages, "page", "t").select("page", "offset"), "volume", "page", "t")
    return found.select("volume", "seq", "page", "offset", F.md5("text_clean").alias("body"), "n_chars", "n_words")
