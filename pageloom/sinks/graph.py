"""Serialised graphs: N-Triples lines and JSON-LD objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

XSD = "http://www.w3.org/2001/XMLSchema#"


def _term(value: Column) -> Column:
    return F.concat(F.lit("<"), value, F.lit(">"))


def _literal(value: Column) -> Column:
    out = value
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), out, F.lit('"'))


def ntriples(graph: DataFrame) -> DataFrame:
    """value: a line for each triple (s, p, o, kind)."""
    kind = F.col("kind")
    o = (
        F.when(kind == "iri", _term(F.col("o")))
        .when(kind.startswith("@"), F.concat(_literal(F.col("o")), kind))
        .when(kind == "string", _literal(F.col("o")))
        .otherwise(F.concat(_literal(F.col("o")), F.lit(f"^^<{XSD}"), kind, F.lit(">")))
    )
    return graph.select(F.concat_ws(" ", _term(F.col("s")), _term(F.col("p")), o, F.lit(".")).alias("value"))


def read_ntriples(lines: DataFrame) -> DataFrame:
    """The triples of lines that ntriples wrote; other lines are left out."""
    pattern = r'^<([^>]*)> <([^>]*)> (?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(\^\^<[^>]*>|@[A-Za-z-]+)?) \.$'
    # what stands behind a text is taken from the line once
    lines = lines.filter(F.col("value").rlike(pattern)).select("value", F.explode(F.array(F.regexp_extract("value", pattern, 5))).alias("_t"))
    part = lambda i: F.regexp_extract("value", pattern, i)
    text = part(4)
    for a, b in (("\\\\", "\x00"), ('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\x00", "\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    iri = F.col("value").rlike(r'^<[^>]*> <[^>]*> <')
    of = F.replace(F.substring("_t", F.lit(4), F.length("_t") - 4), F.lit(XSD), F.lit(""))
    kind = F.when(iri, "iri").when(F.col("_t").startswith("@"), F.col("_t")).when(F.length("_t") > 4, of).otherwise("string")
    return lines.select(part(1).alias("s"), part(2).alias("p"), F.when(iri, part(3)).otherwise(text).alias("o"), kind.alias("kind"))


def jsonld(graph: DataFrame) -> DataFrame:
    """value: an object for each subject, with its predicates' sorted values."""
    held = graph.groupBy("s", "p").agg(F.sort_array(F.collect_list("o")).alias("v"))
    each = held.groupBy("s").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p", "v")))).alias("m"))
    return each.select(F.to_json(F.map_concat(F.create_map(F.lit("@id"), F.array("s")), "m")).alias("value"))
