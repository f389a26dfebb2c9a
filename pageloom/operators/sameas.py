"""Nodes that stand for the same thing: by equal labels, pairs for review, and the most similar name."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.operators.graph import settled

SAME_AS = "http://www.w3.org/2002/07/owl#sameAs"

# Titles that are no part of a person's label, forms of address that tell persons apart, and what stands for nobody.
TITLES = (
    "Prof", "Dr", "Dipl", "Ing", "med", "phil", "jur", "h\\.c", "Geheimrat",
    "Oberst", "Major", "Pfarrer", "Baron", "Graf", "Freiherr", "Forstmeister", "Oberförster", "Hofrat", "Sanitätsrat",
)
ADDRESSES = ("Frau", "Frl", "Fräulein", "Herr")
NOBODY = ("\\[.*\\]", "\\?+", "N\\.?N\\.?", "X", "unleserlich", "illegible")

#: Names in a lot, about.
LOT = 1024


def _spaced(label: Column) -> Column:
    return F.trim(F.regexp_replace(label, r"\s+", " "), F.lit(" .,"))


def person_label(name: Column) -> Column:
    """The name without titles before it and full stops or commas around it."""
    return _spaced(F.regexp_replace(F.trim(name), rf"(?i)^(?:(?:{'|'.join(TITLES)})\.?\s+)+", ""))


def place_label(name: Column) -> Column:
    """The name in lower case with single spaces; no other spelling counts as the same."""
    return F.lower(_spaced(F.trim(name)))


def is_nobody(label: Column) -> Column:
    """A placeholder for a name that was not read or not given."""
    return label.rlike(rf"(?i)^[^\p{{L}}\p{{N}}_]*(?:{'|'.join(NOBODY)})[^\p{{L}}\p{{N}}_]*$")


def same_as(nodes: DataFrame, key: str = "key") -> DataFrame:
    """node, canonical of every node that shares a key with a more used one, of equals with one of a smaller id. nodes: node, n (uses), key; null keys are the same as nothing."""
    named = nodes.filter(F.col(key).isNotNull())
    best = named.groupBy(key).agg(F.min_by("node", F.struct((-F.col("n")).alias("u"), "node")).alias("canonical"))
    return named.join(best, key).filter("node <> canonical").select("node", "canonical")


def same_as_triples(merges: DataFrame) -> DataFrame:
    """s, p, o, kind as the writers of graphs take them: each node is the same as its canonical one."""
    return merges.select(F.col("node").alias("s"), F.lit(SAME_AS).alias("p"), F.col("canonical").alias("o"), F.lit("iri").alias("kind"))


def person_review(persons: DataFrame) -> DataFrame:
    """node, other, rule of persons who may be one: an initial and the only full name that begins with it, a bare surname and the only other name. persons: node, name, n.

    Each label is represented by its most used node, of equals that of the
    smallest id. Placeholders and names with a form of address are left out.
    """
    told = persons.filter(F.col("name").isNotNull()).withColumn("label", person_label(F.col("name")))
    told = told.filter(~is_nobody(F.col("label")) & ~is_nobody(F.col("name")) & (F.col("label") != ""))
    best = told.groupBy(F.lower("label").alias("_k")).agg(F.min_by(F.struct("node", "label"), F.struct((-F.col("n")).alias("u"), "node")).alias("b")).select("b.node", "b.label")
    best = best.filter(~F.col("label").rlike(rf"(?i)^(?:{'|'.join(ADDRESSES)})\.?\s+"))
    words = F.split("label", " ")
    short = F.element_at(words, 1).rlike(r"^[A-ZÄÖÜ]\.?$")
    kind = F.when(F.size(words) == 1, "bare").when(short, "initial").otherwise("full")
    best = best.select("node", F.lower(F.element_at(words, -1)).alias("surname"), F.left("label", F.lit(1)).alias("first"), kind.alias("kind"))
    fulls = best.filter("kind = 'full'").groupBy("surname", "first").agg(F.count("*").alias("_n"), F.min("node").alias("other")).filter("_n = 1")
    initials = best.filter("kind = 'initial'").join(fulls, ["surname", "first"]).select("node", "other", F.lit("initial-vs-full").alias("rule"))
    others = best.filter("kind <> 'bare'").groupBy("surname").agg(F.count("*").alias("_n"), F.min("node").alias("other")).filter("_n = 1")
    bares = best.filter("kind = 'bare'").join(others, "surname").select("node", "other", F.lit("bare-surname-unique").alias("rule"))
    return initials.union(bares)


def _dealt(frame: DataFrame, name: str) -> DataFrame:
    """name, _n (its length) and _lot of every name, each once: lots of about ``LOT`` names of lengths near to each other."""
    told = settled(frame.select(F.col(name).alias("name")).filter("name is not null").distinct().withColumn("_n", F.length("name")))
    # a row for each length
    held = told.groupBy("_n").agg(F.count("*").alias("_c"))
    held = held.select("_n", "_c", (F.sum("_c").over(Window.orderBy("_n")) - F.col("_c")).alias("_from"))
    return told.join(F.broadcast(held), "_n").select("name", "_n", F.floor((F.col("_from") + F.pmod(F.xxhash64("name"), F.col("_c"))) / LOT).alias("_lot"))


def _letters_alike(a: list[str], b: list[str]) -> np.ndarray:
    """For each pair, twice the letters that both have, without order, over both lengths; 1 for two empty names."""
    codes = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (*a, *b)]
    letters, at = np.unique(np.concatenate([*codes, np.zeros(0, np.uint32)]), return_inverse=True)
    counts = np.zeros((len(letters), len(codes)), np.int32)
    np.add.at(counts, (at, np.repeat(np.arange(len(codes)), [len(c) for c in codes])), 1)
    shared = np.zeros((len(a), len(b)), np.int32)
    for row in counts:
        shared += np.minimum.outer(row[: len(a)], row[len(a) :])
    total = np.add.outer([len(x) for x in a], [len(x) for x in b])
    return np.where(total > 0, 2.0 * shared / np.maximum(total, 1), 1.0)


def _best_of(asked: list[str], names: list[str], cutoff: float) -> Iterator[tuple[str, str, float, float]]:
    alike = _letters_alike(asked, names)
    matcher = SequenceMatcher()
    for one, bounds in zip(asked, alike, strict=True):
        score, match = cutoff, None
        fits = np.flatnonzero(bounds >= cutoff)
        matcher.set_seq2(one)
        for i in fits[np.argsort(-bounds[fits], kind="stable")]:
            if bounds[i] < score:
                break  # nor can any that follows be better
            matcher.set_seq1(names[i])
            ratio = matcher.ratio()
            if ratio > score or (ratio == score and (match is None or names[i] > match)):
                score, match = ratio, names[i]
        if match is not None:
            yield one, match, score, SequenceMatcher(None, one, match).ratio()


def best_matches(asked: DataFrame, names: DataFrame, name: str = "name", cutoff: float = 0.75) -> DataFrame:
    """name, match, ratio: of each name asked for, the most similar of the names, if twice the matching characters over both lengths reaches the cutoff; of equals the greatest.

    Names of either side are dealt in lots by their length, and the lots meet whose
    lengths allow the cutoff, each pair of lots a task's: a name goes once to each,
    and no pair of names is moved. Letters counted without order bound the ratio of
    all pairs of two lots; each name takes them from the highest bound on, until no
    later one can be better. ``ratio`` is that of the name to its match. Nulls match
    nothing; names are told apart by their characters.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("the cutoff must lie above 0 and not above 1")
    one, other = settled(_dealt(asked, name)), settled(_dealt(names, name))
    lots = lambda side, p: side.groupBy(F.col("_lot").alias(f"_{p}")).agg(F.min("_n").alias(f"_{p}0"), F.max("_n").alias(f"_{p}1"))
    short, long = F.least("_i1", "_j1"), F.greatest("_i0", "_j0")
    cells = lots(one, "i").join(lots(other, "j"), (short >= long) | (2 * short / (short + long) >= cutoff)).select("_i", "_j")
    cells = settled(cells)
    side = lambda rows, p, asks: rows.withColumnRenamed("_lot", f"_{p}").join(cells, f"_{p}").select("_i", "_j", F.lit(asks).alias("_asks"), "name")

    def meet(lot: pa.Table) -> pa.Table:
        told, asks = np.array(lot.column("name").to_pylist(), dtype=object), lot.column("_asks").to_numpy()
        return pa.Table.from_batches([_batch(list(_best_of(list(told[asks]), list(told[~asks]), cutoff)))])

    met = side(one, "i", True).union(side(other, "j", False))
    found = met.groupBy("_i", "_j").applyInArrow(meet, "name string, match string, score double, ratio double")
    return found.groupBy("name").agg(F.max(F.struct("score", "match", "ratio")).alias("b")).select("name", "b.match", "b.ratio")


def _batch(rows: list[tuple[str, str, float, float]]) -> pa.RecordBatch:
    kinds = [("name", pa.string()), ("match", pa.string()), ("score", pa.float64()), ("ratio", pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], schema=pa.schema(kinds))
