"""Joins of everything that is alike enough, exact: sets by Jaccard, names by a ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.graph import settled


def _needed(n: Column, threshold: float) -> Column:
    """The least number of elements that a set of n must share with any other to reach the threshold; a hair less, for rounding."""
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def rare_first(sets: DataFrame, key: str, elements: str) -> DataFrame:
    """key, n, and ``ranked``: the elements of each set as (uses, e), those that the fewest sets have first. Each set has an element once."""
    held = sets.select(key, F.explode(elements).alias("e"))
    uses = held.groupBy("e").agg(F.count("*").alias("uses"))
    ranked = F.sort_array(F.collect_list(F.struct("uses", "e")))
    return held.join(uses, "e").groupBy(key).agg(ranked.alias("ranked")).withColumn("n", F.size("ranked"))


def similar_sets(sets: DataFrame, key: str, elements: str, threshold: float) -> DataFrame:
    """a, b (a < b), shared, jaccard of every pair of sets whose Jaccard reaches the threshold (above 0). sets: a row for each distinct set, elements without repeats.

    Two sets that reach it share one of the rarest elements of each, so the join is
    over these only, and over sets whose sizes can reach it. A candidate's shared
    rare elements are counted before it meets its sets: what the two may share
    beyond them is no more than what is left of the set whose rare part ends first.
    Elements that many sets have are the last, and stay out of the join unless a
    set has no others. Empty sets and nulls are like none; a set of which equals
    exist should be given once (``equal_groups``).
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0 and not above 1")
    base = settled(sets.select(F.col(key).alias("_key"), F.col(elements).alias("_e")).filter(F.size("_e") > 0))
    ranked = rare_first(base, "_key", "_e")
    front = F.col("n") - _needed(F.col("n"), threshold) + 1
    rare = ranked.select("_key", "n", front.alias("front"), F.slice("ranked", F.lit(1), front).alias("part"))
    # where a set's rare part ends, in the order of all elements
    rare = settled(rare.select("_key", "n", (F.col("n") - F.col("front")).alias("rest"), F.element_at("part", -1).alias("last"), F.transform("part", lambda x: x["e"]).alias("part")))
    spots = rare.select(F.explode("part").alias("e"), F.col("_key"), "n", "rest", "last")
    side = lambda s: spots.select("e", F.col("_key").alias(s), F.col("n").alias(f"_n{s}"), F.col("rest").alias(f"_r{s}"), F.col("last").alias(f"_l{s}"))
    fits = (F.col("a") < F.col("b")) & (F.least("_na", "_nb") >= _needed(F.greatest("_na", "_nb"), threshold))
    met = side("a").join(side("b"), "e").filter(fits)
    counted = met.groupBy("a", "b").agg(F.count("*").alias("_k"), *[F.first(c).alias(c) for c in ("_na", "_nb", "_ra", "_rb", "_la", "_lb")])
    beyond = F.when(F.col("_la") < F.col("_lb"), F.col("_ra")).otherwise(F.col("_rb"))
    least = F.lit(threshold / (1 + threshold)) * (F.col("_na") + F.col("_nb")) - F.lit(1e-9)
    likely = settled(counted.filter(F.col("_k") + beyond >= least).select("a", "b"))
    of = lambda s: base.select(F.col("_key").alias(s), F.col("_e").alias(f"_{s}"))
    shared = F.size(F.array_intersect("_a", "_b"))
    sure = likely.join(of("a"), "a").join(of("b"), "b").select("a", "b", shared.alias("shared"), (F.size("_a") + F.size("_b")).alias("_both"))
    return sure.select("a", "b", "shared", (F.col("shared") / (F.col("_both") - F.col("shared"))).alias("jaccard")).filter(F.col("jaccard") >= threshold)
