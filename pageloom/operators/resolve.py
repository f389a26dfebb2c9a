"""Spellings that mean the same: merges by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.names import canonical_rank


def group_merges(names: DataFrame, key: str, rule: str) -> DataFrame:
    """variant, canonical, rule, status, n_variant: each key's spellings and the best of them. names: name, uses, key; null and empty keys merge nothing."""
    named = names.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    best = named.groupBy(key).agg(F.max_by("name", canonical_rank(F.col("name"), F.col("uses"))).alias("canonical"))
    merged = named.join(best, key).filter("name <> canonical")
    return merged.select(F.col("name").alias("variant"), "canonical", F.lit(rule).alias("rule"), F.lit("auto").alias("status"), F.col("uses").alias("n_variant"))


def inherit(names: DataFrame, key: str, *columns: str) -> DataFrame:
    """For each key the first value that is not null of each column, the most used name first, then by name."""
    order = F.struct((-F.col("uses")).alias("u"), F.col("name").alias("n"))
    return names.groupBy(key).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])
