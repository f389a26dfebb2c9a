"""Aggregations with a defined answer for ties and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def mode_first(rows: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """The commonest value of each group, of equals the one seen first."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return counts.groupBy(group).agg(F.max_by(value, F.struct("n", -F.col("_first"))).alias(value), F.max("n").alias("n"))


def rank_values(rows: DataFrame, group: str, value: str, ranks: dict[str, Column]) -> DataFrame:
    """Values at ranks from 0 of each group's sorted values; a rank is a function of the count ``n``.

    Equal values are counted first, so the window runs over the distinct ones only.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(group)
    upto = counts.select(group, value, F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"), F.sum("_c").over(w).alias("n"))
    return upto.groupBy(group).agg(*[F.min(F.when(F.col("_upto") > at, F.col(value))).alias(name) for name, at in ranks.items()])


def upper_median(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rank_values(rows, group, value, {"median": F.floor(F.col("n") / 2)})


def tail_ranks(rows: DataFrame, group: str, value: str, share: float = 0.02) -> DataFrame:
    """The values at 2 and 98 hundredths of the ranks."""
    low = F.floor(F.col("n") * share)
    high = F.least(F.col("n") - 1, F.floor(F.col("n") * (1 - share)))
    return rank_values(rows, group, value, {"low": low, "high": high})


def ordered_join(order: str, value: str, separator: str) -> Column:
    """Values in order in one string."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value]), separator)


def distinct_join(value: str, separator: str = ", ") -> Column:
    return F.array_join(F.sort_array(F.collect_set(value)), separator)


def first_distinct(rows: DataFrame, group: str, value: str, order: str, n: int = 3) -> DataFrame:
    """The first n distinct values of each group, in order of appearance."""
    seen = rows.groupBy(group, value).agg(F.min(order).alias("_o"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_o"))
    return seen.withColumn("_r", rank).filter(F.col("_r") <= n).groupBy(group).agg(ordered_join("_r", value, "; ").alias("notes"))


def key_census(rows: DataFrame, kind: str, document: str) -> DataFrame:
    """kind, key, n: how many JSON objects of each kind have each key, one level down too."""
    top = rows.select(kind, F.explode(F.map_keys(F.from_json(document, "map<string,string>"))).alias("key"))
    nested = rows.select(kind, F.explode(F.from_json(document, "map<string,string>")).alias("_k", "_v"))
    nested = nested.select(kind, F.explode(F.map_keys(F.from_json("_v", "map<string,string>", {"mode": "PERMISSIVE"}))).alias("_sub"), "_k")
    nested = nested.select(kind, F.concat("_k", F.lit("."), "_sub").alias("key"))
    return top.union(nested).groupBy(kind, "key").agg(F.count("*").alias("n"))


def fill_rates(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Share of rows of each group that have a value."""
    return rows.groupBy(group).agg(*[F.round(F.avg(F.col(c).isNotNull().cast("int")), 6).alias(c) for c in columns])


def in_several(rows: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that occur in more than one group."""
    return rows.groupBy(key).agg(F.count_distinct(group).alias("n_groups")).filter("n_groups > 1")


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def usage(*roles: tuple[DataFrame, str, str]) -> DataFrame:
    """name, n_<role> and uses over tables that name things in different roles: (table, column, role)."""
    parts = [t.select(F.col(c).alias("name"), F.lit(role).alias("role")).filter("name is not null") for t, c, role in roles]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    counted = [F.count_if(F.col("role") == role).alias(f"n_{role}") for role in dict.fromkeys(r for _, _, r in roles)]
    return whole.groupBy("name").agg(*counted, F.count("*").alias("uses"))
