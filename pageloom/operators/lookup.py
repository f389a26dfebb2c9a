"""Joins that look names up, with fallbacks, budgets and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_default(rows: DataFrame, table: DataFrame, on: str, values: dict[str, Column]) -> DataFrame:
    """Left join with a value for what is missing. The table has one row for each key."""
    joined = rows.join(table, on, "left")
    return joined.withColumns({name: F.coalesce(name, default) for name, default in values.items()})


def with_fallback(rows: DataFrame, trusted: DataFrame, seed: DataFrame, on: str, source: str, accepted: list[str]) -> DataFrame:
    """name, method and note from the first table where its source is accepted, else from the second.

    Both tables have (on, name); the first also ``source``. A row of the first
    table that is not accepted leaves a note.
    """
    t = trusted.select(on, F.col("name").alias("_t"), F.col(source).alias("_s"), F.lit(True).alias("_there"))
    s = seed.select(on, F.col("name").alias("_n"))
    ok = F.col("_t").isNotNull() & F.col("_s").isin(*accepted)
    joined = rows.join(t, on, "left").join(s, on, "left")
    return joined.select(
        *rows.columns, F.when(ok, F.col("_t")).otherwise(F.col("_n")).alias("name"),
        F.when(ok, F.concat(F.lit("table:"), "_s")).when(F.col("_n").isNotNull(), "seed").otherwise("unresolved").alias("method"),
        F.when(F.col("_there") & ~F.coalesce(ok, F.lit(False)), F.concat(F.lit("source="), F.coalesce("_s", F.lit("none")), F.lit("; unconfirmed"))).alias("note"),
    )


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the least order of each key; non-empty keys only."""
    value = F.min_by(F.struct(*rows.columns), F.col(order)).alias("_row")
    return rows.filter(F.trim(key) != "").groupBy(key).agg(value).select("_row.*")


def within_budget(keys: DataFrame, cache: DataFrame, key: str, uses: str, limit: int) -> DataFrame:
    """The ``limit`` most used keys that the cache does not hold."""
    return keys.join(cache.select(key), key, "left_anti").orderBy(F.desc(uses), key).limit(limit)


def best(rows: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """The first row of each group by an order that leaves no ties."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def unique_match(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    """Left join where exactly one value answers; several or none give null."""
    one = right.groupBy(*on).agg(F.count_distinct(value).alias("_n"), F.min(value).alias(value)).filter("_n = 1").drop("_n")
    return left.join(one, on, "left")


def resolve_observers(mentions: DataFrame, persons: DataFrame) -> DataFrame:
    """Name of the person meant: the entry's person of the same key, else the only one with that surname, else a new one.

    mentions: entry, observer, key, surname. persons: entry, name, key, surname.
    """
    exact = persons.groupBy("entry", "key").agg(F.min("name").alias("_exact"))
    joined = mentions.join(exact, ["entry", "key"], "left")
    joined = unique_match(joined, persons.select("entry", "surname", F.col("name").alias("_only")), ["entry", "surname"], "_only")
    return joined.select("entry", "observer", F.coalesce("_exact", "_only", "observer").alias("person"), (F.coalesce("_exact", "_only").isNull()).alias("is_new"))


def applied(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Merge rows that hold: automatic ones unless rejected, candidates only if accepted. decisions: merge_id, decision."""
    said = decisions.select("merge_id", F.lower(F.trim("decision")).alias("_said"))
    joined = rows.join(said, "merge_id", "left")
    yes, no = ("y", "yes", "merge", "1", "accept"), ("n", "no", "0", "reject", "keep", "separate")
    holds = F.when(F.col("status") == "auto", ~F.coalesce(F.col("_said").isin(*no), F.lit(False))).otherwise(F.coalesce(F.col("_said").isin(*yes), F.lit(False)))
    return joined.filter(holds).drop("_said")


def repoint(rows: DataFrame, merges: DataFrame, *columns: str) -> DataFrame:
    """Each column's variants replaced by their canonical form. merges: variant, canonical."""
    for i, column in enumerate(columns):
        m = merges.select(F.col("variant").alias(f"_v{i}"), F.col("canonical").alias(f"_c{i}"))
        rows = rows.join(m, F.col(column) == F.col(f"_v{i}"), "left").withColumn(column, F.coalesce(f"_c{i}", column)).drop(f"_v{i}", f"_c{i}")
    return rows


def carry_decisions(new: DataFrame, old: DataFrame, key: str, order: str) -> DataFrame:
    """New review rows with the first non-empty decision that the old ones had for their key."""
    kept = old.filter(F.trim("decision") != "").groupBy(key).agg(F.min_by("decision", F.col(order)).alias("_old"))
    return new.drop("decision").join(kept, key, "left").withColumn("decision", F.coalesce("_old", F.lit(""))).drop("_old")


def context_anchors(rows: DataFrame, entry: str, name: str) -> DataFrame:
    """name, n_entries, n_anchors: entries in which a name stands beside another one, and those others. Each entry's names are told apart first."""
    named = rows.select(F.col(entry).alias("_e"), F.col(name).alias("name")).distinct()
    other = named.select("_e", F.col("name").alias("_a"))
    return named.join(other, "_e").filter("name <> _a").groupBy("name").agg(F.count_distinct("_e").alias("n_entries"), F.count_distinct("_a").alias("n_anchors"))
