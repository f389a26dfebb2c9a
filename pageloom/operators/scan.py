"""Running measures over rows in order, a group split over many tasks.

Rows are dealt out by ranges of group and order, so a group of any size lies in as
many parts as it needs. Each part is measured on its own; what the parts before it
(or after it) hand on is worked out from one row for each part of the groups that
lie in several, and then added. No window runs over a group alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from pageloom.operators.graph import settled


@dataclass(frozen=True)
class Measure:
    """local: over the window of a part; total: of a whole part, by the order; carry: over the window of the totals before; both: of the carried and the local value."""

    local: Callable[[WindowSpec], Column]
    total: Callable[[Column], Column]
    carry: Callable[[Column, WindowSpec], Column]
    both: Callable[[Column, Column], Column]
    backwards: bool = False


def running_sum(value: Column, own: bool = True) -> Measure:
    """The sum of the values up to the row, with or without its own; nulls count nothing."""
    add = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    frame = lambda w: w.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    return Measure(lambda w: F.sum(value).over(frame(w)), lambda order: F.sum(value), lambda t, w: F.sum(t).over(w), add)


def running_max(value: Column) -> Measure:
    """The greatest value up to and with the row."""
    frame = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    return Measure(lambda w: F.max(value).over(frame(w)), lambda order: F.max(value), lambda t, w: F.max(t).over(w), lambda a, b: F.greatest(a, b))


def last_value(value: Column, own: bool = True) -> Measure:
    """The last value that is not null up to the row, with or without its own."""
    frame = lambda w: w.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    nearest = lambda carried, here: F.coalesce(here, carried)
    return Measure(lambda w: F.last(value, ignorenulls=True).over(frame(w)), lambda order: F.max_by(value, F.when(value.isNotNull(), order)), lambda t, w: F.last(t, ignorenulls=True).over(w), nearest)


def next_value(value: Column) -> Measure:
    """The first value that is not null after the row."""
    frame = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    nearest = lambda carried, here: F.coalesce(here, carried)
    return Measure(lambda w: F.last(value, ignorenulls=True).over(frame(w)), lambda order: F.min_by(value, F.when(value.isNotNull(), order)), lambda t, w: F.last(t, ignorenulls=True).over(w), nearest, backwards=True)


def parted(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """rows with ``_part``: about equal ranges of group and order, kept as they were dealt out."""
    return settled(rows.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()))


def _several(parts: DataFrame, group: str) -> DataFrame:
    """The parts of groups that lie in more than one; of other groups nothing is handed on."""
    many = parts.groupBy(group).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col(group).alias("_g"))
    return parts.join(many, F.col(group).eqNullSafe(F.col("_g")), "left_semi")


def _with_carried(rows: DataFrame, carried: DataFrame, group: str) -> DataFrame:
    handed = carried.withColumnRenamed(group, "_g").withColumnRenamed("_part", "_p")
    return rows.join(handed, rows[group].eqNullSafe(handed["_g"]) & (rows["_part"] == handed["_p"]), "left").drop("_g", "_p")


def scanned(rows: DataFrame, group: str, order: list[str], **measures: Measure) -> DataFrame:
    """rows with a column for each measure. The order has no ties within a group; null groups are one group. Wide rows are better scanned without their texts and joined afterwards."""
    held = parted(rows, group, *order)
    place = F.struct(*order)
    inside = Window.partitionBy(group, "_part")
    ways = {False: inside.orderBy(*[F.asc(c) for c in order]), True: inside.orderBy(*[F.desc(c) for c in order])}
    parts = held.groupBy(group, "_part").agg(*[m.total(place).alias(f"_t_{n}") for n, m in measures.items()])
    across = Window.partitionBy(group)
    before = {False: across.orderBy(F.asc("_part")), True: across.orderBy(F.desc("_part"))}
    earlier = {way: w.rowsBetween(Window.unboundedPreceding, -1) for way, w in before.items()}
    carried = _several(parts, group).select(group, "_part", *[m.carry(F.col(f"_t_{n}"), earlier[m.backwards]).alias(f"_c_{n}") for n, m in measures.items()])
    local = held.withColumns({f"_l_{n}": m.local(ways[m.backwards]) for n, m in measures.items()})
    joined = _with_carried(local, carried, group)
    return joined.select(*rows.columns, *[m.both(F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n) for n, m in measures.items()])


def _nearest(rows: DataFrame, value: str, keys: list[str], order: list[Column], n: int, to: str) -> DataFrame:
    """Adds an array of up to n values that are not null, of the rows before in this order, nearest first.

    A valid row passes on the neighbours it has found itself: the k-th nearest is
    the nearest one's (k-1)-th, so each step is one more window over the same
    order and nothing is collected.
    """
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    passed, names = F.col(value), []
    for k in range(n):
        # wrapped, so that a valid row without a further neighbour still counts as the nearest one
        nearest = F.last(F.when(F.col(value).isNotNull(), F.struct(passed.alias("v"))), ignorenulls=True).over(frame)
        rows = rows.withColumn(f"_k{k}", nearest["v"])
        names.append(f"_k{k}")
        passed = F.col(f"_k{k}")
    return rows.withColumn(to, F.filter(F.array(*names), lambda x: x.isNotNull())).drop(*names)


def neighbours(rows: DataFrame, value: str, group: str, order: str, n: int = 2) -> DataFrame:
    """rows with ``_before`` and ``_after``: up to n values on either side that are not null, nearest first. The order has no ties within a group."""
    held = parted(rows, group, order)
    keys = [group, "_part"]
    local = _nearest(held, value, keys, [F.asc(order)], n, "_b")
    local = _nearest(local, value, keys, [F.desc(order)], n, "_a")
    valid = F.when(F.col(value).isNotNull(), F.col(order))
    one = F.array(F.col(value))
    parts = local.groupBy(*keys).agg(F.max_by(F.slice(F.concat(one, "_b"), 1, n), valid).alias("_last"), F.min_by(F.slice(F.concat(one, "_a"), 1, n), valid).alias("_first"))
    parts = settled(_several(parts, group))

    def handed(edge: str, forward: bool, to: str) -> DataFrame:
        """For each part the n nearest of the parts before it: a mark for the part among the values of all parts' edges."""
        way = 1 if forward else -1
        values = parts.select(*keys, F.posexplode(edge).alias("_k", "_v")).select(*keys, (F.col("_part") * way).alias("_o"), (-F.col("_k")).alias("_k"), "_v")
        marks = parts.select(*keys, (F.col("_part") * way).alias("_o"), F.lit(-n).alias("_k"), F.lit(None).cast(rows.schema[value].dataType).alias("_v"))
        return _nearest(values.union(marks), "_v", [group], [F.asc("_o"), F.asc("_k")], n, to).filter(F.col("_k") == -n).select(*keys, to)

    local = _with_carried(local, handed("_last", True, "_cb"), group)
    local = _with_carried(local, handed("_first", False, "_ca"), group)
    both = lambda here, there: F.slice(F.concat(here, F.coalesce(there, F.array().cast(local.schema[here].dataType))), 1, n)
    return local.select(*rows.columns, both("_b", F.col("_cb")).alias("_before"), both("_a", F.col("_ca")).alias("_after"))
