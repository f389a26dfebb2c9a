"""Fix points over tables of edges, and triples."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(frame: DataFrame) -> DataFrame:
    """The frame as a table in the folder that spark.checkpoint.dir names, its lineage cut."""
    spark = frame.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.gettempdir()
    path = f"{folder}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the least node within reach. An edge without one of its ends is none.

    Each round a node joins the one that a hash, another in each round, puts first
    among itself and its neighbours, and the edges between those that stay go on:
    a share of the nodes goes in every round whatever the graph looks like, so all
    rounds together move a few times the edges. Then the nodes are told the way
    back, from the last round to the first.
    """
    both = settled(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null"))
    both = both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y")))
    steps: list[DataFrame] = []
    while True:
        first = lambda c: F.struct(F.xxhash64(F.lit(len(steps)), c).alias("h"), c.alias("v"))  # noqa: B023, E731
        chosen = both.groupBy("x").agg(F.min(first(F.col("y"))).alias("_y"))
        steps.append(settled(chosen.select(F.col("x").alias("node"), F.least(first(F.col("x")), F.col("_y"))["v"].alias("to"))))
        one, other = (steps[-1].select(F.col("node").alias(c), F.col("to").alias(t)) for c, t in (("x", "_x"), ("y", "_y")))
        left = both.filter("x < y").join(one, "x").join(other, "y").filter("_x <> _y").select(F.least("_x", "_y").alias("x"), F.greatest("_x", "_y").alias("y")).distinct()
        left = settled(left)
        if left.isEmpty():
            break
        both = left.union(left.select("y", "x"))
    ends = steps.pop()
    while steps:
        on = ends.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
        ends = steps.pop().join(on, F.col("to") == F.col("_n"), "left").select("node", F.coalesce("_t", "to").alias("to"))
    ends = settled(ends)
    return ends.join(ends.groupBy("to").agg(F.min("node").alias("component")), "to").select("node", "component")


def chain_ends(merges: DataFrame) -> DataFrame:
    """variant, canonical with each chain followed to its end. Of a cycle every member gets the least name in it."""
    now = settled(merges.select("variant", "canonical").filter("variant <> canonical"))
    ends = now
    for _ in range(now.count().bit_length() + 1):  # each round doubles the length that is followed
        on = ends.select(F.col("variant").alias("_v"), F.col("canonical").alias("_c"))
        step = settled(ends.join(on, F.col("canonical") == F.col("_v"), "left").select("variant", "canonical", F.coalesce("_c", "canonical").alias("_new")))
        ends = step.select("variant", F.col("_new").alias("canonical"))
        if step.filter("canonical <> _new").isEmpty():
            break
    # what still ends at a variant ends in a cycle
    ring = ends.join(now.select(F.col("variant").alias("_v")), F.col("canonical") == F.col("_v"), "left_semi").select(F.col("canonical").alias("_r")).distinct()
    if ring.isEmpty():
        return ends
    rings = components(now.join(ring, F.col("variant") == F.col("_r"), "left_semi"), "variant", "canonical")
    return ends.join(rings, F.col("canonical") == F.col("node"), "left").select("variant", F.coalesce("component", "canonical").alias("canonical"))


def ancestors(tree: DataFrame) -> DataFrame:
    """code, ancestor, distance over a table (code, parent), each code once. A cycle is an error.

    Each round doubles the distance that is known: what lies farthest from a code
    so far is followed by all that is known of it, so each row is made once.
    """
    known = far = settled(tree.filter("parent is not null").select("code", F.col("parent").alias("ancestor"), F.lit(1).alias("distance")))
    parts, n, reach = [far], far.count(), 1
    while not far.isEmpty():
        if reach > n:
            raise ValueError("the tree has a cycle")
        on = known.select(F.col("code").alias("_c"), F.col("ancestor").alias("_a"), F.col("distance").alias("_d"))
        found = far.join(on, F.col("ancestor") == F.col("_c")).select("code", F.col("_a").alias("ancestor"), (F.col("distance") + F.col("_d")).alias("distance"))
        parts.append(settled(found))
        reach *= 2
        known = reduce(DataFrame.union, parts)
        far = parts[-1].filter(F.col("distance") == reach)
    return known


def each(rows: DataFrame, array: str, number: str, item: str) -> DataFrame:
    """A row for each item of an array, numbered from 0.

    Of a plain explode Spark infers that the array is there and not empty, and
    asks so below the step that makes it, which then is made three times. The
    outer form is spared that, and its rows without an item go here.
    """
    return rows.select("*", F.posexplode_outer(array).alias(number, item)).filter(F.col(number).isNotNull())


def triples(rows: DataFrame, subject: Column, statements: list[tuple[str, Column, str]]) -> DataFrame:
    """s, p, o, kind: one row for each statement whose object is there. statements: predicate, object, kind (iri, string, date, integer, decimal or @lang)."""
    return _told(rows.select(subject.alias("s"), _made([(p, o.cast("string"), kind) for p, o, kind in statements]).alias("_l")))


def _made(statements: list[tuple[str, Column, str]]) -> Column:
    made = F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("kind")) for p, o, kind in statements])
    return F.filter(made, lambda t: t["o"].isNotNull())


def _told(stated: DataFrame) -> DataFrame:
    return each(stated, "_l", "_n", "t").select("s", "t.p", "t.o", "t.kind")


def triple_set(*parts: tuple[DataFrame, Column, list[tuple[str, Column, str]]]) -> DataFrame:
    """The triples of all parts, each once. parts: what ``triples`` takes.

    A subject's rows meet before their statements are told apart, so a row is
    moved once, as its objects alone; subjects with many rows are best made
    distinct before.
    """
    moved = [rows.select(subject.alias("s"), F.lit(i).alias("_part"), F.array(*[o.cast("string") for _, o, _ in statements]).alias("_o")) for i, (rows, subject, statements) in enumerate(parts)]
    met = reduce(DataFrame.unionByName, moved).repartition("s")
    made = [F.when(F.col("_part") == i, _made([(p, F.get("_o", F.lit(j)), kind) for j, (p, _, kind) in enumerate(statements)])) for i, (_, _, statements) in enumerate(parts)]
    return _told(met.select("s", F.coalesce(*made).alias("_l"))).dropDuplicates()


def rewrite(graph: DataFrame, same: DataFrame) -> DataFrame:
    """Subjects and IRI objects replaced by their canonical form. same: variant, canonical."""
    s = same.select(F.col("variant").alias("_s"), F.col("canonical").alias("_cs"))
    o = same.select(F.col("variant").alias("_o"), F.col("canonical").alias("_co"))
    joined = graph.join(s, F.col("s") == F.col("_s"), "left").join(o, (F.col("o") == F.col("_o")) & (F.col("kind") == "iri"), "left")
    return joined.select(F.coalesce("_cs", "s").alias("s"), "p", F.coalesce("_co", "o").alias("o"), "kind").dropDuplicates()
