"""Shape constraints on a table of triples (s, p, o, kind): each gives a row for each breach."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPE = "rdf:type"


def _report(focus: DataFrame, path: str, constraint: str, severity: str, message: str) -> DataFrame:
    return focus.select("focus", F.lit(path).alias("path"), F.lit(constraint).alias("constraint"), F.lit(severity).alias("severity"), F.lit(message).alias("message"))


def focus_nodes(graph: DataFrame, *classes: str) -> DataFrame:
    return graph.filter((F.col("p") == TYPE) & F.col("o").isin(*classes)).select(F.col("s").alias("focus")).distinct()


def objects_of(graph: DataFrame, path: str) -> DataFrame:
    return graph.filter(F.col("p") == path).select(F.col("o").alias("focus")).distinct()


def counts(graph: DataFrame, focus: DataFrame, *paths: str) -> DataFrame:
    """focus, n: values over one path or any of several; zero where there are none."""
    n = graph.filter(F.col("p").isin(*paths)).groupBy(F.col("s").alias("focus")).agg(F.count("*").alias("n"))
    return focus.join(n, "focus", "left").select("focus", F.coalesce("n", F.lit(0)).alias("n"))


def cardinality(graph: DataFrame, focus: DataFrame, paths: list[str], least: int = 0, most: int | None = None, severity: str = "Violation") -> DataFrame:
    n = counts(graph, focus, *paths)
    out = [_report(n.filter(F.col("n") < least), "|".join(paths), "minCount", severity, f"at least {least}")]
    if most is not None:
        out.append(_report(n.filter(F.col("n") > most), "|".join(paths), "maxCount", severity, f"at most {most}"))
    return reduce(DataFrame.union, out)


def values(graph: DataFrame, focus: DataFrame, path: str, ok: Column, constraint: str, severity: str = "Violation", message: str = "") -> DataFrame:
    """Breaches of a test on each value: in, pattern, datatype, range, node kind. ok is over o and kind; null fails."""
    held = graph.filter(F.col("p") == path).join(focus, F.col("s") == F.col("focus"))
    return _report(held.filter(~F.coalesce(ok, F.lit(False))).select("focus"), path, constraint, severity, message)


def object_class(graph: DataFrame, focus: DataFrame, path: str, classes: list[str], severity: str = "Violation") -> DataFrame:
    held = graph.filter(F.col("p") == path).join(focus, F.col("s") == F.col("focus")).select("focus", "o")
    typed = focus_nodes(graph, *classes).select(F.col("focus").alias("_t"))
    return _report(held.join(typed, F.col("o") == F.col("_t"), "left_anti").select("focus"), path, "class", severity, " or ".join(classes))


def has_value(graph: DataFrame, focus: DataFrame, path: str, value: str, severity: str = "Violation") -> DataFrame:
    held = graph.filter((F.col("p") == path) & (F.col("o") == value)).select(F.col("s").alias("focus"))
    return _report(focus.join(held, "focus", "left_anti"), path, "hasValue", severity, value)


def any_path(graph: DataFrame, focus: DataFrame, paths: list[str], severity: str = "Violation") -> DataFrame:
    """At least one of several paths has a value."""
    return _report(counts(graph, focus, *paths).filter("n = 0"), "|".join(paths), "or", severity, "one of them")


def not_after(graph: DataFrame, focus: DataFrame, first: str, then: str, severity: str = "Violation") -> DataFrame:
    """Breach where the second value is not after the first one."""
    side = lambda p, name: graph.filter(F.col("p") == p).select(F.col("s").alias("focus"), F.col("o").alias(name))
    both = focus.join(side(first, "_a"), "focus").join(side(then, "_b"), "focus")
    return _report(both.filter("_b <= _a").select("focus"), f"{first}|{then}", "order", severity, f"{then} after {first}")


def by_severity(report: DataFrame) -> DataFrame:
    """severity, path, constraint, n with the severities' order."""
    rank = F.when(F.col("severity") == "Violation", 0).when(F.col("severity") == "Warning", 1).otherwise(2)
    return report.groupBy("severity", "path", "constraint").agg(F.count("*").alias("n")).withColumn("rank", rank)


class Shape:
    """Constraints on the nodes of a class, counted in one pass: a group for each subject, a conditional count for each test.

    Every method adds a test; ``report`` gives severity, path, constraint and n. The functions above give the breaches one by one.
    """

    def __init__(self, *classes: str):
        self.classes = classes
        self.counts: dict[str, Column] = {}
        self.tests: list[tuple[str, str, str, Column]] = []
        self.objects: list[tuple[str, tuple[str, ...], str]] = []

    def _count(self, test: Column) -> Column:
        name = f"_n{len(self.counts)}"
        self.counts[name] = F.count_if(F.coalesce(test, F.lit(False)))
        return F.col(name)

    def _add(self, severity: str, path: str, constraint: str, n: Column) -> Shape:
        self.tests.append((severity, path, constraint, n.cast("long")))
        return self

    def cardinality(self, paths: list[str], least: int = 0, most: int | None = None, severity: str = "Violation") -> Shape:
        n = self._count(F.col("p").isin(*paths))
        if most is not None:
            self._add(severity, "|".join(paths), "maxCount", n > most)
        return self._add(severity, "|".join(paths), "minCount", n < least)

    def values(self, path: str, ok: Column, constraint: str, severity: str = "Violation") -> Shape:
        return self._add(severity, path, constraint, self._count((F.col("p") == path) & ~F.coalesce(ok, F.lit(False))))

    def object_class(self, path: str, *classes: str, severity: str = "Violation") -> Shape:
        self.objects.append((path, classes, severity))
        return self

    def has_value(self, path: str, value: str, severity: str = "Violation") -> Shape:
        return self._add(severity, path, "hasValue", self._count((F.col("p") == path) & (F.col("o") == value)) == 0)

    def any_path(self, paths: list[str], severity: str = "Violation") -> Shape:
        return self._add(severity, "|".join(paths), "or", self._count(F.col("p").isin(*paths)) == 0)

    def not_after(self, first: str, then: str, severity: str = "Violation") -> Shape:
        names = f"_a{len(self.counts)}", f"_b{len(self.counts)}"
        for name, path in zip(names, (first, then), strict=True):
            self.counts[name] = F.collect_list(F.when(F.col("p") == path, F.col("o")))
        pairs = F.aggregate(names[0], F.lit(0), lambda acc, a: acc + F.size(F.filter(names[1], lambda b: b <= a)))
        return self._add(severity, f"{first}|{then}", "order", pairs)

    def report(self, graph: DataFrame) -> DataFrame:
        own = (F.col("p") == TYPE) & F.col("o").isin(*self.classes)
        nodes = graph.groupBy("s").agg(F.max(own).alias("_own"), *[c.alias(n) for n, c in self.counts.items()]).filter("_own")
        made = F.array(*[F.struct(F.lit(s).alias("severity"), F.lit(p).alias("path"), F.lit(c).alias("constraint"), F.coalesce(n, F.lit(0)).alias("n")) for s, p, c, n in self.tests])
        rows = nodes.select(F.explode(F.filter(made, lambda t: t["n"] > 0)).alias("t")).select("t.*")
        for path, classes, severity in self.objects:
            held = graph.filter(F.col("p") == path).join(focus_nodes(graph, *self.classes), F.col("s") == F.col("focus"), "left_semi").groupBy("o").agg(F.count("*").alias("n"))
            wrong = held.join(focus_nodes(graph, *classes), F.col("o") == F.col("focus"), "left_anti")
            rows = rows.union(wrong.select(F.lit(severity), F.lit(path), F.lit("class"), "n"))
        rank = F.when(F.col("severity") == "Violation", 0).when(F.col("severity") == "Warning", 1).otherwise(2)
        return rows.groupBy("severity", "path", "constraint").agg(F.sum("n").alias("n")).withColumn("rank", rank)
