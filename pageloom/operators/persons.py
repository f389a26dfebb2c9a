"""Spellings of persons: which mean the same one, rule by rule.

Names are contracted in stages. After each stage every name carries the label of
its cluster, and later stages see what the cluster has become: its uses and
whether it holds a full name. A stage is joins and windows over names; a surname
with many names is no group that has to fit a task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.functions.names import completeness, is_gendered, person_key, person_parts
from pageloom.operators.graph import chain_ends, components, settled

_ROW = ("variant", "canonical", "rule", "status", "n_variant", "n_canonical", "detail")
#: Surnames shorter than this are too common to stand for a person.
LEAST_SURNAME = 4


@dataclass
class Persons:
    """members: name, label (of the cluster), canonical, uses. rows: the merges and the candidates for review."""

    members: DataFrame
    rows: DataFrame


def _told(names: DataFrame) -> DataFrame:
    """names with key, surname, initials, firsts, gendered and ``so``: the least name of the surname, by which surnames come in order."""
    keyed = names.select("name", F.col("uses").cast("long").alias("uses"), "authority", person_key(F.col("name")).alias("key"))
    parts = person_parts(F.col("key"))
    told = keyed.select("*", is_gendered(F.col("key")).alias("gendered"), *[parts[c].alias(c) for c in ("surname", "initials", "firsts")])
    orders = told.filter("surname <> ''").groupBy("surname").agg(F.min("name").alias("so"))
    return settled(told.join(orders, "surname", "left"))


def _labelled(told: DataFrame, labels: DataFrame) -> DataFrame:
    """told with label, cluster_uses, and ``full``: the cluster holds a full name. labels: name, label."""
    both = told.join(labels, "name")
    clusters = both.groupBy("label").agg(F.sum("uses").alias("cluster_uses"), F.max(F.size("firsts") > 0).alias("full"))
    return settled(both.join(clusters, "label"))


def _moved(labels: DataFrame, moves: DataFrame, chained: bool = False) -> DataFrame:
    """labels with clusters moved. moves: old, new; chained: a cluster may move to one that moves itself."""
    if chained:
        ends = chain_ends(moves.select(F.col("old").alias("variant"), F.col("new").alias("canonical")))
        moves = ends.select(F.col("variant").alias("old"), F.col("canonical").alias("new"))
    joined = labels.join(moves.select(F.col("old").alias("_o"), F.col("new").alias("_n")), F.col("label") == F.col("_o"), "left")
    return settled(joined.select("name", F.coalesce("_n", "label").alias("label")))


def _by_authority(now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(moves, rules): clusters whose names have one authority id; forms of address only among themselves. The first name's cluster takes the others in."""
    known = now.filter("authority is not null and authority <> ''")
    heads = known.groupBy("authority", "gendered", "label").agg(F.min("name").alias("name"))
    first = heads.groupBy("authority", "gendered").agg(F.min_by("label", "name").alias("head"))
    edges = settled(heads.join(first, ["authority", "gendered"]).filter("label <> head").select("head", "label", "name"))
    found = components(edges, "head", "label")
    # the label of a component is a head's
    roots = found.join(edges.select(F.col("head").alias("node")).distinct(), "node", "left_semi").groupBy("component").agg(F.min("node").alias("new"))
    moves = found.join(roots, "component").select(F.col("node").alias("old"), "new").filter("old <> new")
    return moves, edges.select("name", F.lit("wikidata").alias("rule")).distinct()


def _fits(now: DataFrame) -> DataFrame:
    """Each (name, cluster) of initials and a full name that they fit, with what deciding needs."""
    open_ = now.filter((F.size("initials") > 0) & (F.size("firsts") == 0) & ~F.col("gendered") & (F.length("surname") >= LEAST_SURNAME) & ~F.col("full"))
    open_ = open_.select("name", "so", "surname", "initials", F.col("label").alias("own"), F.col("cluster_uses").alias("own_uses"), F.element_at("initials", 1).alias("_i"))
    full = now.filter((F.size("firsts") > 0) & ~F.col("gendered")).select("surname", F.col("firsts").alias("_firsts"), F.col("label").alias("c"), F.col("cluster_uses").alias("base"))
    full = full.withColumn("_i", F.explode(F.array_distinct(F.transform("_firsts", lambda f: F.left(f, F.lit(1))))))
    fit = F.forall("initials", lambda i: F.exists("_firsts", lambda f: f.startswith(i)))
    return open_.join(full, ["surname", "_i"]).filter(fit).select("name", "so", "own", "own_uses", F.array_join("initials", "").alias("letters"), "c", "base").distinct()


def _dominant(top: Column, second: Column, least: int, ratio: float) -> Column:
    return (top >= least) & (top >= ratio * F.greatest(F.coalesce(second, F.lit(0)), F.lit(1)))


def _decide_initials(fits: DataFrame, least: int, ratio: float) -> DataFrame:
    """fits with ``chosen`` and ``rule``: names are decided in order, and each sees the uses that those before it have brought to a cluster.

    What a name decides follows from the decisions before it, so repeating the
    stage until nothing changes gives what taking the names one by one would.
    """
    order = ["so", "name"]
    before = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    now = settled(fits.withColumn("chosen", F.lit(False)))
    while True:
        grown = now.withColumn("_uses", F.col("base") + F.coalesce(F.sum(F.when(F.col("chosen"), F.col("own_uses")).otherwise(0)).over(before("c")), F.lit(0)))
        rank = Window.partitionBy("name").orderBy(F.desc("_uses"), "c")
        ranked = grown.withColumns({"_n": F.count("*").over(Window.partitionBy("name")), "_r": F.row_number().over(rank), "_second": F.lead("_uses").over(rank)})
        rule = F.when(F.col("_n") == 1, "initial-unique").when(_dominant(F.col("_uses"), F.col("_second"), least, ratio), "dominant")
        ranked = ranked.withColumn("rule", F.when(F.col("_r") == 1, rule))
        # the first name of a cluster that finds a full one settles it for the others
        firsts = F.min(F.when(F.col("rule").isNotNull(), F.struct(*order))).over(Window.partitionBy("own"))
        chosen = F.col("rule").isNotNull() & (F.struct(*order) == firsts)
        step = settled(ranked.withColumn("_chosen", chosen))
        if step.filter("chosen <> _chosen").isEmpty():
            return step.select(*fits.columns, "chosen", F.when(F.col("chosen"), F.col("rule")).alias("rule"), F.col("_n").alias("n"))
        now = step.select(*fits.columns, F.col("_chosen").alias("chosen"))


def _bare(now: DataFrame, done: DataFrame | None, least: int, ratio: float) -> DataFrame:
    """One step of every surname that stands alone: its next spelling, the other clusters of the surname, and which one takes it.

    done: surname, steps; without it each surname is at its first spelling.
    """
    long_ = (F.length("surname") >= LEAST_SURNAME) & ~F.col("gendered")
    alone = now.filter((F.size("initials") == 0) & (F.size("firsts") == 0) & long_ & ~F.col("full")).select("surname", "name", "so", F.col("label").alias("own"))
    place = F.row_number().over(Window.partitionBy("surname").orderBy("name"))
    if done is None:
        next_ = alone.groupBy("surname").agg(F.min_by(F.struct("name", "so", "own"), "name").alias("s")).select("surname", "s.*", F.lit(1).alias("steps"))
    else:
        next_ = alone.withColumn("_p", place).join(done, "surname").filter("_p = steps + 1").select("surname", "name", "so", "own", F.col("_p").alias("steps"))
    others = now.filter(long_).select("surname", F.col("label").alias("c"), F.col("cluster_uses").alias("_uses")).distinct()
    pairs = next_.join(others, "surname").filter("c <> own")
    rank = Window.partitionBy("surname").orderBy(F.desc("_uses"), "c")
    ranked = pairs.withColumns({"n": F.count("*").over(Window.partitionBy("surname")), "_r": F.row_number().over(rank), "_second": F.lead("_uses").over(rank)})
    rule = F.when(F.col("n") == 1, "surname-unique").when(_dominant(F.col("_uses"), F.col("_second"), least, ratio), "dominant")
    return settled(ranked.select("surname", "name", "so", "own", "steps", "c", "n", F.when(F.col("_r") == 1, rule).alias("rule")))


def resolve_persons(names: DataFrame, manual: DataFrame | None = None, diarist: str | None = None, least: int = 5, ratio: float = 5.0, bare_surnames: bool = True) -> Persons:
    """Clusters of the names of one person, and the rows of their merges.

    names: name, uses and, where it is known, authority (an id of an authority
    file); a name is one row. The rules, in order: ``same-key`` (alike without
    titles, umlauts spelled out, punctuation away), ``wikidata`` (one authority id),
    ``initial-unique`` and ``dominant`` (initials that fit one full name, or one of
    at least ``least`` uses that is used ``ratio`` times as often as the next),
    ``surname-unique`` and ``dominant`` (a surname alone, with one other person of
    that surname or a dominant one), ``manual`` (pairs that a reviewer added:
    variant, canonical). Forms of address stay persons of their own; surnames of
    less than four letters, and clusters that hold a full name, are not merged
    into others. Pairs that stay open are candidates between clusters, under
    their canonical names. The canonical name is the diarist's, or the most
    complete one, of equals the least.

    Of several names with one surname each sees what those before it did. Where an
    authority id joins names over two surnames, both surnames' bare forms are
    decided by the uses at the start of a step. No names give no rows.
    """
    if "authority" not in names.columns:
        names = names.withColumn("authority", F.lit(None).cast("string"))
    told = _told(names.filter(F.col("name").isNotNull()))
    same = told.groupBy("key").agg(F.min("name").alias("label"))
    labels = settled(told.join(same, "key").select("name", "label"))
    rules = [labels.filter("name <> label").select("name", F.lit("same-key").alias("rule"), F.lit(1).alias("at"))]
    moves, said = _by_authority(_labelled(told, labels))
    labels = _moved(labels, moves)
    rules.append(said.withColumn("at", F.lit(2)))
    decided = _decide_initials(_fits(_labelled(told, labels)), least, ratio)
    chosen = decided.filter("chosen")
    labels = _moved(labels, chosen.select(F.col("own").alias("old"), F.col("c").alias("new")))
    rules.append(chosen.select("name", "rule", F.lit(3).alias("at")))
    text = F.concat(F.lit("initials "), F.col("letters"), F.lit(" match several full names"))
    found = decided.groupBy("name").agg(F.max("chosen").alias("_any")).filter("not _any").select("name")
    open_ = [decided.join(found, "name", "left_semi").filter("n > 1").select("name", "so", "c", F.lit("initial-ambiguous").alias("rule"), text.alias("detail"), F.lit(3).alias("at"))]
    done, at = None, 4
    while bare_surnames:
        step = _bare(_labelled(told, labels), done, least, ratio)
        hit = step.filter("rule is not null")
        lost = step.join(hit.select("surname"), "surname", "left_anti")
        text = F.concat(F.lit("bare surname; "), F.col("n").cast("string"), F.lit(" persons share it"))
        open_.append(lost.select("name", "so", "c", F.lit("surname-ambiguous").alias("rule"), text.alias("detail"), F.lit(at).alias("at")))
        if hit.isEmpty():
            break
        rules.append(hit.select("name", "rule", F.lit(at).alias("at")))
        labels = _moved(labels, hit.select(F.col("own").alias("old"), F.col("c").alias("new")), chained=True)
        done, at = hit.select("surname", "steps"), at + 1
    pending = settled(reduce(DataFrame.union, open_))
    if manual is not None:
        asked = manual.select(F.trim("variant").alias("variant"), F.trim("canonical").alias("canonical")).distinct()
        asked = asked.join(pending.select(F.col("name").alias("variant"), F.col("c").alias("canonical")), ["variant", "canonical"], "left_anti")
        side = lambda c: labels.select(F.col("name").alias(c), F.col("label").alias(f"_{c}"))
        asked = settled(asked.join(side("variant"), "variant").join(side("canonical"), "canonical").filter("_variant <> _canonical"))
        rules.append(asked.select(F.col("variant").alias("name"), F.lit("manual").alias("rule"), F.lit(1 << 20).alias("at")).distinct())
        groups = components(asked, "_variant", "_canonical").select(F.col("node").alias("old"), F.col("component").alias("new")).filter("old <> new")
        labels = _moved(labels, groups)
    return _rows(_labelled(told, labels), settled(reduce(DataFrame.union, rules)), pending, diarist)


def _rows(now: DataFrame, rules: DataFrame, pending: DataFrame, diarist: str | None) -> Persons:
    """The merges of each cluster into its canonical name, and the pairs of clusters that stay open."""
    best = F.struct(F.lit(diarist).eqNullSafe(F.col("name")).alias("own"), completeness(F.col("name"), F.col("key"), F.col("uses")).alias("rank"))
    tops = now.groupBy("label").agg(F.max(best).alias("_best"))
    held = now.join(tops, "label").filter(best == F.col("_best")).groupBy("label").agg(F.min("name").alias("canonical"))
    members = settled(now.join(held, "label").select("name", "label", "canonical", "uses", "cluster_uses", "full"))
    last = rules.groupBy("name").agg(F.max_by("rule", "at").alias("rule"))
    uses = members.select(F.col("name").alias("canonical"), F.col("uses").alias("n_canonical")).join(last.select(F.col("name").alias("canonical"), F.col("rule").alias("_theirs")), "canonical", "left")
    merged = members.filter("name <> canonical").join(last, "name", "left").join(uses, "canonical")
    merged = merged.select(F.col("name").alias("variant"), "canonical", F.coalesce("rule", "_theirs", F.lit("same-key")).alias("rule"), F.lit("auto").alias("status"), F.col("uses").alias("n_variant"), "n_canonical", F.lit("").alias("detail"))
    mine = members.select("name", F.col("label").alias("_l"), F.col("canonical").alias("variant"), F.col("cluster_uses").alias("n_variant"), "full")
    theirs = members.select(F.col("name").alias("c"), F.col("label").alias("_k"), "canonical", F.col("cluster_uses").alias("n_canonical"))
    pairs = pending.join(mine, "name").join(theirs, "c").filter("_l <> _k and not full")
    first = pairs.groupBy("variant", "canonical", "n_variant", "n_canonical").agg(F.min_by(F.struct("rule", "detail"), F.struct("at", "so", "name")).alias("_f"))
    asked = first.select("variant", "canonical", "_f.rule", F.lit("candidate").alias("status"), "n_variant", "n_canonical", "_f.detail")
    return Persons(members.select("name", "label", "canonical", "uses"), merged.select(*_ROW).union(asked.select(*_ROW)))


def decided_persons(found: Persons, decisions: DataFrame) -> DataFrame:
    """variant, canonical of the merges that hold, chains followed. decisions: variant, canonical, decision.

    An automatic merge holds unless its own pair was rejected. A candidate holds if
    it was accepted, under its own names or, where those have no decision, under
    others of the two clusters (the first by name counts); a variant goes to the
    first accepted one.
    """
    yes, no = ("y", "yes", "merge", "1", "accept"), ("n", "no", "0", "reject", "keep", "separate")
    said = decisions.select(F.col("variant").alias("v"), F.col("canonical").alias("c"), F.lower(F.trim("decision")).alias("said")).filter("said <> ''")
    own = found.rows.join(said, (F.col("variant") == F.col("v")) & (F.col("canonical") == F.col("c")), "left").drop("v", "c")
    auto = own.filter("status = 'auto'").filter(~F.coalesce(F.col("said").isin(*no), F.lit(False))).select("variant", "canonical")
    # decisions as pairs of clusters, each named by its canonical
    side = lambda a, b: found.members.select(F.col("name").alias(a), F.col("canonical").alias(b))
    pairs = said.join(side("v", "variant"), "v").join(side("c", "canonical"), "c")
    order = F.struct(F.col("v") != F.col("variant"), "v", F.col("c") != F.col("canonical"), "c")
    alias = pairs.groupBy("variant", "canonical").agg(F.min_by("said", order).alias("_alias"))
    asked = own.filter("status = 'candidate'").join(alias, ["variant", "canonical"], "left").filter(F.coalesce("said", "_alias").isin(*yes))
    taken = asked.groupBy("variant").agg(F.min("canonical").alias("canonical"))
    return chain_ends(auto.union(taken.select("variant", "canonical")))
