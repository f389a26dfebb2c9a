import random
import re

import pytest

from pageloom.functions.names import DESCRIPTION, GENDERED
from pageloom.operators.persons import decided_persons, resolve_persons
from pageloom.operators.resolve import group_merges, inherit

NAMES = "name string, uses int, authority string"


def test_group_merges(spark):
    n = spark.createDataFrame([("Storch", 2, "k"), ("Störche", 1, "k"), ("Storch.", 2, "k"), ("Wied", 1, None)], "name string, uses int, key string")
    assert {(r.variant, r.canonical) for r in group_merges(n, "key", "x").collect()} == {("Störche", "Storch"), ("Storch.", "Storch")}
    p = spark.createDataFrame([("a", 5, "k", None), ("b", 3, "k", 1.5), ("c", 1, "k", 2.5)], "name string, uses int, key string, lat double")
    assert inherit(p, "key", "lat").first().lat == 1.5


def rows_of(spark, names, **more):
    names = [(*n, None)[:3] for n in names]
    return {(r.variant, r.canonical): (r.rule, r.status) for r in resolve_persons(spark.createDataFrame(names, NAMES), **more).rows.collect()}


def test_person_merges(spark):
    got = rows_of(spark, [
        ("Walter Wüst", 9), ("Dr. Walter Wüst", 3), ("W. Wüst", 2), ("Wüst", 4), ("Adolf Müller", 50), ("Arno Müller", 2), ("Müller", 7), ("A. Müller", 3),
        ("Karl Kiefer", 2), ("Kurt Kiefer", 2), ("Kiefer", 5), ("Frau Kiefer", 1), ("Schuster", 3), ("Frau Anna Huber", 4), ("A. Huber", 1), ("Karl Lie", 5), ("K. Lie", 1),
        ("Anton Karl Maier", 3), ("K. Maier", 1), ("H. Noll", 2), ("Noll", 6),
    ])
    assert got == {
        ("Dr. Walter Wüst", "Walter Wüst"): ("same-key", "auto"), ("W. Wüst", "Walter Wüst"): ("initial-unique", "auto"), ("Wüst", "Walter Wüst"): ("surname-unique", "auto"),
        ("A. Müller", "Adolf Müller"): ("dominant", "auto"), ("Müller", "Adolf Müller"): ("dominant", "auto"),
        ("Kiefer", "Karl Kiefer"): ("surname-ambiguous", "candidate"), ("Kiefer", "Kurt Kiefer"): ("surname-ambiguous", "candidate"),
        ("K. Maier", "Anton Karl Maier"): ("initial-unique", "auto"), ("Noll", "H. Noll"): ("surname-unique", "auto"),
    }


def plain(names, manual=(), diarist=None, least=5, ratio=5.0):
    """The rules taken name by name: a cluster is a list of its names, and joining is list addition."""
    use = {n: u for n, u, _ in names}
    order = sorted(use)
    titles = r"^(?:(?:dr|prof|herr)\.?\s+)+"

    def key(n):
        k = re.sub(titles, "", re.sub(r"\.", ". ", n.strip()), flags=re.I).lower()
        for a, b in ("äa", "öo", "üu"):
            k = k.replace(a, b + "e")
        k = k.replace("ß", "ss").replace("st. ", "sankt ").replace("st.", "sankt ")  # also at the end of a surname
        return " ".join(re.sub(r"[^\w\s]", " ", k).split())

    words = {n: key(n).split() for n in order}
    ini = {n: [w for w in words[n][:-1] if len(w) == 1] for n in order}
    first = {n: [w for w in words[n][:-1] if len(w) > 1 and w not in GENDERED] for n in order}
    lady = {n: words[n][0] in GENDERED for n in order}
    home = {n: [n] for n in order}
    rule = {}

    def join(into, other, why):
        a, b = home[into], home[other]
        if a is not b:
            a += b
            for n in b:
                home[n] = a
            rule[other] = why

    def total(c):
        return sum(use[n] for n in c)

    def whole(c):
        return any(first[n] for n in c)

    def apart(cs):
        return list({id(c): c for c in cs}.values())

    def top(cs):
        cs = sorted(cs, key=total, reverse=True)
        second = total(cs[1]) if len(cs) > 1 else 0
        return cs[0] if total(cs[0]) >= least and total(cs[0]) >= ratio * max(second, 1) else None

    for n in order:
        join(next(m for m in order if words[m] == words[n]), n, "same-key")
    for q in sorted({q for _, _, q in names if q}):
        for kind in (False, True):
            group = [n for n in order if lady[n] == kind and (n, use[n], q) in names]
            for n in group[1:]:
                join(group[0], n, "wikidata")
    open_ = []
    surnames = list(dict.fromkeys(words[n][-1] for n in order))
    for s in surnames:
        mine = [n for n in order if words[n][-1] == s]
        for n in mine:
            if ini[n] and not first[n] and not lady[n] and len(s) >= 4 and not whole(home[n]):
                cs = apart(home[m] for m in mine if first[m] and not lady[m] and all(any(f[0] == i for f in first[m]) for i in ini[n]))
                if cs:
                    c = cs[0] if len(cs) == 1 else top(cs)
                    if c is None:
                        open_ += [(n, x[0], "initial-ambiguous", f"initials {''.join(ini[n])} match several full names") for x in cs]
                    else:
                        join(c[0], n, "initial-unique" if len(cs) == 1 else "dominant")
    for s in surnames:
        mine = [n for n in order if words[n][-1] == s and not lady[n]]
        for n in mine:
            if not ini[n] and not first[n] and len(s) >= 4 and not whole(home[n]):
                cs = [c for c in apart(home[m] for m in mine) if c is not home[n]]
                if cs:
                    c = cs[0] if len(cs) == 1 else top(cs)
                    if c is None:
                        open_ += [(n, x[0], "surname-ambiguous", f"bare surname; {len(cs)} persons share it") for x in cs]
                    else:
                        join(c[0], n, "surname-unique" if len(cs) == 1 else "dominant")
    for v, c in manual:
        if v in use and c in use and not any(x[:2] == (v, c) for x in open_):
            join(c, v, "manual")
    rank = lambda n: (not lady[n], not any(w in DESCRIPTION for w in words[n]), len(first[n]), sum(map(len, first[n])) + len(ini[n]), use[n], sum(c in "äöüÄÖÜß" for c in n), not re.search(r"\.[^\s.]", n), -len(n))
    best = {id(c): diarist if diarist in c else max(sorted(c), key=rank) for c in home.values()}
    rows = {(n, b, rule.get(n) or rule.get(b) or "same-key", "auto", use[n], use[b], "") for n in order if (b := best[id(home[n])]) != n}
    seen = {}
    for n, c, why, text in open_:
        a, b = home[n], home[c]
        if a is not b and not whole(a):
            seen.setdefault((best[id(a)], best[id(b)]), (why, "candidate", total(a), total(b), text))
    return rows | {(*k, *v) for k, v in seen.items()}


@pytest.mark.parametrize("seed", range(4))
def test_random_names_against_the_rules_one_by_one(spark, seed):
    chance = random.Random(seed)
    surnames = chance.sample(["Wüst", "Müller", "Kiefer", "Lie", "Noll", "Maier"], 4)
    firsts = ["Adolf", "Arno", "Karl", "Kurt", "Walter", "Anton Karl", "Karl Adolf", "A.", "K.", "W.", "A. K.", "A.K.", "", "", "Dr.", "Prof. Dr.", "Herr", "Frau", "Frl.", "Frau Anna", "Dr. A.", "Sohn von"]
    names = {f"{chance.choice(firsts)} {chance.choice(surnames)}{chance.choice(['', '', '', '.', ' '])}".lstrip() for _ in range(34)}
    uses = lambda: chance.choice([1, 1, 2, 3, 6, 20, 90])
    # an id stays within a surname: over two of them, steps are decided together
    rows = [(n, uses(), chance.choice([None] * 6 + ["Q1", "Q2"]) and f"{n.rstrip('. ').split()[-1]}{chance.randrange(2)}" if chance.random() < 0.3 else None) for n in sorted(names)]
    rows = [(n, u, q if n and len({re.sub(r'[. ]+$', '', m).split()[-1] for m, _, p in rows if p == q}) == 1 else None) for n, u, q in rows]
    keys = {}
    for i, (n, u, q) in enumerate(rows):  # and a key has one id
        k = re.sub(r"\W", "", re.sub(r"^(?:(?:dr|prof|herr)\.?\s+)+", "", n, flags=re.I)).lower()
        rows[i] = (n, u, keys.setdefault(k, q))
    manual = [tuple(chance.sample(sorted(names), 2))]
    diarist = chance.choice(sorted(names))
    found = resolve_persons(spark.createDataFrame(rows, NAMES), spark.createDataFrame(manual, "variant string, canonical string"), diarist=diarist)
    got = {tuple(r) for r in found.rows.collect()}
    want = plain(rows, manual, diarist)
    assert got == want, (sorted(got - want), sorted(want - got))


def test_decisions_on_persons(spark):
    names = [("Adolf Müller", 2, None), ("Alois Müller", 2, None), ("A. Müller", 1, None), ("Dr. A. Müller", 1, None), ("Karl Kiefer", 1, None), ("K. Kiefer", 1, None)]
    found = resolve_persons(spark.createDataFrame(names, NAMES))
    said = [("Dr. A. Müller", "Adolf Müller", "y"), ("A. Müller", "Alois Müller", "n"), ("K. Kiefer", "Karl Kiefer", " Reject ")]
    held = {tuple(r) for r in decided_persons(found, spark.createDataFrame(said, "variant string, canonical string, decision string")).collect()}
    assert held == {("Dr. A. Müller", "Adolf Müller"), ("A. Müller", "Adolf Müller")}
    none = resolve_persons(spark.createDataFrame([], NAMES))
    assert none.rows.count() == 0 and decided_persons(none, spark.createDataFrame(said, "variant string, canonical string, decision string")).count() == 0
