import random
import zlib

import pytest
from pyspark.sql import functions as F

from pageloom.operators import aggregates, graph, lookup, ordered, pairs
from pageloom.sinks import archive
from pageloom.sinks.graph import ntriples, read_ntriples


def test_year_repair(spark):
    dates = ["1951-04-01", "1951-04-05", "1901-04-07", "1951-04-09", "1951-04-12"]
    rows = [(23, i, d, "field-day", d, False) for i, d in enumerate(dates)]
    rows += [(24, 0, "1951-04-05", "field-day", None, False), (24, 1, "1859-04-12", "species-digest", "12. IV. 1859", True), (24, 2, "1951-04-09", "field-day", None, False)]
    rows += [(23, 5, "1932-11-16", "species-digest", "16. XI. 1932", False), (25, 0, "1850-01-01", "other", "1850", False), (99, 0, "1900-01-01", "other", None, False)]
    e = spark.createDataFrame(rows, "volume int, ord int, entry_date string, kind string, verbatim string, historic boolean")
    spans = spark.createDataFrame([(23, "1951-03", "1951-12"), (24, "1951-03", "1951-12"), (25, "1920-01", "1925-12")], "volume int, start string, end string")
    got = {(r.volume, r.ord): (r.reason, r.new_date, r.new_end) for r in ordered.repair_years(e, spans).collect()}
    assert got[23, 2] == ("date_year_corrected", "1951-04-07", None)
    assert got[24, 1] == ("date_from_position", "1951-04-05", "1951-04-09")
    assert got[23, 5][0] == "date_out_of_coverage" and got[25, 0][0] == "date_out_of_span"
    assert got[99, 0] == (None, "1900-01-01", None) and got[23, 0][0] is None


def test_year_repair_takes_every_entry(spark):
    from pageloom.plans.model import entries
    from pageloom.plans.ordered import year_repair

    sf = "/root/testdata/sf0.001"
    rows = year_repair(spark, sf).collect()
    assert sum(r.n for r in rows) == entries(spark, sf).count()
    assert {None, "date_year_corrected"} <= {r.reason for r in rows}


def test_travel(spark):
    rows = [("e", 0, None, "A", None), ("e", 1, "B", None, None), ("e", 2, "B", "C", None), ("e", 3, None, "D", None), ("f", 0, None, "X", "home")]
    legs = spark.createDataFrame(rows, "event string, pos int, departure string, arrival string, entry_place string")
    got = sorted((r.event, r.pos, r.departure, r.arrival) for r in ordered.travel_departures(legs).collect())
    assert got == [("e", 2, "B", "C"), ("e", 3, "C", "D"), ("f", 0, "home", "X")]


def test_neighbours_do_not_depend_on_partitions(spark):
    rows = [("g", i, str(i) if i % 3 == 0 else None) for i in range(10)]
    for n in (1, 8):
        d = spark.createDataFrame(rows, "g string, o int, v string").repartition(n)
        got = {r.o: r.near for r in ordered.with_valid_neighbours(d, "v", "g", "o", 2, "near").collect()}
        assert got[4] == ["3", "0", "6", "9"] and got[0] == ["3", "6"] and got[9] == ["6", "3"]


def page(uid, text, scan=1, volume=1, number="", dates=(), page_id=None):
    return uid, volume, page_id or uid, scan, number, text, list(dates)


def scored(spark, *pages):
    schema = "uid string, volume int, page_id string, scan int, page_number string, text string, dates array<string>"
    p = pairs.page_features(spark.createDataFrame(list(pages), schema))
    p = p.join(pairs.quality(p.select("uid", "norm"), "uid", "norm").select("uid", "degenerate"), "uid")
    both = spark.createDataFrame([(pages[0][0], pages[1][0])], "a string, b string")
    return pairs.score_pairs(both, p).first()


def test_pair_scores(spark):
    prose = "Am Weiher heute früh zwei Haubentaucher und mehrere Blässhühner, dazu ein Eisvogel am Auslauf; Nebel bis neun Uhr, dann klar."
    other = "Fahrt mit der Bahn nach Oberstdorf, dort Schneefinken am Nebelhorn, abends Regen und kein weiterer Nachweis in der ganzen Umgebung."
    same = scored(spark, page("a", prose, 4, number="58", dates=["1918-04-07"]), page("b", prose, 5, number="p 58.", dates=["1918-04-07"]))
    assert same.confidence > 0.9 and "exact_text" in same.signals and "same_page_number" in same.signals
    assert scored(spark, page("a", prose, 1), page("b", other, 40)).confidence < 0.55
    assert scored(spark, page("a", prose), page("b", f"{prose} {other} {other[::-1]}", 50)).relation == "containment"


def test_sketch_pairs_have_no_bucket_cap(spark):
    from pageloom.functions import similarity

    rng = random.Random(4)
    base = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    texts = [base] * 25 + [f"{base} {i:03d}" for i in range(25)] + ["".join(rng.choice("klmnop") for _ in range(200)) for _ in range(3)] + ["", None]
    d = spark.createDataFrame([(f"p{i:03d}", t) for i, t in enumerate(texts)], "uid string, t string")
    got = [tuple(r) for r in pairs.sketch_pairs(d.select("uid", similarity.shingles(F.coalesce("t", F.lit(""))).alias("s")), "uid", "s").collect()]
    assert len(got) == len(set(got))
    # the first of the 25 equal texts stands for them
    stands = [0, *range(25, 50)]
    assert set(got) == {(f"p{i:03d}", f"p{j:03d}") for j in stands for i in stands if i < j} | {("p000", f"p{j:03d}") for j in range(1, 25)}


def test_shingle_pairs_measure_every_pair(spark, tmp_path):
    from pageloom.plans.documents import shingle_pairs

    rng = random.Random(5)
    base = [rng.choice("abcdefghijklmnop") for _ in range(300)]
    texts = ["".join(base)] * 22 + ["".join(base[:150] + ["z"] * n + base[150:]) for n in range(1, 5)]
    d = spark.createDataFrame([(i, t, "de", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    cut = lambda t: {t[i : i + 5] for i in range(len(t) - 4)}
    got = {(r.a, r.b): r.jaccard for r in shingle_pairs(spark, str(tmp_path)).collect()}
    stands = [0, *range(22, 26)]
    assert set(got) == {(f"p{i}", f"p{j}") for j in stands for i in stands if f"p{i}" < f"p{j}"} | {("p0", f"p{j}") for j in range(1, 22)}
    for (a, b), j in got.items():
        x, y = cut(texts[int(a[1:])]), cut(texts[int(b[1:])])
        assert abs(j - len(x & y) / len(x | y)) < 1e-4


def test_edited_copies_far_apart_are_clustered(spark, tmp_path):
    from pageloom.plans.documents import clustered_pages, scored_page_pairs

    rng = random.Random(6)
    say = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(40))
    base, other = say(), say()
    # edited copies that share no volume, page number or id, and copies three scans apart
    rows = [(1, base, "s"), (1034, base + " and one more", "t"), (3000, other, "u"), (3003, other + " edited", "v"), (5000, say(), "w")]
    spark.createDataFrame([(i, t, "de", s) for i, t, s in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.a, r.b): r for r in scored_page_pairs(spark, str(tmp_path)).collect()}
    assert {("p1", "p1034"), ("p3000", "p3003")} <= set(got)
    assert "same_entry_dates" in got["p1", "p1034"].signals.split(",") and got["p1", "p1034"].confidence > 0.8
    clusters = {r.component: r for r in clustered_pages(spark, str(tmp_path)).collect()}
    assert set(clusters) == {"p1", "p3000"} and clusters["p1"].n_pairs == 1 and clusters["p1"].signals == ",".join(sorted(got["p1", "p1034"].signals.split(",")))


def test_degenerate_pages_against_plain_python(spark):
    rng = random.Random(1)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    texts = [prose(80), "la la la " * 300, "1 2 3 4 " * 100, "ab cd ef " + "x" * 9000, prose(2000), prose(40) * 30, (prose(30) + " ") * 60, "short", "", None, "é " * 150]

    def flags(t):
        n, out = len(t or ""), []
        if n >= 200:
            w = t.split()
            grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
            rep = max((grams.count(g) for g in set(grams)), default=0) / max(len(grams), 1)
            comp = len(zlib.compress(t.encode(), 6)) / n
            out += ["repetition_loop"] * (rep > 0.2 or comp < 0.12 and n > 1000)
            out += ["low_alpha"] * (sum(c.isalpha() or c.isspace() for c in t) / n < 0.6)
            out += ["suspicious_length"] * (n > 8000 and comp < 0.2)
        return out

    d = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: (r.flags, r.degenerate) for r in pairs.quality(d, "id", "t").collect()}
    want = {i: flags(t) for i, t in enumerate(texts)}
    assert {i: x[0] for i, x in got.items()} == want and all(x[1] == bool(want[i]) for i, x in got.items())
    assert {f for x in want.values() for f in x} == {"repetition_loop", "low_alpha", "suspicious_length"}


def test_prefix_pairs_keep_what_the_ratio_allows(spark):
    names = ["abcdefghij", "abcdefghijkl", "abcxxxxxxx", "abcdefghijklmnopq"]
    d = spark.createDataFrame([(n,) for n in names], "k string")
    got = {(r.a, r.b): round(r.ratio, 3) for r in pairs.prefix_pairs(d, "k", 0.9).collect()}
    assert got == {("abcdefghij", "abcdefghijkl"): 0.909}


def test_ranks_over_counted_values(spark):
    rng = random.Random(3)
    rows = [(f"g{i % 3}", rng.randrange(20) if i % 11 else None) for i in range(700)]
    got = {r.g: (r.low, r.high) for r in aggregates.tail_ranks(spark.createDataFrame(rows, "g string, v int"), "g", "v").collect()}
    for g in ("g0", "g1", "g2"):
        own = sorted(v for k, v in rows if k == g and v is not None)
        assert got[g] == (own[int(len(own) * 0.02)], own[min(len(own) - 1, int(len(own) * 0.98))])


def test_longest_common_subsequence():
    from pageloom.functions.similarity import indel

    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                keep, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
                last = keep
        assert indel(a, b) == (2 * row[-1] / (len(a) + len(b)) if a or b else 1.0)


def test_components_and_chains(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a int, b int")
    assert {(r.node, r.component) for r in graph.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
    m = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("z", "z")], "variant string, canonical string")
    assert {(r.variant, r.canonical) for r in graph.chain_ends(m).collect()} == {("a", "c"), ("b", "c"), ("x", "x"), ("y", "x")}


def test_components_move_a_few_times_their_edges(spark, monkeypatch):
    chance = random.Random(5)
    path = list(range(1500))
    chance.shuffle(path)
    pairs = list(zip(path, path[1:], strict=False)) + [(chance.randrange(2000, 3000), chance.randrange(2000, 3000)) for _ in range(600)] + [(4000, n) for n in range(4001, 4400)] + [(5000, 5000)]
    least = {}

    def top(x):
        while least.setdefault(x, x) != x:
            least[x] = least[least[x]]
            x = least[x]
        return x

    for x, y in pairs:
        one, other = sorted((top(x), top(y)))
        least[other] = one
    written, real = [], graph.settled

    def counted(frame):
        written.append(real(frame))
        return written[-1]

    monkeypatch.setattr(graph, "settled", counted)
    edges = spark.createDataFrame([*pairs, *pairs[:50], (None, 1), (7777, None)], "a long, b long")
    assert sorted(map(tuple, graph.components(edges).collect())) == sorted((n, top(n)) for n in list(least))
    assert sum(w.count() for w in written) < 7 * len(pairs)


def test_decisions(spark):
    rows = spark.createDataFrame([("1", "auto"), ("2", "auto"), ("3", "candidate"), ("4", "candidate")], "merge_id string, status string")
    said = spark.createDataFrame([("2", " Reject "), ("4", "YES")], "merge_id string, decision string")
    assert {r.merge_id for r in lookup.applied(rows, said).collect()} == {"1", "4"}


def test_triples_round_trip(spark):
    hard = 'a "b"\\ \n\t\\n c'
    t = spark.createDataFrame([("s", "p", hard, "string"), ("s", "q", "urn:x", "iri"), ("s", "r", "5", "integer"), ("s", "l", "Möwe", "@de")], "s string, p string, o string, kind string")
    assert {tuple(r) for r in read_ntriples(ntriples(t)).collect()} == {tuple(r) for r in t.collect()}


def test_a_row_is_moved_once_for_its_triples(spark):
    rows = spark.createDataFrame([("e1", 1, "x", None), ("e1", 1, "y", "z"), ("e2", 2, None, None), ("e1", 1, "x", None)], "id string, n int, a string, b string")
    more = spark.createDataFrame([("e2", "w"), ("e1", "y")], "id string, a string")
    t = graph.triple_set((rows, F.col("id"), [("n", F.col("n"), "integer"), ("a", F.col("a"), "string"), ("b", F.col("b"), "iri")]), (more, F.col("id"), [("a", F.col("a"), "string")]))
    assert t._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(tuple, t.collect())) == [("e1", "a", "x", "string"), ("e1", "a", "y", "string"), ("e1", "b", "z", "iri"), ("e1", "n", "1", "integer"), ("e2", "a", "w", "string"), ("e2", "n", "2", "integer")]


def test_lines_without_a_kind(spark):
    lines = ['<s> <p> "a" .', '<s> <p> "a"^^<> .', '<s> <p> "a"^^<http://www.w3.org/2001/XMLSchema#date> .', '<s> <p> "a"@de-AT .', "<s> <p> <o> .", '<s> <p> "a"@ .']
    got = read_ntriples(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.o, r.kind) for r in got] == [("a", "string"), ("a", "string"), ("a", "date"), ("a", "@de-AT"), ("o", "iri")]


def test_flags_read_their_rows_once(spark):
    from pageloom.plans.lookups import qa_summary

    assert not any("lineitem" in f or "orders" in f for f in qa_summary(spark, "/root/testdata/sf0.001").inputFiles())


def test_year_repair_works_its_entries_out_once(spark, monkeypatch):
    from pageloom.plans import ordered as plans

    held, real = [], graph.settled
    monkeypatch.setattr(plans, "settled", lambda frame: held.append(real(frame)) or held[-1], raising=False)
    plans.year_repair(spark, "/root/testdata/sf0.001")
    assert len(held) == 1 and not {"entry_uid", "person", "place"} & set(held[0].columns)


def test_archive_bytes(spark, tmp_path):
    rows = [("e1", '1. Mai 1918, ein "Regentag"\tx'), ("e2", None)]
    archive.write_table(spark.createDataFrame(rows, "a string, b string").coalesce(1), ["a", "b"], f"{tmp_path}/t")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "t").glob("part-*"))
    assert raw == 'e1\t1. Mai 1918, ein "Regentag" x\ne2\t\n'.encode()
    assert "coreid" in archive.meta_xml(("event.txt", ["eventID", "x"]), [("o.txt", "T", ["eventID", "y"])])


def test_csv_with_quotes_and_line_ends(spark, tmp_path):
    from pageloom.sources.tables import read_entries

    (tmp_path / "e.csv").write_text('entry_id,volume,text\n1,2,"say ""hi""\nthere"\n2, 2 ,b\n3,3,c\n', encoding="utf-8")
    got = {r.entry_id: r.text for r in read_entries(spark, f"{tmp_path}/e.csv", 2).collect()}
    assert got == {"1": 'say "hi"\nthere', "2": "b"}


def test_queries_have_oracles(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.oracle_sql()) > 60
    assert entry.entry(spark).limit(1).count() == 1
    assert F.lit(1) is not None


def test_ancestors_of_more_than_a_million_rows_and_of_a_long_chain(spark):
    n = 120_000
    tree = spark.range(n).select(F.col("id").alias("code"), F.when(F.col("id") > 0, F.floor(F.col("id") / 2)).alias("parent"))
    depth = lambda i: i.bit_length()
    got = graph.ancestors(tree)
    assert got.count() == sum(map(depth, range(n))) > 1_000_000
    assert sorted((r.ancestor, r.distance) for r in got.filter("code = 77777").collect()) == sorted((77777 >> d, d) for d in range(1, 18))
    chain = spark.createDataFrame([(i, i + 1 if i < 150 else None) for i in range(151)], "code long, parent long")
    assert {tuple(r) for r in graph.ancestors(chain).collect()} == {(i, j, j - i) for i in range(151) for j in range(i + 1, 151)}
    assert graph.ancestors(chain.limit(0)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        graph.ancestors(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "code long, parent long"))


def test_equal_classes_say_what_all_pairs_say(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else i % 3, "" if i % 5 == 0 else "xy"[i % 2]) for i in range(60)], "k long, g int, h string")
    links = {}
    for r in pairs.equal_pairs(rows, "k", "g", "h").collect():
        links.setdefault(r.a, {r.a}).add(r.b)
        links.setdefault(r.b, {r.b}).add(r.a)
    got = {r.k: (r.first, r.links) for r in pairs.equal_classes(rows, "k", "g", "h").collect()}
    assert got == {k: (min(links.get(k, {k})), len(links.get(k, {k})) - 1) for k in range(60)}


def test_equal_pairs_has_a_row_for_each_customer(spark):
    from pageloom.plans.documents import equal_pairs

    sf = "/root/testdata/sf0.001"
    assert equal_pairs(spark, sf).count() == spark.read.parquet(f"{sf}/customer.parquet").count()
