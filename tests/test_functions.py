from pyspark.sql import functions as F

from pageloom.functions import dates, ids, names, similarity, text, vocab


def values(spark, rows, column, schema="x string"):
    frame = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in frame.select(column).collect()]


def test_ids(spark):
    assert values(spark, ["Anton Beispiel"], ids.name_id("person", F.col("x"))) == ["person_0741ca344ca3"]
    assert len(values(spark, ["a"], ids.content_id("p", F.col("x")))[0]) == 14
    keys = values(spark, [("m", 'say "hi"\n')], ids.json_string(F.col("y")), "x string, y string")
    assert keys == ['"say \\"hi\\"\\n"']


def test_dates(spark):
    assert values(spark, ["30. Februar 1918", "1. Jänner 1920", "am 7. April 1917 in", None], dates.german_date(F.col("x"))) == [None, "1920-01-01", "1917-04-07", None]
    got = values(spark, ["7. IV. 18", "3. Mai 1951", "31. Sept. 48", "5. Foo 1920", "x"], dates.header_date(F.col("x"))["date_norm"])
    assert got == ["1918-04-07", "1951-05-03", "1948-09-31", None, None]
    assert values(spark, ["1951-02-30", "1951-02-28", "0999-01-01"], dates.iso_or_null(F.col("x"))) == [None, "1951-02-28", None]
    assert values(spark, ["1951-01", "1950-12"], dates.add_months(F.col("x"), -1)) == ["1950-12", "1950-11"]
    assert values(spark, ["7:05 Uhr", "25:00", "18.30"], dates.clock_time(F.col("x"))) == ["07:05", None, "18:30"]
    assert values(spark, [("1901", "1951"), ("01", "1951")], dates.digit_distance(F.col("x"), F.col("y")), "x string, y string") == [1, 4]


def test_text(spark):
    assert values(spark, ["Grün<u>fink</u>", "Beob-\nachtung"], text.page_text(F.col("x"))) == ["gruenfink", "beobachtung"]
    assert values(spark, ["Beob-\nachtung", "Nord-\nSee", "a\n\nb   c"], text.strip_markup(F.col("x"))) == ["Beobachtung", "Nord- See", "a b c"]
    assert values(spark, ["p 5/58.", "", None], text.last_number(F.coalesce("x", F.lit("")))) == ["58", "", ""]
    assert values(spark, ["St. Heinrich", "Sankt Heinrich", "Wörthsee"], text.fold(F.col("x"))) == ["sankt heinrich", "sankt heinrich", "woerthsee"]
    assert values(spark, ["Wörthsee", "Bærum", "Győr Plzeň", "A\u030angstro\u0308m Ệ"], text.fold_gazetteer(F.col("x"))) == ["worthsee", "baerum", "gyor plzen", "angstrom e"]
    assert values(spark, ["ab-cd_0012_L_full", "plain"], text.page_parts(F.col("x")).cast("string")) == ["{ab-cd, 12, L, full}", "{plain, null, , }"]
    assert values(spark, [("Eins. Zwei! Drei", 7), ("Eins. Zwei! Drei", 99)], text.sentence_at(F.col("x"), F.col("y")), "x string, y int") == ["Zwei!", "Eins. Zwei! Drei"]
    assert values(spark, ['```json\n{"a": 1}\n```', "none", "[1, 2] tail"], text.json_body(F.col("x"))) == ['{"a": 1}', None, "[1, 2]"]


def test_names(spark):
    assert values(spark, ["Oberstdorf 843 m", "Kochel. Herzogstandhaus 1555 m", "Dießen"], names.place_head(F.col("x"))) == ["Oberstdorf", "Kochel", "Dießen"]
    assert values(spark, ["Prof.Dr.R. Drost", "Dr. Walter Wüst", "Frau Müller", "dr."], names.person_key(F.col("x"))) == ["r drost", "walter wuest", "frau mueller", "dr"]
    assert values(spark, ["Herr Schuster und K. Lanker, Prof. Dümmer"], F.array_join(names.titled_persons(F.col("x")), ",")) == ["Schuster,Lanker,Dümmer"]
    assert values(spark, ["Maisinger See"], F.array_join(names.place_tokens(F.col("x"), text.fold_gazetteer), " ")) == ["maising see"]


def test_vocabularies(spark):
    assert values(spark, ["Schneeregen", "kein Regen", "ohne jeden Schnee", "Regen, kein Wind", "none", None], vocab.precipitation(F.col("x"))) == ["sleet", "none", "none", "rain", "none", None]
    assert values(spark, ["Kraftwagen", "Wagen", "zu Fuß", "", None], vocab.transport_mode(F.col("x"))) == ["car", "carriage", "foot", "unknown", "unknown"]
    assert values(spark, ["°R", "Grad Réaumur", "Celsius", "F.", "x"], vocab.temperature_unit(F.col("x"))) == ["R", "R", "C", "F", None]
    assert values(spark, [("12,5 Grad", "C"), ("100", "F"), ("100", "C")], vocab.temperature(F.col("x"), F.col("u")), "x string, u string") == [12.5, 100.0, None]
    assert values(spark, ["ja", "0", "maybe"], vocab.as_bool(F.col("x"))) == [True, False, None]
    got = values(spark, ["etwa 12 ", "einige ", "drei ", "zwei oder 7 ", ""], vocab.count_before(F.concat("x", F.lit("Lachmöwen")), F.length("x")).cast("string"))
    assert got == ["{12, approximate}", "{null, plural-unspecified}", "{3, exact}", "{7, exact}", "{null, null}"]


def test_similarity(spark):
    pair = [("dechsendorfer weiher", "dechsendorf weiher"), ("", ""), ("abc", "abc")]
    got = values(spark, pair, similarity.gestalt_ratio(F.col("x"), F.col("y")), "x string, y string")
    assert round(got[0], 3) == 0.947 and got[1:] == [1.0, 1.0]
    assert round(values(spark, pair, similarity.edit_ratio(F.col("x"), F.col("y")), "x string, y string")[0], 3) == 0.9
    assert round(values(spark, pair, similarity.indel_ratio(F.col("x"), F.col("y")), "x string, y string")[0], 3) == 0.947
    import zlib

    got = values(spark, ["abcdefg", "äbcde", "abc", "aaaaaaa"], similarity.shingles(F.col("x")))
    want = [{zlib.crc32(t[i : i + 5].encode()) for i in range(len(t) - 4)} for t in ("abcdefg", "äbcde", "abc", "aaaaaaa")]
    assert [set(g) for g in got] == want and len(got[3]) == 1


def test_cues_fold_a_text_once(spark):
    d = spark.createDataFrame([(" Himmel TRÜB ",), ("",), (None,), ("  ",), ("Variable",), ("blau",)], "x string")
    assert [r[0] for r in d.select(vocab.sky(F.col("x"))).collect()] == ["overcast", None, None, None, "variable", None]
    plan = lambda f: f._jdf.queryExecution().analyzed().toString()
    assert plan(d.select(vocab.sky(F.col("x")).alias("y"))).count("lower(trim(") == 1
