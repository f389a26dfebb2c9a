"""Observations by rule, and entries from the headers of a text stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.functions import dates, vocab
from pageloom.functions import text as texts
from pageloom.functions.names import bird_stem
from pageloom.functions.text import let
from pageloom.operators import scan
from pageloom.operators.graph import each, settled

#: Endings that an inflected vernacular name may have.
ENDINGS = ("", "s", "e", "n", "en", "er")


def name_forms(gazetteer: DataFrame) -> DataFrame:
    """form, vernacular: all inflected forms of the names (vernacular, ord) as bird_stem writes them; of names with one form the longest stem, then the first."""
    stems = gazetteer.select("vernacular", "ord", bird_stem(F.col("vernacular")).alias("_s"))
    forms = stems.select("vernacular", "ord", F.length("_s").alias("_n"), F.explode(F.array(*[F.concat("_s", F.lit(e)) for e in ENDINGS])).alias("form"))
    return forms.groupBy("form").agg(F.max_by("vernacular", F.struct("_n", -F.col("ord"))).alias("vernacular"))


def find_taxa(rows: DataFrame, key: str, text: str, gazetteer: DataFrame) -> DataFrame:
    """key, index, vernacular, verbatim, sentence: the first mention of each name in a text, in order.

    A sentence ends at . ! or ?, a name is a whole word with at most one of the endings. Null and empty texts mention nothing.
    """
    sentences = each(rows.select(key, F.regexp_extract_all(text, F.lit(r"[^.!?]*[.!?]|[^.!?]+$"), F.lit(0)).alias("_ss")), "_ss", "_i", "_s").drop("_ss")
    words = each(sentences.withColumn("_ws", F.regexp_extract_all("_s", F.lit("[A-Za-zÄÖÜäöüß]+"), F.lit(0))), "_ws", "_j", "verbatim").drop("_ws")
    # the forms are a table of their own, whose size is known before the texts are read: if it is small, no word is moved
    found = words.withColumn("form", bird_stem(F.col("verbatim"))).join(settled(name_forms(gazetteer)), "form")
    sentence = F.regexp_replace("_s", r"^\s+|\s+$", "")
    first = found.groupBy(key, "vernacular").agg(F.min(F.struct("_i", "_j", "verbatim", sentence.alias("sentence"))).alias("_m"))
    w = Window.partitionBy(key).orderBy("_m._i", "_m._j")
    return first.select(key, (F.row_number().over(w) - 1).alias("index"), "vernacular", "_m.verbatim", "_m.sentence")


def _first_cue(low: Column, cues: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(low.contains(c.strip()), c.strip()) for c in cues])


def observed(mentions: DataFrame) -> DataFrame:
    """Adds evidence (array), call_type, transcription, breeding, count and qualifier, all read from the mention's sentence."""
    low = F.lower("sentence")
    nest, specimen, heard = (vocab.any_of(low, c) for c in (vocab.NEST_CUES, vocab.SPECIMEN_CUES, vocab.AUDITORY_CUES))
    kinds = F.filter(F.array(F.when(nest, "nest"), F.when(specimen, "specimen"), F.when(heard, "auditory")), lambda k: k.isNotNull())
    call = F.when(vocab.any_of(low, vocab.SONG_CUES), "song").when(vocab.any_of(low, vocab.DRUMMING_CUES), "drumming").otherwise("call")
    start = F.greatest(F.instr("sentence", F.col("verbatim")) - 1, F.lit(0))
    counted = vocab.count_before(F.col("sentence"), start)
    return mentions.select(
        "*", F.when(F.size(kinds) == 0, F.array(F.lit("visual"))).otherwise(kinds).alias("evidence"), F.when(heard, call).alias("call_type"),
        F.when(heard, F.coalesce(_first_cue(low, vocab.AUDITORY_CUES), F.lit("Ruf"))).alias("transcription"), nest.alias("breeding"),
        counted["number"].alias("count"), counted["qualifier"].alias("qualifier"),
    )


# How a header of an entry is written.
_MONTH_NAME = r"J[äa]n(?:ner|uar|\.)?|Feb(?:ruar|\.)?|M[äa]r(?:z|\.)?|Apr(?:il|\.)?|Mai|Jun[i]?|Jul[i]?|Aug(?:ust|\.)?|Sept?(?:ember|\.)?|Okt(?:ober|\.)?|Nov(?:ember|\.)?|Dez(?:ember|\.)?"
_MONTH_EN = r"January|February|March|May|June|July|September|October|November|December|Oct\.?|Nov\.?|Dec\.?|Sept?\.?"
_MONTH_ROMAN = r"VIII|XII|VII|III|XI|IX|IV|VI|II|X|V|I"
_YEAR = r"(?:1[5-9]\d{2}|20\d{2}|\d{2})"
WEEKDAYS = "Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonnabend|Sonntag"


def header_pattern(year_required: bool = True) -> str:
    """A whole line that begins with a date: group 1 the date, group 2 the rest."""
    month = rf"(?:{_MONTH_NAME}|{_MONTH_EN}|(?:{_MONTH_ROMAN})\.?)"
    date = rf"\d{{1,2}}\.?\s*{month}[\s.]*" + (_YEAR if year_required else f"(?:{_YEAR})?")
    # lines end at \n alone
    return rf"(?md)^[ \t]*(?:[-*•]\s*)?(?:<u>[ \t]*)?((?i:{date}))[ \t]*(?:</u>)?[ \t]*[.:]?([^\n]*)$"


def matches_at(text: Column, pattern: str) -> Column:
    """Array of (start, hit): all matches of a pattern and where they begin. The text between matches and the matches lie end to end. The pattern tells U+0001 and U+0002 not apart."""
    # a split by a pattern compiles it anew for each text, one by a single character compiles nothing
    gaps = F.split(F.regexp_replace(F.translate(text, "\x01", "\x02"), pattern, "\x01"), "\x01")
    zipped = lambda hits: F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    return let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), zipped), _laid)


def _laid(pairs: Column) -> Column:
    found = "array<struct<start:int,hit:string>>"
    # matches are laid end to end by chunks of chunks, as each step copies the array that it adds to
    chunk = lambda rows, n: F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(rows) - 1) / n).cast("int"), F.lit(0))), lambda c: F.slice(rows, c * n + 1, F.lit(n)))

    def lay(rows: Column, start_of, made_of, end_of, kind: str) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(rows, zero, lambda acc, x: F.struct((acc["at"] + end_of(x)).alias("at"), F.concat(acc["out"], F.array(made_of(x, acc["at"] + start_of(x)))).alias("out")))

    inner = lambda rows: lay(rows, lambda x: F.length(x["g"]), lambda x, at: F.struct(at.alias("start"), x["h"].alias("hit")), lambda x: F.length(x["g"]) + F.length(x["h"]), found)
    shifted = lambda x, at: F.transform(x["out"], lambda y: F.struct((y["start"] + at).alias("start"), y["hit"].alias("hit")))
    whole = lay(F.transform(chunk(pairs, 256), inner), lambda x: F.lit(0), shifted, lambda x: x["at"], f"array<{found}>")
    return F.flatten(whole["out"])


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _bound(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is worked out once a row, and not at each place that reads it."""
    return frame.withColumn(name, F.explode(F.array(value)))


def with_location(rows: DataFrame, rest: Column) -> DataFrame:
    """Adds _r (what stands behind a header's date) and _l: (location, reject, source); prose there rejects the header."""
    rows = _bound(rows, "_r", _strip(F.regexp_replace(_strip(rest), "^[.:]+", "")))
    rows = _bound(rows, "_b", _strip(F.regexp_replace("_r", rf"(?i)^(?:{WEEKDAYS})(?![\p{{L}}\p{{N}}_])\.?,?\s*", "")))
    r, bare = F.col("_r"), F.col("_b")
    day, underlined = bare != r, bare.rlike(r"^<u>\s*.*?\s*</u>")
    plain = F.element_at(F.split(F.element_at(F.split(bare, r"\.(?:\s|$)", 2), 1), r"\s{2,}|\t"), 1)
    raw = F.when(underlined, F.regexp_extract(bare, r"^<u>\s*(.*?)\s*</u>", 1)).otherwise(plain)
    rows = _bound(rows, "_p", _strip(F.regexp_replace(F.regexp_replace(_strip(raw), '^"+|"+$', ""), r"\.+$", "")))
    place = F.col("_p")
    low = lambda c: c.rlike(r"^\p{Ll}")
    made = lambda loc, reject, source: F.struct(loc.cast("string").alias("location"), F.lit(reject).alias("reject"), source.cast("string").alias("source"))
    only, none = F.lit("date-only"), F.lit(None)
    found = (
        F.when(r == "", made(F.lit(""), False, only))
        .when(low(r) | r.rlike("^[,;]"), made(none, True, none))
        .when((bare == "") | low(bare), made(F.lit(""), False, F.when(day, "weekday-stripped").otherwise(only)))
        .when((place != "") & (~place.rlike(r"^\p{L}") | place.rlike(rf"(?i)^(?:{WEEKDAYS})$")), made(F.lit(""), False, only))
        .otherwise(made(place, False, F.when(underlined, "underlined").when(day, "weekday-stripped").otherwise("plain")))
    )
    return _bound(rows, "_l", found)


def entry_starts(rows: DataFrame, key: str, text: str, year_required: bool = True) -> DataFrame:
    """key, offset, end, date, location, variant, loc_source and the parts of the date of every header of a text; null texts have none."""
    pattern = header_pattern(year_required)
    hits = rows.select(key, F.explode(matches_at(F.col(text), pattern)).alias("_m")).select(key, F.col("_m.start").alias("offset"), F.col("_m.hit").alias("_h"))
    hits = _bound(hits, "date", F.regexp_replace(F.trim(F.regexp_extract("_h", pattern, 1)), r"\s+", " "))
    hits = with_location(hits, F.regexp_extract("_h", pattern, 2)).filter("not _l.reject")
    # a plain column, so that it goes where no part of the date is asked for
    hits = hits.withColumn("_d", dates.header_date(F.col("date")))
    variant = F.when(F.col("_l.location") == "", "date-only").when(F.col("_r").startswith("<u>"), "underlined").otherwise("plain")
    return hits.select(
        key, "offset", (F.col("offset") + F.length("_h")).alias("end"), "date", "_l.location", variant.alias("variant"), F.col("_l.source").alias("loc_source"),
        *[f"_d.{c}" for c in ("date_norm", "year", "month", "day", "month_source", "year_form")],
    )


def resegmented(pages: DataFrame, starts: DataFrame, volume: str, page: str, text: str) -> DataFrame:
    """volume, seq, page, offset, text_raw, text_clean, n_chars, n_words: the stream of a volume's pages cut at their headers.

    pages are in the order of their key, with an empty line between them; what stands before a volume's first header is of no entry. Each page is cut on its
    own, so only the pieces of an entry meet. The page of an entry is the one that its header stands on.
    """
    cuts = settled(starts.groupBy(page).agg(F.sort_array(F.collect_list("offset")).alias("_cuts")))
    # how many headers stand before a page in its volume is scanned without the texts
    n_cuts = pages.select(volume, page).join(cuts.select(page, F.size("_cuts").alias("_n")), page, "left")
    base = scan.scanned(n_cuts, volume, [page], _base=scan.running_sum(F.col("_n"), own=False)).select(page, "_base")
    cut = pages.join(cuts, page, "left").join(base, page).withColumn("_cuts", F.concat(F.array(F.lit(-1)), F.coalesce("_cuts", F.array().cast("array<int>"))))
    pieces = cut.select(volume, page, text, "_base", "_cuts", F.posexplode("_cuts").alias("_k", "offset"))
    begin = F.greatest(F.col("offset"), F.lit(0))
    stop = F.coalesce(F.get("_cuts", F.col("_k") + 1), F.length(text))
    seq = F.col("_base") + F.col("_k")
    pieces = pieces.select(volume, page, "_k", "offset", F.concat(F.when(F.col("_k") == 0, "\n\n").otherwise(""), F.substring(text, begin + 1, stop - begin)).alias("_t"), seq.alias("seq")).filter("seq > 0")
    parts = F.sort_array(F.collect_list(F.struct(F.col(page).alias("p"), "_k", "_t")))
    first = F.min(F.struct(F.col(page).alias("p"), "_k", "offset"))
    whole = pieces.groupBy(volume, "seq").agg(F.array_join(F.transform(parts, lambda x: x["_t"]), "").alias("_raw"), first.alias("_f"))
    whole = whole.select(volume, "seq", F.col("_f.p").alias(page), F.col("_f.offset").alias("offset"), F.regexp_replace("_raw", r"^\s+|\s+$", "").alias("text_raw"))
    whole = whole.withColumn("text_clean", texts.strip_markup(F.col("text_raw")))
    return whole.withColumn("n_chars", F.length("text_clean")).withColumn("n_words", F.regexp_count("text_clean", F.lit(r"\S+")))
