"""Keys and parts of person and place names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.text import fold

# Titles that are no part of a name, and forms of address that are.
TITLES = (
    "prof", "dr", "dipl", "ing", "med", "phil", "jur", "rer", "nat", "h\\.?c", "geheimrat", "oberst", "major", "pfarrer", "baron", "graf",
    "freiherr", "frhr", "forstmeister", "oberfoerster", "oberförster", "foerster", "förster", "revierfoerster", "revierförster",
    "hofrat", "sanitaetsrat", "sanitätsrat", "studienrat", "oberstudienrat", "oberlehrer", "hauptlehrer", "lehrer", "rektor",
    "direktor", "inspektor", "oberinspektor", "oberpostmeister", "postmeister", "apotheker", "kaplan", "dekan", "pater",
    "praeparator", "präparator", "kustos", "konservator", "assessor", "referendar", "herr", "hr", "cand", "stud",
)
GENDERED = ("frau", "frl", "fraeulein", "fräulein", "fr")
# Words of a description that is no person's name.
DESCRIPTION = (
    "mit", "aus", "und", "von", "der", "die", "des", "dem", "freund", "freunde", "freunden",
    "gattin", "familie", "sohn", "tochter", "frau", "bruder", "schwester", "kollege",
)
STOP_ENDINGS = ("er",)
# What stands for no observer.
NOBODY = ("n/a", "na", "unbekannt", "unknown", "null", "none")


def person_key(name: Column) -> Column:
    """Titles away, forms of address kept, folded; a bare title keeps its own key."""
    spaced = F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), r"\.", ". ")
    bare = F.regexp_replace(spaced, rf"(?i)^(?:(?:{'|'.join(TITLES)})\.?\s+)+", "")
    return F.coalesce(F.nullif(fold(bare), F.lit("")), fold(name))


def person_parts(key: Column) -> Column:
    """(initials, firsts, surname) of a key."""
    words = F.filter(F.split(key, " "), lambda w: w != "")
    front = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.struct(
        F.filter(front, lambda w: F.length(w) == 1).alias("initials"),
        F.filter(front, lambda w: (F.length(w) > 1) & ~w.isin(*GENDERED)).alias("firsts"),
        F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit("")).alias("surname"),
    )


def is_gendered(key: Column) -> Column:
    """The key begins with a form of address that tells family members apart."""
    return F.split_part(key, F.lit(" "), F.lit(1)).isin(*GENDERED)


def completeness(name: Column, key: Column, uses: Column) -> Column:
    """Sort key of the spellings of a person, the greatest is canonical: no form of address, no description, more and longer first names, uses, umlauts, spaced full stops, shortness."""
    parts = person_parts(key)
    letters = F.aggregate(parts["firsts"], F.lit(0), lambda n, w: n + F.length(w)) + F.size(parts["initials"])
    marks = F.length(name) - F.length(F.regexp_replace(name, "[äöüÄÖÜß]", ""))
    return F.struct(
        (~is_gendered(key)).alias("plain"), (~F.arrays_overlap(F.split(key, " "), F.array(*map(F.lit, DESCRIPTION)))).alias("named"), F.size(parts["firsts"]).alias("firsts"), letters.alias("letters"),
        uses.alias("uses"), marks.alias("marks"), (~name.rlike(r"\.[^\s.]")).alias("spaced"), (-F.length(name)).alias("shortness"),
    )


def titled_persons(text: Column) -> Column:
    """Distinct names after a title or an initial, in order of appearance."""
    pattern = r"(?<![\p{L}\p{N}_])(?:(?:Prof|Dr|Herr|Frau|Hr|Fr|Graf|Baron|P|St)\.?\s+|[A-ZÄÖÜ]\.\s+)([A-ZÄÖÜ][a-zäöüß]+(?:\s+[A-ZÄÖÜ][a-zäöüß]+)?)"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def observer_name(raw: Column, diarist: tuple[str, ...] = ()) -> Column:
    """The name in a JSON text, as observer_name_of finds it."""
    return observer_name_of(F.try_parse_json(raw), diarist)


def observer_name_of(value: Column, diarist: tuple[str, ...] = ()) -> Column:
    """The name in a JSON value: a string, an object's name, or the first of an array; null for placeholders, the diarist's own names (lower case) and what has no letter."""
    kind = lambda v: F.schema_of_variant(v)
    text_of = lambda v: F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
    named = lambda v: text_of(F.try_variant_get(v, "$.name", "variant"))
    first = F.try_element_at(F.filter(F.try_variant_get(value, "$", "array<variant>"), lambda v: ~F.is_variant_null(v)), F.lit(1))
    inner = F.when(kind(first).startswith("OBJECT"), named(first)).otherwise(text_of(first))
    found = F.when(kind(value).startswith("OBJECT"), named(value)).when(kind(value).startswith("ARRAY"), inner).otherwise(text_of(value))
    name = F.trim(F.trim(F.trim(found), F.lit("()")))
    return F.when(name.rlike(r"\p{L}") & ~F.rtrim(F.lower(name), F.lit(".")).isin(*NOBODY, *diarist), name)


def place_head(verbatim: Column) -> Column:
    """The first locality of a header: no descriptions after dashes, commas or full stops, no elevation."""
    head = F.element_at(F.split(verbatim, r"[-–—/,;]"), 1)
    head = F.element_at(F.split(head, r"\."), 1)
    return F.trim(F.regexp_replace(head, r"\s*\d{2,4}\s*m(?![\p{L}\p{N}_]).*$", ""), F.lit(" ."))


def place_tokens(name: Column, fold_key) -> Column:
    """Distinct folded words of a place name, adjectives in -er reduced to the name they come from."""
    stem = lambda w: F.when((F.length(w) > 5) & w.endswith("er"), F.left(w, F.length(w) - 2)).otherwise(w)
    return F.array_distinct(F.transform(F.filter(F.split(fold_key(name), " "), lambda w: w != ""), stem))


def bird_stem(word: Column) -> Column:
    """Vernacular names as they are matched: umlauts without dots, sz as ss, v as w."""
    return F.translate(F.replace(F.lower(word), F.lit("ß"), F.lit("ss")), "äöüv", "aouw")


def canonical_rank(name: Column, uses: Column) -> Column:
    """Sort key of spellings, the greatest is canonical: uses, clean form, shortness, diacritics, and the name so that ties rest."""
    clean = (name == F.trim(F.regexp_replace(name, r"\s+", " "))) & ~F.rtrim(name).rlike(r"[.,;:]$")
    marks = F.length(name) - F.length(F.regexp_replace(name, "[äöüÄÖÜß]", ""))
    return F.struct(uses.alias("uses"), clean.cast("int").alias("clean"), (-F.length(name)).alias("shortness"), marks.alias("marks"), name.alias("name"))
