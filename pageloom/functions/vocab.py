"""Controlled vocabularies and the cues that lead free text to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.text import let

# Vocabularies and ordered cues; an earlier cue wins.
TRANSPORT_MODES = ("train", "foot", "boat", "car", "carriage", "bicycle", "unknown")
TRANSPORT_CUES = (
    ("train", ("bahn", "zug", "eisenbahn", "d-zug", "lokal", "express")),
    ("boat", ("dampfer", "boot", "schiff", "kahn", "fähre", "floß")),
    ("bicycle", ("fahrrad", "rad", "velo")),
    ("car", ("auto", "kraftwagen", "automobil")),
    ("carriage", ("kutsche", "droschke", "fuhrwerk", "chaise", "wagen")),
    ("foot", ("fuß", "fuss", "gegangen", "gelaufen", "marsch", "wander", "spazier")),
)
CALL_TYPES = ("song", "call", "alarm", "drumming", "unknown")
COUNT_QUALIFIERS = ("exact", "minimum", "approximate", "plural-unspecified")
EVIDENCE_KINDS = ("visual", "auditory", "nest", "specimen")
OCCURRENCE_STATUS = ("present", "absent")
SEXES = ("male", "female", "mixed")
LIFE_STAGES = ("adult", "juvenile", "pullus", "immature", "egg", "mixed")
BREEDING_EVIDENCE = ("confirmed", "probable", "possible")
VITALITY = ("alive", "dead")
MOVEMENT_KINDS = ("migrating", "passing-over", "arriving", "departing", "resting", "roosting")
TAXON_RANKS = ("species", "subspecies", "genus", "family", "group", "unknown")
PLACE_KINDS = ("settlement", "locality", "region", "route", "unknown")
ENTRY_KINDS = ("field-day", "species-digest", "retrospective", "correspondence", "other")
RECORD_TYPES = ("field-observation", "third-party-report", "literature-record")
RECORD_TYPE_CUES = (
    ("literature-record", ("liter", "zitat", "publik", "citation", "karte", "digest")),
    ("third-party-report", ("third", "bericht", "meldung", "mitteilung", "report", "fremd", "brief", "schriftlich", "schreibt")),
    ("field-observation", ("field", "feld", "eigen", "first", "own")),
)
PRECIPITATION_TYPES = ("rain", "snow", "sleet", "hail", "drizzle", "fog", "thunderstorm", "none")
PRECIPITATION_CUES = (
    ("sleet", ("schneeregen", "graupel")),
    ("snow", ("schnee", "schneit")),
    ("hail", ("hagel",)),
    ("thunderstorm", ("gewitter",)),
    ("drizzle", ("niesel", "sprüh")),
    ("fog", ("nebel", "dunst")),
    ("rain", ("regen", "regnet", "regner")),
    ("none", ("trocken", "niederschlagsfrei")),
)
NEGATIONS = ("kein", "keine", "keinerlei", "ohne", "nicht")
SKY_CONDITIONS = ("clear", "partly-cloudy", "overcast", "variable")
SKY_CUES = (
    ("variable", ("wechselnd", "veränderlich", "unbeständig")),
    ("overcast", ("trüb", "trueb", "bedeckt", "grau", "düster", "bezogen")),
    ("partly-cloudy", ("wolkig", "bewölkt", "bewoelkt")),
    ("clear", ("klar", "heiter", "sonnig", "wolkenlos", "schön", "schoen")),
)
AUDITORY_CUES = (
    "ruft", "rufen", "ruf ", "gesang", "singt", "singen", "sang", "schlägt", "schlagen", "schrei", "schreien", "schwirrt", "schnarren", "trommelt", "trommeln", "gehört", "hört",
    "locken", "lockt", "pfeift", "pfiff",
)
NEST_CUES = ("nest", "brut", "gelege", "eier", "horst", "junge")
SPECIMEN_CUES = ("erlegt", "geschossen", "gesammelt", "eingesandt", "präpar", "balg", "sammlung")
SONG_CUES = ("gesang", "singt", "singen", "sang", "schlägt", "schlagen", "schwirrt")
DRUMMING_CUES = ("trommelt", "trommeln")
PLURAL_CUES = ("einige", "mehrere", "viele", "zahlreiche", "etliche", "manche", "einzelne", "verschiedene", "diverse", "wenige", "einigen", "vielen")
APPROX_CUES = ("etwa", "ungefähr", "ca.", "circa", "gegen", "an die", "rund")
NUMBER_WORDS = {
    "ein": 1, "eine": 1, "einen": 1, "einem": 1, "einer": 1, "eines": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6,
    "sieben": 7, "acht": 8, "neun": 9, "zehn": 10, "elf": 11, "zwölf": 12, "ein paar": 2, "zwanzig": 20, "dreißig": 30, "hundert": 100,
}


def _clean(raw: Column) -> Column:
    return F.lower(F.trim(raw))


def any_of(text: Column, cues) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(c) for c in cues])


def enum(raw: Column, vocabulary) -> Column:
    """The value if it is in the vocabulary (case, underscores and spaces don't matter), else null."""
    value = F.translate(_clean(raw), "_ ", "--")
    return F.when(value.isin(*vocabulary), value)


def cue_fold(raw: Column, vocabulary, cues) -> Column:
    """The vocabulary's term, or that of the first cue that the text holds, or null."""
    def folded(value: Column) -> Column:
        out = F.when(value.isin(*vocabulary), value)
        for term, words in cues:
            out = out.when(any_of(value, words), term)
        return out

    return F.when(F.coalesce(raw, F.lit("")) != "", let(_clean(raw), folded))


def transport_mode(raw: Column) -> Column:
    return F.coalesce(cue_fold(raw, TRANSPORT_MODES, TRANSPORT_CUES), F.lit("unknown"))


def record_type(raw: Column) -> Column:
    return cue_fold(raw, RECORD_TYPES, RECORD_TYPE_CUES)


def sky(raw: Column) -> Column:
    return cue_fold(raw, SKY_CONDITIONS, SKY_CUES)


def precipitation(raw: Column) -> Column:
    """As cue_fold, but none where a negation stands right before the word (one filler word between at most)."""
    words = "|".join(c for term, cues in PRECIPITATION_CUES if term != "none" for c in cues)
    letter = r"[\p{L}\p{N}_]"
    negated = _clean(raw).rlike(rf"(?<!{letter})(?:{'|'.join(NEGATIONS)})(?!{letter})(?:\s+{letter}+)?\s+{letter}*(?:{words})")
    return let(cue_fold(raw, PRECIPITATION_TYPES, PRECIPITATION_CUES), lambda found: F.when(found.isNotNull() & ~_clean(raw).isin(*PRECIPITATION_TYPES) & negated, F.lit("none")).otherwise(found))


def temperature_unit(raw: Column) -> Column:
    bare = F.lower(F.regexp_replace(F.trim(F.ltrim(F.trim(raw), F.lit("°"))), r"\.+$", ""))
    v = let(bare, lambda x: F.when(x.startswith("grad "), F.ltrim(F.substring(x, 6, 100))).otherwise(x))
    return let(v, lambda x: F.when(x.rlike("^[cz]"), "C").when(x.rlike("^r"), "R").when(x.rlike("^f"), "F"))


def temperature(raw: Column, unit: Column) -> Column:
    """The first number of a text, if it lies in the range that its unit allows."""
    number = F.replace(F.regexp_extract(F.replace(raw, F.lit("−"), F.lit("-")), r"-?\d+(?:[.,]\d+)?", 0), F.lit(","), F.lit(".")).try_cast("double")
    return let(number, lambda n: F.when(F.when(unit == "F", n.between(-76.0, 140.0)).otherwise(n.between(-60.0, 60.0)), n))


def basis_of_record(kind: Column, specimen: Column) -> Column:
    """Literature before specimen before observation."""
    return F.when(kind == "literature-record", "MaterialCitation").when(specimen, "PreservedSpecimen").otherwise("HumanObservation")


def reproductive_condition(evidence: Column, behaviours: Column) -> Column:
    """Breeding where it is confirmed or probable, else the first stated one."""
    return F.when(evidence.isin("confirmed", "probable"), "breeding").otherwise(F.try_element_at(F.filter(behaviours, lambda b: b.isNotNull() & (b != "")), F.lit(1)))


# Sanitizers: form only, they never raise.
def as_text(raw: Column) -> Column:
    return F.when(F.trim(raw) != "", F.trim(raw))


def as_int(raw: Column, minimum: int = 0) -> Column:
    number = F.when(F.trim(raw).rlike(r"^[+-]?\d+$"), F.trim(raw)).try_cast("bigint")
    return F.when(number >= minimum, number)


def as_bool(raw: Column) -> Column:
    v = _clean(raw)
    return F.when(v.isin("true", "yes", "ja", "1"), True).when(v.isin("false", "no", "nein", "0"), False)


def as_share(raw: Column) -> Column:
    number = raw.try_cast("double")
    return F.when(number.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), number)))


def count_before(sentence: Column, position: Column, reach: int = 40) -> Column:
    """(number, qualifier) from the words up to ``reach`` characters before a mention."""
    start = F.greatest(F.lit(0), position - reach)
    window = F.lower(F.substring(sentence, start + 1, position - start))
    digits = F.try_element_at(F.regexp_extract_all(window, F.lit(r"(?<![\p{L}\p{N}_])(\d{1,4})(?![\p{L}\p{N}_])"), F.lit(1)), F.lit(-1)).try_cast("int")
    word = F.when(F.lit(False), F.lit(0))
    for name, value in NUMBER_WORDS.items():
        word = word.when(window.rlike(rf"(?<![\p{{L}}\p{{N}}_]){name}(?![\p{{L}}\p{{N}}_])"), value)
    plural = any_of(window, PLURAL_CUES)
    number = F.when(plural, F.lit(None).cast("int")).when(digits.between(1, 9999), digits).otherwise(word)
    how = F.when(plural, "plural-unspecified").when(digits.between(1, 9999), F.when(any_of(window, APPROX_CUES), "approximate").otherwise("exact")).when(word.isNotNull(), "exact")
    return F.struct(number.alias("number"), how.alias("qualifier"))
