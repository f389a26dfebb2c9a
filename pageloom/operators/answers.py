"""What a model answered for an entry, as rows: the entry's own fields, its persons, observations, legs of travel and weather.

An answer is JSON text, an object or a bare array of observations. Only form is
mended: values outside their vocabulary, of another type or out of range become
null, and nothing is read out of prose. Each answer is one row, so all of it is
done by column expressions within the row and nothing is shuffled. An answer
that holds no JSON gives no rows but the entry's, with what was known of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import vocab
from pageloom.functions.dates import clock_time, iso_or_null
from pageloom.functions.names import observer_name_of
from pageloom.functions.text import json_value
from pageloom.functions.text import let as _let
from pageloom.operators.graph import each

# Roles of persons, labels of evidence, notes.
ROLES = ("companion", "source", "collector", "cited-author", "other")
EVIDENCE_LABELS = {"auditory": "Lautäußerung", "visual": "Sichtbeobachtung", "nest": "Nestfund / Brutnachweis", "specimen": "Beleg / erlegtes Stück"}
CORRECTED = "Datum vom Modell korrigiert (Kopfzeile: "
UNNAMED = "wissenschaftlicher Name nicht angegeben"

def _no_strings() -> Column:
    return F.array().cast("array<string>")


def parsed(rows: DataFrame, raw: str) -> DataFrame:
    """rows with ``_v``: the JSON in an answer, null if there is none."""
    return rows.withColumn("_v", json_value(F.col(raw)))


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _field(v: Column, name: str) -> Column:
    """A value of an object; null where it is missing or null."""
    return _let(F.try_variant_get(v, f"$.{name}", "variant"), lambda x: F.when(~F.is_variant_null(x), x))


def _array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _list(v: Column) -> Column:
    """An array without its nulls; another value is an array of itself, null an empty one."""
    none = F.array().cast("array<variant>")
    return _let(v, lambda x: F.coalesce(F.filter(_array(x), lambda y: ~F.is_variant_null(y)), F.when(x.isNotNull(), F.array(x)), none))


def _text(v: Column) -> Column:
    """A string that is not blank; numbers, arrays and objects are no text."""
    return _let(_let(v, lambda x: F.when(_is(x, "STRING"), F.trim(F.try_variant_get(x, "$", "string")))), lambda t: F.when(t != "", t))


def _int(v: Column) -> Column:
    return _let(_let(v, lambda x: F.when(_is(x, "BIGINT") | _is(x, "STRING"), F.try_variant_get(x, "$", "string"))), vocab.as_int)


def _bool(v: Column) -> Column:
    return _let(v, lambda x: F.when(_is(x, "BOOLEAN"), F.try_variant_get(x, "$", "boolean")).otherwise(_let(_text(x), vocab.as_bool)))


def _number(v: Column) -> Column:
    return _let(v, lambda x: F.when(~_is(x, "BOOLEAN"), F.try_variant_get(x, "$", "string")))


def _of(v: Column, name: str, vocabulary: tuple[str, ...]) -> Column:
    return _let(_text(_field(v, name)), lambda t: vocab.enum(t, vocabulary))


def _date(text: Column) -> Column:
    return _let(text, iso_or_null)


def _clock(text: Column) -> Column:
    return _let(text, lambda t: clock_time(t, whole=True))


def _place(v: Column, default_kind: str, verbatim: Column | None = None) -> Column:
    """(name, verbatim, kind) of an object or a bare name; null without a name."""
    def of(x: Column, name: Column) -> Column:
        written = F.coalesce(_text(_field(x, "verbatim")), *([] if verbatim is None else [verbatim]), name)
        kind = F.coalesce(_of(x, "kind", vocab.PLACE_KINDS), F.lit(default_kind))
        return F.when(name.isNotNull(), F.struct(name.alias("name"), written.alias("verbatim"), kind.alias("kind")))

    return _let(v, lambda x: _let(F.coalesce(_text(x), _text(_field(x, "name"))), lambda name: of(x, name)))


def _weather(v: Column) -> Column:
    """(verbatim, value, unit, precipitation, wind, sky); null without words of its own. A unit without a value means nothing."""
    words = F.coalesce(_text(v), vocab.as_text(_number(_field(v, "verbatim"))))
    unit = _let(_text(_field(v, "temperature_unit")), vocab.temperature_unit)
    measured = _let(unit, lambda u: F.struct(_let(_number(_field(v, "temperature_value")), lambda n: vocab.temperature(n, u)).alias("value"), u.alias("unit")))
    return _let(words, lambda said: F.when(said.isNotNull(), _let(measured, lambda m: F.struct(
        said.alias("verbatim"), m["value"].alias("value"), F.when(m["value"].isNotNull(), m["unit"]).alias("unit"), _let(_text(_field(v, "precipitation")), vocab.precipitation).alias("precipitation"),
        _text(_field(v, "wind")).alias("wind"), _let(_text(_field(v, "sky")), vocab.sky).alias("sky"),
    ))))


def _entry_place() -> Column:
    """The answer's place, none where it says there is none; the known one where it says nothing."""
    known = F.when(F.col("place").isNotNull(), F.struct(F.col("place").alias("name"), F.col("place").alias("verbatim"), F.lit(None).cast("string").alias("kind")))
    read = lambda told: _let(_place(told, "settlement", vocab.as_text(F.col("location_raw"))), lambda p: F.when(p["kind"] != "unknown", p))
    return _let(F.try_variant_get("_v", "$.entry_place", "variant"), lambda told: F.when(told.isNull(), known).otherwise(read(told)))


def _told_date() -> Column:
    """(iso, end, note, plausible) of the answer's date; a bare text is the date."""
    return _let(_field(F.col("_v"), "entry_date"), lambda v: F.struct(
        _date(F.coalesce(_text(v), _text(_field(v, "iso")))).alias("iso"), _date(_text(_field(v, "end_iso"))).alias("end"), _text(_field(v, "note")).alias("note"), _bool(_field(v, "plausible")).alias("plausible"),
    ))


def _entry_date() -> Column:
    return F.coalesce(_told_date()["iso"], F.col("entry_date"))


def entry_fields(rows: DataFrame) -> DataFrame:
    """entry, header_date, entry_date, entry_date_end, plausible, note, place, kind, weather of each answer.

    rows: parsed, with entry, entry_date, location_raw, place. A date that the
    model corrects without saying so is noted.
    """
    header, told = F.col("entry_date"), lambda name: F.col(f"_told.{name}")
    note = F.coalesce(told("note"), F.when(told("iso") != header, F.concat(F.lit(CORRECTED), header, F.lit(")"))))
    reports = _let(_field(F.col("_v"), "weather"), lambda w: F.filter(F.transform(F.coalesce(_array(w), F.array(w)), _weather), lambda r: r.isNotNull()))
    dated = rows.withColumn("_told", _told_date()).withColumn("_d", F.coalesce(told("iso"), header))
    return dated.select(
        "entry", header.alias("header_date"), F.col("_d").alias("entry_date"), F.when(told("end") >= F.col("_d"), told("end")).alias("entry_date_end"), told("plausible").alias("plausible"), note.alias("note"),
        _entry_place().alias("place"), _of(F.col("_v"), "entry_kind", vocab.ENTRY_KINDS).alias("kind"), F.get(reports, F.lit(0)).alias("weather"),
    )


def _persons() -> Column:
    """array of (name, role): the first of each name, upper and lower case alike."""
    def one(p: Column) -> Column:
        return _let(F.coalesce(_text(p), _text(_field(p, "name"))), lambda n: F.struct(n.alias("name"), F.lower(n).alias("key"), _text(_field(p, "role")).alias("role")))

    named = F.filter(F.transform(_list(_field(F.col("_v"), "persons")), one), lambda p: p["name"].isNotNull())
    first = _let(named, lambda all_: F.filter(all_, lambda p, i: F.array_position(all_["key"], p["key"]) == i + 1))
    return F.transform(first, lambda p: F.struct(p["name"].alias("name"), F.when(p["role"].isin(*ROLES), p["role"]).alias("role")))


def _items() -> Column:
    """The observations of an answer, with what is none, as their places count."""
    told = lambda x: F.coalesce(_array(F.col("_v")), _array(x), F.when(x.isNotNull(), F.array(x)), F.array().cast("array<variant>"))
    return _let(_field(F.col("_v"), "observations"), told)


def _surname(name: Column) -> Column:
    return F.rtrim(F.element_at(F.split(F.lower(name), r"\s+"), -1), F.lit("."))


def _with_observers(rows: DataFrame, diarist: tuple[str, ...]) -> DataFrame:
    """rows with ``_items`` and ``_o``, a struct (persons, who): the persons with the observers that are not among them, and each item's observer as the persons spell it.

    An observer is the person of that name, else the only one of that surname, else a new person.
    """
    names = F.transform("_items", lambda i: F.when(_text(_field(i, "vernacular_de")).isNotNull(), _let(_field(i, "observer"), lambda v: observer_name_of(v, diarist))))

    def step(acc: Column, name: Column) -> Column:
        same = F.filter(acc["persons"], lambda p: F.lower(p["name"]) == F.lower(name))
        kin = lambda k: F.when(F.size(k) == 1, F.get(k, F.lit(0)))
        known = F.coalesce(F.get(same, F.lit(0)), _let(F.filter(acc["persons"], lambda p: _surname(p["name"]) == _surname(name)), kin))
        new = F.struct(name.alias("name"), F.lit("source").alias("role"))
        take = lambda k: F.struct(
            F.when(k.isNull(), F.array_append(acc["persons"], new)).otherwise(acc["persons"]).alias("persons"), F.array_append(acc["who"], F.coalesce(k["name"], name)).alias("who"),
        )
        nobody = F.struct(acc["persons"].alias("persons"), F.array_append(acc["who"], F.lit(None).cast("string")).alias("who"))
        return F.when(name.isNull(), nobody).otherwise(_let(known, take))

    return rows.withColumn("_items", _items()).withColumn("_o", F.aggregate(names, F.struct(_persons().alias("persons"), _no_strings().alias("who")), step))


def persons(rows: DataFrame, diarist: tuple[str, ...] = ()) -> DataFrame:
    """entry, pos, name, role: whom an entry names, then observers that it does not. rows: parsed, with entry."""
    return each(_with_observers(rows, diarist).select("entry", F.col("_o.persons").alias("_l")), "_l", "pos", "_p").select("entry", "pos", "_p.name", "_p.role")


def _evidence(v: Column) -> Column:
    """array of (kind, label, call_type, transcription) that the answer states; a bare word is a kind."""
    def one(e: Column) -> Column:
        return _let(_let(F.coalesce(_text(e), _text(_field(e, "kind"))), lambda t: vocab.enum(t, vocab.EVIDENCE_KINDS)), lambda kind: told(e, kind))

    def told(e: Column, kind: Column) -> Column:
        label = F.coalesce(*[F.when(kind == k, F.lit(text)) for k, text in EVIDENCE_LABELS.items()])
        heard = kind == "auditory"
        call = F.when(heard, F.coalesce(_of(e, "call_type", vocab.CALL_TYPES), F.lit("unknown")))
        return F.struct(kind.alias("kind"), label.alias("label"), call.alias("call_type"), F.when(heard, _text(_field(e, "call_transcription"))).alias("transcription"))

    return F.filter(F.transform(_list(v), one), lambda e: e["kind"].isNotNull())


def observations(rows: DataFrame, diarist: tuple[str, ...] = ()) -> DataFrame:
    """One row for each observation that names something, with the number it has in the answer.

    rows: parsed, with entry, entry_date, location_raw, place, text. A type that
    is not told follows from a citation or an observer; a zero counts only where
    the thing was absent; a range's lower end is the count that is not told.
    """
    whole = _with_observers(rows, diarist).withColumn("_d", _entry_date()).withColumn("_at", _entry_place())
    told = each(whole.select("entry", "text", "_d", "_at", F.arrays_zip(F.col("_items").alias("i"), F.col("_o.who").alias("who")).alias("_l")), "_l", "index", "_z")
    i = F.col("_i")
    text = lambda name: _text(_field(i, name))
    of = lambda name, vocabulary: _of(i, name, vocabulary)
    told = told.select("entry", "text", "_d", "_at", "index", F.col("_z.i").alias("_i"), F.col("_z.who").alias("observer")).withColumn("vernacular", text("vernacular_de")).filter("vernacular is not null")
    # what is read more than once stands in columns of its own
    told = told.withColumns({
        "scientific": text("scientific_name"), "citation": text("literature_citation"), "_told": _let(text("record_type"), vocab.record_type), "locality": _place(_field(i, "locality"), "locality"),
        "status": F.coalesce(of("occurrence_status", vocab.OCCURRENCE_STATUS), F.lit("present")), "_n": _int(_field(i, "individual_count")), "_a": _int(_field(i, "count_min")), "_b": _int(_field(i, "count_max")),
        "own_date": _date(text("event_date")),
    })
    second_hand = F.col("observer").isNotNull() | F.col("citation").isNotNull()
    kind = F.coalesce("_told", F.when(F.col("citation").isNotNull(), "literature-record").when(F.col("observer").isNotNull(), "third-party-report").otherwise("field-observation"))
    swapped = F.coalesce(F.col("_b") < F.col("_a"), F.lit(False))
    low, high = F.when(swapped, F.col("_b")).otherwise(F.col("_a")), F.when(swapped, F.col("_a")).otherwise(F.col("_b"))
    counted = F.when((F.col("_n") != 0) | (F.col("status") == "absent"), F.col("_n"))
    rank = F.coalesce(of("taxon_rank", vocab.TAXON_RANKS), F.when(_field(i, "taxon_rank").isNotNull(), "unknown"))
    behaviour = F.filter(F.transform(_list(_field(i, "behaviour")), lambda b: F.trim(F.try_variant_get(b, "$", "string"))), lambda b: b != "")
    named = F.col("scientific").isNotNull()
    return told.select(
        "entry", "index", "vernacular", "scientific", F.when(named, "llm").alias("method"), F.when(~named, UNNAMED).alias("taxon_note"),
        _let(_number(_field(i, "confidence")), vocab.as_share).alias("confidence"), rank.alias("rank"), _bool(_field(i, "is_bird")).alias("is_bird"),
        F.coalesce(text("verbatim_notes"), F.nullif(F.col("text"), F.lit("")), F.col("vernacular")).alias("notes"), "locality", F.coalesce("locality", "_at").alias("place"),
        F.coalesce(counted, low).alias("count"), low.alias("count_min"), high.alias("count_max"), of("count_qualifier", vocab.COUNT_QUALIFIERS).alias("qualifier"), "status",
        _evidence(_field(i, "evidence")).alias("evidence"), behaviour.alias("behaviour"), text("habitat").alias("habitat"), kind.alias("record_type"), "observer", "citation",
        of("sex", vocab.SEXES).alias("sex"), of("life_stage", vocab.LIFE_STAGES).alias("life_stage"), of("breeding_evidence", vocab.BREEDING_EVIDENCE).alias("breeding"),
        of("vitality", vocab.VITALITY).alias("vitality"), of("movement_kind", vocab.MOVEMENT_KINDS).alias("movement"), text("flight_direction").alias("direction"),
        text("identification_qualifier").alias("hedge"), "own_date", F.coalesce("own_date", "_d").alias("event_date"), _clock(text("event_time")).alias("event_time"),
        F.when((F.col("_told") == "field-observation") & second_hand, F.array(F.lit("record_type_conflict"))).otherwise(_no_strings()).alias("flags"),
    )


def travel(rows: DataFrame) -> DataFrame:
    """entry, event, leg, n_legs, departure, arrival, via, mode, departure_time, arrival_time, verbatim: legs that have both ends.

    rows: parsed, with entry, entry_date, location_raw, place. A leg leaves from
    where it says, else from where the one before arrived, else from the entry's
    place. An event without a list of legs is its own leg. Legs are numbered
    within their event after those without an end are gone; an arrival before
    the departure is dropped.
    """
    def read(leg: Column) -> Column:
        name = lambda n: _text(_field(leg, n))
        via = F.filter(F.transform(_list(_field(leg, "via_places")), _text), lambda p: p.isNotNull())
        return F.struct(
            name("departure_place").alias("departure"), name("arrival_place").alias("arrival"), via.alias("via"), _let(name("transport_mode"), vocab.transport_mode).alias("mode"),
            _clock(name("departure_time")).alias("leaves"), _clock(name("arrival_time")).alias("comes"), name("verbatim").alias("verbatim"),
        )

    events = rows.withColumn("_at", _entry_place()["name"]).withColumn("_d", _entry_date()).select("entry", "_at", "_d", _list(_field(F.col("_v"), "travel_events")).alias("_l"))
    events = each(events, "_l", "event", "_e").filter(_is(F.col("_e"), "OBJECT"))
    told = _let(_list(_field(F.col("_e"), "legs")), lambda x: F.when(F.size(x) > 0, x).otherwise(F.array("_e")))
    events = events.select("entry", "_at", "_d", "event", F.filter(F.transform(told, read), lambda x: x["arrival"].isNotNull()).alias("_l"))
    # once a leg has a start all behind it have one, as they leave from where it arrived
    started = F.filter("_l", lambda x, n: F.col("_at").isNotNull() | F.exists(F.slice("_l", F.lit(1), n + 1), lambda y: y["departure"].isNotNull()))
    legs = each(events.select("entry", "_at", "_d", "event", started.alias("_l")), "_l", "leg", "_x")
    before = F.when(F.col("leg") > 0, F.get("_l", F.col("leg") - 1)["arrival"])
    at = lambda clock: F.when(F.col("_d").isNotNull(), F.concat(F.col("_d"), F.lit("T"), clock, F.lit(":00")))
    leaves, comes = at(F.col("_x.leaves")), at(F.col("_x.comes"))
    return legs.select(
        "entry", "event", "leg", F.size("_l").alias("n_legs"), F.coalesce("_x.departure", before, "_at").alias("departure"), F.col("_x.arrival").alias("arrival"), F.col("_x.via").alias("via"), F.col("_x.mode").alias("mode"),
        leaves.alias("departure_time"), F.when(leaves.isNull() | (comes > leaves), comes).alias("arrival_time"), F.col("_x.verbatim").alias("verbatim"),
    )
