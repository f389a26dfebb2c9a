"""Tables of the biodiversity archive: events, occurrences, measurements, multimedia, and their files."""

from __future__ import annotations

from functools import reduce
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.functions.geo import four_places
from pageloom.functions.text import one_line

# The columns of each table, in order.
EVENT = (
    "eventID", "eventDate", "verbatimEventDate", "locality", "decimalLatitude", "decimalLongitude", "samplingProtocol", "fieldNumber", "fieldNotes", "verbatimLocality", "geodeticDatum",
    "coordinateUncertaintyInMeters", "georeferenceSources", "georeferenceProtocol", "locationID", "eventRemarks", "dynamicProperties",
)
MEASUREMENT = ("eventID", "occurrenceID", "measurementID", "measurementType", "measurementTypeID", "measurementValue", "measurementValueID", "measurementMethod")


def event_date(start: Column, end: Column) -> Column:
    """An ISO date, or start/end where the entry runs over several days."""
    return F.when(end.isNotNull() & (end != start), F.concat_ws("/", start, end)).otherwise(F.coalesce(start, F.lit("")))


def sparse_json(**values: Column) -> Column:
    """An object of the values that are not null; an empty string if none is."""
    body = F.to_json(F.struct(*[v.alias(n) for n, v in values.items()]))
    return F.when(body == "{}", "").otherwise(body)


def events(entries: DataFrame) -> DataFrame:
    """Dated entries. entries: entry_uid, entry_id, entry_date, entry_date_end, place, lat, lon, text, location_raw."""
    both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return entries.filter("entry_date is not null").select(
        F.col("entry_uid").alias("eventID"), event_date(F.col("entry_date"), F.col("entry_date_end")).alias("eventDate"), F.coalesce("place", F.lit("")).alias("locality"),
        F.when(both, four_places(F.col("lat"))).otherwise("").alias("decimalLatitude"), F.when(both, four_places(F.col("lon"))).otherwise("").alias("decimalLongitude"),
        F.lit("diary observation").alias("samplingProtocol"), F.col("entry_id").alias("fieldNumber"), one_line(F.col("text")).alias("fieldNotes"),
        F.when(both, "WGS84").otherwise("").alias("geodeticDatum"),
    )


def quantity(low: Column, high: Column) -> tuple[Column, Column]:
    there = low.isNotNull() & high.isNotNull()
    return F.when(there, F.concat_ws("-", low.cast("string"), high.cast("string"))).otherwise(""), F.when(there, "individuals (range)").otherwise("")


def recorded_by(observer: Column, record_type: Column, diarist: str) -> Column:
    """The observer, the diarist for what was seen in the field, nobody for other records."""
    return F.coalesce(observer, F.when(record_type == "field-observation", diarist), F.lit(""))


def identification_remarks(rank: Column, scientific: Column) -> Column:
    return F.when(rank.isin("genus", "family", "group"), F.concat(F.lit("Bestimmung auf "), rank, F.lit("-Niveau"))).when(F.coalesce(scientific, F.lit("")) != "", "").otherwise("Art nicht sicher bestimmt; nur Trivialname")


def measurements(observations: DataFrame, types: dict[str, Column]) -> DataFrame:
    """One row for each value of each type, numbered within the observation and type. A type's column is a string or an array of strings.

    Of observations that share an id the first by event is numbered first, so that every run numbers alike.
    """
    parts = []
    for name, value in types.items():
        each = value if dict(observations.select(value.alias("v")).dtypes)["v"].startswith("array") else F.array(value)
        parts.append(observations.select("eventID", "occurrenceID", F.lit(name).alias("measurementType"), F.posexplode(each).alias("_pos", "measurementValue")))
    rows = reduce(DataFrame.unionByName, parts).filter("measurementValue is not null and measurementValue <> ''")
    index = F.row_number().over(Window.partitionBy("occurrenceID", "measurementType").orderBy("_pos", "eventID", "measurementValue")) - 1
    return rows.withColumn("measurementID", F.concat_ws(":", "occurrenceID", "measurementType", index.cast("string"))).drop("_pos")


def mime_type(path: Column) -> Column:
    end = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(end.isin("jpg", "jpeg"), "image/jpeg").when(end == "png", "image/png").when(end.isin("tif", "tiff"), "image/tiff").otherwise("")


def multimedia(regions: DataFrame) -> DataFrame:
    """Regions that have an entry and a crop. regions: entry_uid, crop, description, visible_text."""
    words = F.concat_ws(" | ", F.nullif(F.trim("description"), F.lit("")), F.nullif(F.trim("visible_text"), F.lit("")))
    return regions.filter("entry_uid <> '' and crop <> ''").select(F.col("entry_uid").alias("eventID"), F.col("crop").alias("identifier"), F.lit("StillImage").alias("type"), mime_type(F.col("crop")).alias("format"), one_line(words).alias("description"))


def table_lines(frame: DataFrame, columns: list[str]) -> DataFrame:
    """value: the lines of an unquoted table without its header."""
    return frame.select(F.concat_ws("\t", *[one_line(F.col(c).cast("string")) for c in columns]).alias("value"))


def write_table(frame: DataFrame, columns: list[str], path: str) -> None:
    """A folder with a header file and the lines; nothing is quoted, columns not named are left out."""
    table_lines(frame, columns).write.text(path)
    frame.sparkSession.createDataFrame([("\t".join(columns),)], "value string").coalesce(1).write.text(f"{path}.header")


def meta_xml(core: tuple[str, list[str]], extensions: list[tuple[str, str, list[str]]]) -> str:
    """The descriptor of an archive: core (file, columns), extensions (file, row type, columns)."""

    def table(tag: str, file: str, kind: str, columns: list[str], key: str) -> str:
        fields = "".join(f'<field index="{i}" term="{escape(c)}"/>' for i, c in enumerate(columns) if i)
        return f'<{tag} encoding="UTF-8" fieldsTerminatedBy="\\t" linesTerminatedBy="\\n" fieldsEnclosedBy="" ignoreHeaderLines="1" rowType="{escape(kind)}"><files><location>{escape(file)}</location></files><{key} index="0"/>{fields}</{tag}>'

    body = table("core", core[0], "http://rs.tdwg.org/dwc/terms/Event", core[1], "id") + "".join(table("extension", f, k, c, "coreid") for f, k, c in extensions)
    return f'<?xml version="1.0" encoding="UTF-8"?><archive xmlns="http://rs.tdwg.org/dwc/text/">{body}</archive>'


def dangling(occurrences: DataFrame, events_: DataFrame) -> DataFrame:
    """Occurrences of events that there are none of."""
    return occurrences.join(events_.select("eventID"), "eventID", "left_anti")


def check(name: str, frame: DataFrame) -> DataFrame:
    """check, n: how many rows a check found; no row if none."""
    return frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n").filter("n > 0")


def problems(events_: DataFrame, occurrences: DataFrame, measured: DataFrame) -> DataFrame:
    """check, n: repeated keys, references that lead nowhere, values outside their vocabulary; only checks that found something."""

    def repeated(frame: DataFrame, key: str) -> DataFrame:
        return frame.groupBy(key).agg(F.count("*").alias("k")).filter("k > 1")

    found = [
        check("duplicate eventID", repeated(events_, "eventID")), check("duplicate occurrenceID", repeated(occurrences, "occurrenceID")),
        check("duplicate measurementID", repeated(measured, "measurementID")), check("dangling occurrence", dangling(occurrences, events_)),
        check("dangling measurement", measured.join(occurrences.select("occurrenceID"), "occurrenceID", "left_anti")),
        check("status", occurrences.filter(~F.col("occurrenceStatus").isin("present", "absent"))),
        check("present without individuals", occurrences.filter("occurrenceStatus = 'present' and individualCount = '0'")),
    ]
    return reduce(DataFrame.union, found)
