"""Content-addressed keys, the same bytes on every run and in every partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(prefix: str, *parts: Column, length: int = 12) -> Column:
    """prefix_ and the head of a sha1 over a version tag and the parts, kept apart by U+001F."""
    joined = F.concat(F.lit("hog-v1"), *[F.concat(F.lit("\x1f"), p.cast("string")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(joined), 1, length))


def name_id(prefix: str, name: Column, length: int = 12) -> Column:
    """prefix_ and the head of the sha1 of the lower-cased name."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(F.lower(name)), 1, length))


def observation_id(entry: Column, verbatim: Column, vernacular: Column, index: Column) -> Column:
    """Stable under merges: the verbatim name counts, the vernacular one only where it is missing."""
    name = F.coalesce(F.when(verbatim != "", verbatim), vernacular)
    return F.concat(F.lit("obs_"), F.substring(F.sha1(F.concat_ws("|", entry, name, index.cast("string"))), 1, 12))


def json_string(text: Column) -> Column:
    """A text as a JSON string with non-ASCII characters left alone."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'^\{"v":(.*)\}$', 1)


def response_key(model: Column, prompt: Column) -> Column:
    """sha256 of the JSON array [model, prompt] with a space after the comma."""
    return F.sha2(F.concat(F.lit("["), json_string(model), F.lit(", "), json_string(prompt), F.lit("]")), 256)
