"""Text clean-up and comparison keys. Patterns use explicit character classes, as Java's \\w is ASCII."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKUP = r"(?i)</?(?:u|sup|sub|b|i|em|strong)\s*>"
_LETTER = r"\p{L}\p{N}_"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_markup(text: Column) -> Column:
    """Tags away, words broken at a line end before a lower-case letter joined, lines joined by one space."""
    t = F.regexp_replace(text, _MARKUP, "")
    t = F.regexp_replace(t, rf"([{_LETTER}])-[ \t]*\n+[ \t]*([a-zäöüß])", "$1$2")
    t = F.regexp_replace(t, r"\s*\n+\s*", " ")
    return F.trim(F.regexp_replace(t, r"[ \t]{2,}", " "))


def page_text(text: Column) -> Column:
    """The form in which pages are compared: no tags, words joined, folded case and umlauts. Input in NFC."""
    t = F.regexp_replace(text, _MARKUP, "")
    t = F.regexp_replace(t, rf"([{_LETTER}])-[ \t]*\n+[ \t]*", "$1")
    return F.trim(spell_umlauts(F.lower(F.regexp_replace(t, r"\s+", " "))))


def spell_umlauts(text: Column) -> Column:
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def fold(text: Column) -> Column:
    """Comparison key of names: case, umlauts, punctuation and spacing make no difference."""
    t = spell_umlauts(F.lower(F.coalesce(text, F.lit(""))))
    t = F.replace(F.replace(t, F.lit("st. "), F.lit("sankt ")), F.lit("st."), F.lit("sankt "))
    t = F.regexp_replace(t, rf"[^{_LETTER}\s]", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def _without_marks() -> tuple[str, str]:
    """Small Latin letters that decompose to one of a-z and marks, and those letters."""
    plain = {chr(c): "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
    plain = {c: p for c, p in plain.items() if len(p) == 1 and "a" <= p <= "z"}
    return "".join(plain), "".join(plain.values())


#: Letters with marks and what they are without; other letters outside a-z become spaces.
_MARKED, _PLAIN = _without_marks()


def fold_gazetteer(label: Column) -> Column:
    """Key of gazetteer names: marks dropped (not spelled out), everything but a-z and 0-9 a space."""
    t = F.regexp_replace(F.translate(F.lower(F.trim(F.coalesce(label, F.lit("")))), _MARKED, _PLAIN), r"[\x{300}-\x{36F}]", "")
    for a, b in (("ß", "ss"), ("æ", "ae"), ("ø", "o")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"[^a-z0-9]+", " "))


def last_number(text: Column) -> Column:
    """The last run of digits, or an empty string."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1)), F.lit(""))


def page_parts(page_id: Column) -> Column:
    """(stem, scan, side, variant) of ``stem_0012_L_full``; an id of another form is all stem."""
    pattern = r"^(.*?)_(\d{3,5})(?:_([LRlr]))?(?:_(full))?$"
    hit = page_id.rlike(pattern)
    part = lambda i: F.regexp_extract(page_id, pattern, i)
    return F.struct(
        F.when(hit, part(1)).otherwise(page_id).alias("stem"), F.when(hit, part(2).cast("int")).alias("scan"),
        F.when(hit, F.upper(part(3))).otherwise("").alias("side"), F.when(hit, part(4)).otherwise("").alias("variant"),
    )


def one_line(text: Column) -> Column:
    """A cell of an unquoted table: tabs and line ends become spaces, null is empty."""
    return F.coalesce(F.regexp_replace(text, r"[\t\n\r]", " "), F.lit(""))


def slug(text: Column) -> Column:
    """Lower-case ASCII words joined by underscores, for the end of an IRI."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def fill(template: str, values: dict[str, Column]) -> Column:
    """A template with {{name}} replaced by columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(value, F.lit("")))
    return out


def preview(text: Column, width: int = 120) -> Column:
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("…"))).otherwise(text)


def sentence_at(text: Column, position: Column) -> Column:
    """The sentence (up to . ! or ?) that holds the character at a position from 0."""
    found = F.regexp_extract_all(text, F.lit(r"[^.!?]*[.!?]|[^.!?]+$"), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("hit"))
    picked = F.aggregate(
        found, zero,
        lambda acc, s: F.struct((acc["at"] + F.length(s)).alias("at"), F.coalesce(acc["hit"], F.when(position < acc["at"] + F.length(s), s)).alias("hit")),
        lambda acc: acc["hit"],
    )
    return F.trim(F.coalesce(picked, text))


def json_value(text: Column) -> Column:
    """The JSON object or array inside a model's answer, from the first bracket to the last of its kind, as a variant; null if it doesn't parse."""
    return F.try_parse_json(F.regexp_extract(text, r"(?s)(\{.*\}|\[.*\])", 1))


def json_body(text: Column) -> Column:
    """The text of what json_value finds."""
    body = F.nullif(F.regexp_extract(text, r"(?s)(\{.*\}|\[.*\])", 1), F.lit(""))
    return F.when(F.try_parse_json(body).isNotNull(), body)
