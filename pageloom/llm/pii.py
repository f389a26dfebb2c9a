"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Base kinds (email, ip, card, phone) are leftmost, non-overlapping matches of
their patterns that pass their validator; they are always reported. The method
adds three kinds that need more than a pattern: ``iban`` (mod-97 must be 1),
``id`` (three-two-four digit groups) and ``secret`` (long runs of letters and
digits), which are reported if their score reaches ``THRESHOLD``. A span's score is
its kind's prior, raised if a checksum held and if one of the kind's context words
(with or without an s) stands whole within ``NEAR`` characters before or after it;
letters on either side of it make it another word.

Null and empty texts have no spans, an empty table gives no rows. Offsets are
code points, ends exclusive. Repeated rows are searched each, texts of any length
whole. Of spans with one start the kinds come in the order of ``KINDS``. Columns
besides id and text are not read. Patterns use possessive repeats and start only
at the end of the previous match or at the edge of a run, so the time stays in
proportion to the text however long a run of digits or letters is.

All of it is DataFrame expressions. Spark has no function that returns where
matches lie, so the text between matches (``split``) and the matches
(``regexp_extract_all``) are laid end to end and their lengths added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: How many characters before and after a span are searched for context words.
NEAR = 40
THRESHOLD = 0.7

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A whole chain of digits with single separators, if it has twelve digits or more.
CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){11})[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Length of an account number by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: An account number ends at its country's length, whatever stands behind a space there.
IBAN = r"(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:[\\x20]?[A-Z0-9]){{{n - 4}}}+" for n, codes in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])"
ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SECRET = r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+"

#: Kind, prior score, what a checksum adds, context words.
KINDS = {
    "email": (0.8, 0.0, "mail|e-mail|contact|kontakt|correo|courriel"),
    "ip": (0.6, 0.0, "ip|host|server|address|adresse"),
    "card": (0.3, 0.5, "card|karte|visa|mastercard|carte|tarjeta|credit"),
    "phone": (0.6, 0.0, "phone|tel|call|fax|mobile|telefon"),
    "iban": (0.3, 0.5, "iban|account|konto|bank|compte|cuenta"),
    "id": (0.5, 0.0, "ssn|social|security|id|insurance"),
    "secret": (0.5, 0.0, "token|secret|password|passwd|api.?key|access.?key|bearer"),
}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def luhn(digits: Column) -> Column:
    """True if a string of ASCII digits passes Luhn."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number without spaces leaves 1 when taken modulo 97."""
    turned = F.concat(F.substring(account, 5, 100), F.substring(account, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        v = F.ascii(c)
        return F.when(v < 58, (acc * 10 + v - 48) % 97).otherwise((acc * 100 + v - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        return span.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        d = _digits(span)
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(span)).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(span, F.lit(" "), F.lit("")))
    if kind == "secret":
        return span.rlike("[0-9]") & span.rlike("[A-Za-z]")
    return F.lit(True)


_PLACED = "array<struct<h:string,near:string,past:string,start:bigint>>"
#: A window holds one more character, which tells whether a word is cut there.
_WINDOW = NEAR + 1
#: Matches that are laid end to end at a time, so that a text with very many is not quadratic.
_CHUNK = 256


def _pairs(pattern: str, hint: Column) -> Column:
    """Each match of the text with the text since the match before and the beginning of the text up to the next, at the end of the text a space; hint: false where there can be none."""
    # a space behind the text makes no match longer, and ends the last word
    gaps, hits = F.split(F.concat("_text", F.lit(" ")), pattern), F.regexp_extract_all(F.col("_text"), F.lit(pattern), F.lit(0))
    zipped = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    zipped = F.zip_with(zipped, F.slice(gaps, F.lit(2), F.size(hits)), lambda x, g: F.struct(x["h"].alias("h"), x["g"].alias("g"), F.left(g, F.lit(_WINDOW)).alias("a")))
    return F.when(hint, zipped).otherwise(F.array().cast("array<struct<h:string,g:string,a:string>>"))


def _placed(pairs: str) -> Column:
    """Chunks of matches, each as the length of its text and the matches with their starts in it and the text before and after them."""
    last = lambda text: F.substring(text, -_WINDOW, _WINDOW)

    def zero(chunk: Column) -> Column:
        """Nothing placed yet; what stands before the chunk lies in so many matches at most, as each has a character."""
        before = F.slice(pairs, F.greatest(chunk * _CHUNK - _WINDOW + 1, F.lit(1)), F.least(chunk * _CHUNK, F.lit(_WINDOW)))
        # the text begins after a space, so that a word at its beginning is whole
        tail = last(F.concat(F.lit(" "), F.array_join(F.transform(before, lambda x: F.concat(last(x["g"]), x["h"])), "")))
        return F.struct(F.lit(0).cast("bigint").alias("end"), tail.alias("tail"), F.array().cast(_PLACED).alias("out"))

    def after(x: Column) -> Column:
        """What stands after a match: where the next one is near, it and what follows, each of a character at least."""
        rest = F.transform(F.slice(pairs, x["i"] + 2, F.lit(_WINDOW)), lambda y: F.concat(F.left(y["h"], F.lit(_WINDOW)), y["a"]))
        return F.when(F.length(x["a"]) >= _WINDOW, x["a"]).otherwise(F.left(F.concat(x["a"], F.array_join(rest, "")), F.lit(_WINDOW)))

    def place(acc: Column, x: Column) -> Column:
        start = acc["end"] + F.length(x["g"])
        near = last(F.concat(acc["tail"], last(x["g"])))
        made = F.struct(x["h"].alias("h"), near.alias("near"), after(x).alias("past"), start.alias("start"))
        return F.struct((start + F.length(x["h"])).alias("end"), last(F.concat(near, x["h"])).alias("tail"), F.concat(acc["out"], F.array(made)).alias("out"))

    chunks = F.filter(F.sequence(F.lit(0), F.floor(F.size(pairs) / _CHUNK).cast("int")), lambda c: c * _CHUNK < F.size(pairs))
    numbered = lambda c: F.transform(F.slice(pairs, c * _CHUNK + 1, F.lit(_CHUNK)), lambda x, i: F.struct(x["h"].alias("h"), x["g"].alias("g"), x["a"].alias("a"), (c * _CHUNK + i).alias("i")))
    return F.transform(chunks, lambda c: F.aggregate(numbered(c), zero(c), place))


def _spans(kind: str, chunks: str) -> Column:
    """Array of (kind, start, end, score) of the confirmed matches."""
    prior, checked, context = KINDS[kind]
    word = rf"(?<!\p{{L}})(?:{context})s?(?!\p{{L}})"
    near = lambda x: x["near"].rlike(rf"(?is)^.+?{word}") | x["past"].rlike(rf"(?is)^.*?{word}.")

    def span(x: Column, base: Column) -> Column:
        start = base + x["start"]
        score = F.least(F.lit(1.0), F.lit(prior + checked) + F.when(near(x), 0.2).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(x["h"])).alias("end"), score.alias("score"))

    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast("array<array<struct<kind:string,start:bigint,end:bigint,score:double>>>").alias("out"))

    def shift(acc: Column, c: Column) -> Column:
        made = F.transform(F.filter(c["out"], lambda x: _valid(kind, x["h"])), lambda x: span(x, acc["end"]))
        return F.struct((acc["end"] + c["end"]).alias("end"), F.concat(acc["out"], F.array(made)).alias("out"))

    return F.flatten(F.aggregate(chunks, zero, shift, lambda acc: acc["out"]))


def _order(*kinds: str):
    """By start, then the kind's place in the list."""
    rank = lambda x: F.array_position(F.array(*map(F.lit, kinds)), x["kind"])

    def compare(a: Column, b: Column) -> Column:
        return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0)

    return compare


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """id, ``base`` and ``extra``: sorted arrays of (kind, start, end, score)."""
    text = F.col("_text")
    frame = docs.select(id_col, F.coalesce("text", F.lit("")).alias("_text"))
    proposed = frame.select(
        id_col,
        _pairs(EMAIL, text.contains("@")).alias("email"),
        _pairs(IP, text.rlike(r"[0-9]\.[0-9]")).alias("ip"),
        _pairs(CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")).alias("card"),
        _pairs(PHONE, text.contains("+")).alias("phone"),
        _pairs(IBAN, text.rlike(r"[A-Z]{2}[0-9]{2}[\x20]?[A-Z0-9]")).alias("iban"),
        _pairs(ID, text.rlike(r"[0-9]-[0-9]{2}-[0-9]")).alias("id"),
        # without one of its words near a secret's score stays below the default threshold
        _pairs(SECRET, text.rlike(rf"(?i){KINDS['secret'][2]}") if threshold > KINDS["secret"][0] else F.lit(True)).alias("secret"),
    )
    placed = proposed.select(id_col, *[_placed(kind).alias(kind) for kind in KINDS])
    found = placed.select(id_col, *[_spans(kind, kind).alias(kind) for kind in KINDS])
    base = F.array_sort(F.concat("email", "ip", "card", "phone"), _order("email", "ip", "card", "phone"))
    extra = F.array_sort(F.filter(F.concat("iban", "id", "secret"), lambda x: x["score"] >= threshold), _order("iban", "id", "secret"))
    return found.select(id_col, base.alias("base"), extra.alias("extra"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _base_columns() -> list[Column]:
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return [*map(count, ("email", "ip", "card", "phone")), F.sha2(_joined(F.col("base")), 256).alias("base_sha256")]


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    every = F.array_sort(F.concat("base", "extra"), _order(*KINDS))
    return found.select("doc_id", *_base_columns(), _joined(every).alias("spans"))


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base spans alone, which SQL can say."""
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", *_base_columns())


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HITS = " UNION ALL ".join(f"SELECT r, {i} AS k, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS h, string_split_regex(t, '{p}') AS g FROM d" for i, (kind, p) in enumerate(_PATTERNS.items()))

BASE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), m AS ({_HITS}),
u AS (SELECT r, k, kind, unnest(h) AS h, unnest(g[1:len(h)]) AS g, unnest(range(len(h))) AS i FROM m WHERE len(h) > 0),
s AS (SELECT *, regexp_replace(h, '[^0-9]', '', 'g') AS n, sum(length(g) + length(h)) OVER (PARTITION BY r, k ORDER BY i) AS stop FROM u),
v AS (SELECT *, CASE kind WHEN 'email' THEN true WHEN 'ip' THEN list_max(list_transform(string_split(h, '.'), lambda x: coalesce(try_cast(x AS HUGEINT), 999))) <= 255 WHEN 'phone' THEN length(n) BETWEEN 9 AND 15
  ELSE length(n) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda j: CASE WHEN (length(n) - j) % 2 = 0 THEN n[j:j]::INT WHEN n[j:j]::INT > 4 THEN 2 * n[j:j]::INT - 9 ELSE 2 * n[j:j]::INT END)) % 10 = 0 END AS good FROM s),
o AS (SELECT r, count(*) FILTER (k = 0) AS e, count(*) FILTER (k = 1) AS i, count(*) FILTER (k = 2) AS c, count(*) FILTER (k = 3) AS p, string_agg(kind || ':' || (stop - length(h)) || ':' || stop, ',' ORDER BY stop - length(h), k) AS spans FROM v WHERE good GROUP BY r)
SELECT doc_id, coalesce(e, 0)::BIGINT AS n_email, coalesce(i, 0)::BIGINT AS n_ip, coalesce(c, 0)::BIGINT AS n_card, coalesce(p, 0)::BIGINT AS n_phone, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN o USING (r)"""
