"""Repair of conversation structure: the cheapest edits that give role initials ``(s?(ua)+)?``.

A forward Viterbi pass over four grammar states (nothing yet, after the system
row, after a user row, after an assistant row) carries for each state the least
(cost, audit string). Each row is kept, given another role or deleted, and then
its layer is closed by insertions, two at most: a third would come back to a
state it has been in. Costs follow from the audit string and the rows, and of
two strings over the same rows one can be the beginning of the other only by
insertions at its end, which cost: so among equal costs the lesser string stays
the lesser whatever follows, and pieces of a conversation can be worked out
apart and composed.

Rows move once, by ranges of conversation and turn. A conversation that lies
within a partition and is of one piece is repaired where it lies. Others, of any
length, are pieces of bounded size: a piece gives for each entry state its best
ways to each exit state (a min-plus matrix), the matrices of a conversation are
composed in order, and one more pass in order replays the audit string over the
rows and hashes what comes out, a piece at a time. Rows that repeat an earlier
one are found by their least place, counted before it is shuffled; role and text
are told apart by 128 bits of SHA-256.

Nulls in role and text are one space. Rows of one turn are taken by role and
digest; null turns come first. A null conv_id is a conversation of its own. A
role whose first character is none of s, u and a (or an empty one) fits
nowhere. Repeated rows are duplicates of the first. Texts may have any length;
an empty table gives no rows; columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.storage import saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: From each state the initial that may follow and the state it leads to.
NEXT = ((("s", 1), ("u", 2)), (("u", 2),), (("a", 3),), (("u", 2),))
ROLE = {"u": "user", "a": "assistant"}
#: States in which a conversation may end.
FINAL = (0, 3)
#: The most rows, and about the most characters, that one piece holds.
PIECE_ROWS, PIECE_CHARS = 1024, 1 << 20
SPACE = " \t\n\x0b\x0c\r"

Layer = list[tuple[int, str] | None]


def _offer(layer: Layer, state: int, cost: int, audit: str) -> None:
    if layer[state] is None or (cost, audit) < layer[state]:
        layer[state] = (cost, audit)


def close(layer: Layer) -> Layer:
    """The layer after up to two insertions."""
    out = list(layer)
    for _ in range(2):
        for state, held in enumerate(list(out)):
            for initial, to in NEXT[state] if held else ():
                if initial in ROLE:
                    _offer(out, to, held[0] + INSERT, held[1] + "I")
    return out


def step(layer: Layer, kind: str) -> Layer:
    """The closed layer after a row. kind: its initial (x: any other), upper case if truncated, d if it must go."""
    out: Layer = [None] * 4
    extra = TRUNCATED if kind.isupper() else 0
    for state, held in enumerate(layer):
        if held is None:
            continue
        cost, audit = held
        _offer(out, state, cost + DELETE, audit + "D")
        for initial, to in NEXT[state] if kind != "d" else ():
            if initial == kind.lower():
                _offer(out, to, cost + KEEP + extra, audit + "K")
            if initial in ROLE:
                _offer(out, to, cost + REROLE + extra, audit + "R")
    return close(out)


def matrix(kinds: str) -> list[Layer]:
    """For each entry state the best way to each exit state over a stretch of rows."""
    out = []
    for entry in range(4):
        layer: Layer = [None] * 4
        layer[entry] = (0, "")
        for kind in kinds:
            layer = step(layer, kind)
        out.append(layer)
    return out


def compose(layer: Layer, ways: list[Layer]) -> Layer:
    """The layer after a stretch of rows, of which the matrix is known."""
    out: Layer = [None] * 4
    for held, row in zip(layer, ways, strict=True):
        for state, way in enumerate(row) if held else ():
            if way:
                _offer(out, state, held[0] + way[0], held[1] + way[1])
    return out


def start() -> Layer:
    return close([(0, ""), None, None, None])


def best(layer: Layer) -> tuple[int, str]:
    return min(layer[s] for s in FINAL if layer[s])


@lru_cache(1 << 15)
def _short(kinds: str) -> tuple[int, str]:
    layer = start()
    for kind in kinds:
        layer = step(layer, kind)
    return best(layer)


def cheapest(kinds: str) -> tuple[int, str]:
    """Cost and audit string of a whole conversation; short ones are remembered."""
    return _short(kinds) if len(kinds) <= 32 else _short.__wrapped__(kinds)


class Replay:
    """Follows an audit string over rows in order and hashes the repaired conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first, self.digest = audit, 0, 0, True, hashlib.sha256()

    def _put(self, initial: str, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + role.encode() + b":" + text.encode())
        self.first = False
        self.state = dict(NEXT[self.state])[initial]

    def _made(self) -> str:
        """The initial of a row that gets a role or is inserted here: the grammar leaves one."""
        return next(i for i, _ in NEXT[self.state] if i in ROLE)

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            initial = self._made()
            self._put(initial, ROLE[initial], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._put(role[0], role, text)
        elif letter == "R":
            initial = self._made()
            self._put(initial, ROLE[initial], text)

    def end(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


class Facts:
    """Counts over rows in order, of a conversation or a piece of one; pieces add up by ``then``."""

    def __init__(self):
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = ""
        self.low = self.high = None
        self.kinds: list[str] = []

    def add(self, r: dict, duplicate: bool) -> None:
        initial = r["role"][:1]
        self.illegal += self.n > 0 and self.tail + initial not in ("su", "ua", "au")
        self.head = initial if self.n == 0 else self.head
        self.tail, self.n = initial, self.n + 1
        kind = initial if initial in ("s", "u", "a") else "x"
        if r["blank"] or duplicate:
            self.blank += r["blank"]
            self.duplicate += not r["blank"]
            kind = "d"
        elif r["truncated"]:
            self.truncated += 1
            kind = kind.upper()
        self.kinds.append(kind)
        if r["turn"] is not None:
            self.turns += r["turn"] != self.high  # rows come by turn
            self.low = r["turn"] if self.low is None else self.low
            self.high = r["turn"]

    def then(self, p: dict) -> None:
        """Add the piece that follows, as ``piece`` gives it."""
        if p["n"]:
            self.illegal += p["illegal"] + (self.n > 0 and self.tail + p["head"] not in ("su", "ua", "au"))
            self.tail, self.n = p["tail"], self.n + p["n"]
        for name in ("blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + p[name])
        if p["low"] is not None:
            self.turns += p["turns"] - (p["low"] == self.high)
            self.low = p["low"] if self.low is None else self.low
            self.high = p["high"]

    def piece(self) -> dict:
        return {k: getattr(self, k) for k in ("n", "blank", "duplicate", "truncated", "illegal", "turns", "head", "tail", "low", "high")}

    def counts(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


_COUNTS = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())]
_DONE = pa.struct([*_COUNTS, ("repaired_sha256", pa.string())])
_ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("blank", pa.bool_()), ("truncated", pa.bool_()), ("digest", pa.binary())])
_COUNTS_SQL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_DONE_SQL = f"struct<{_COUNTS_SQL}, repaired_sha256: string>".replace(" long", ": long").replace("audit string", "audit: string")
_ROW_SQL = "struct<turn: long, role: string, text: string, blank: boolean, truncated: boolean, digest: binary>"
_WAYS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def damaged(talks: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of every row after the damage that a checksum of its place chooses; a row that is dropped stays without role and text."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(place) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = talks.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"), fault.alias("_fault"))
    rows = rows.withColumn("_copy", F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    here = F.col("_fault") != 0
    return rows.select("conv_id", "turn", F.when(here, F.col("role")).alias("role"), F.when(here, F.col("text")).alias("text"))


def _told(rows: DataFrame) -> DataFrame:
    """rows with what is wrong with each by itself, and a digest of role and text."""
    bare = F.rtrim("text", F.lit(SPACE))
    digest = F.unhex(F.left(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), F.lit(32)))
    return rows.select("*", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"), digest.alias("digest"))


def _by_conversation(batches) -> Iterator[tuple[object, dict]]:
    for batch in batches:
        for r in batch.to_pylist():
            yield r["conv_id"], r


class _Out:
    """Rows gathered to Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def put(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 256
        if self.size > 4 * PIECE_CHARS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _whole(rows: list[dict]) -> dict:
    """Everything about a conversation of which all rows are here."""
    facts, seen = Facts(), set()
    for r in rows:
        facts.add(r, r["digest"] in seen)
        seen.add(r["digest"])
    cost, audit = cheapest("".join(facts.kinds))
    replay = Replay(audit)
    for r in rows:
        replay.row(r["role"], r["text"])
    return facts.counts() | {"cost": cost, "audit": audit, "repaired_sha256": replay.end()}


def _sort_out(key: pa.DataType, piece_rows: int):
    """Of sorted rows: conversations that lie within the partition as done, all others as pieces."""
    schema = pa.schema([("conv_id", key), ("pid", pa.int32()), ("seq", pa.int64()), ("done", _DONE), ("rows", pa.list_(_ROW))])

    def run(batches):
        out, pid = _Out(schema), TaskContext.get().partitionId()
        now, rows, chars, seq, first, cut, began = None, [], 0, 0, True, False, False

        def ended(last: bool):
            """The conversation ends here; the first and the last of a partition may go on in another."""
            nonlocal seq
            if first or cut or last:
                seq += 1
                return out.put({"conv_id": now, "pid": pid, "seq": seq, "done": None, "rows": rows}, chars)
            return out.put({"conv_id": now, "pid": pid, "seq": 0, "done": _whole(rows), "rows": None}, 512)

        for conv, r in _by_conversation(batches):
            if began and conv != now:
                yield from ended(False)
                rows, chars, first, cut = [], 0, False, False
            now, began = conv, True
            if r["role"] is not None:
                if len(rows) >= piece_rows or chars > PIECE_CHARS:
                    seq += 1
                    yield from out.put({"conv_id": now, "pid": pid, "seq": seq, "done": None, "rows": rows}, chars)
                    rows, chars, cut = [], 0, True
                rows.append({k: r[k] for k in ("turn", "role", "text", "blank", "truncated", "digest")})
                chars += len(r["text"]) + len(r["role"])
        if began:
            yield from ended(True)
        yield from out.flush()

    return run


def _measured(key: pa.DataType):
    """Of pieces with the places of their duplicates: counts and the matrix."""
    ints = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
    schema = pa.schema([("conv_id", key), ("pid", pa.int32()), ("seq", pa.int64()), *[(k, pa.int64()) for k in ints], ("head", pa.string()), ("tail", pa.string()), ("ways", _WAYS)])

    def run(batches):
        out = _Out(schema)
        for conv, p in _by_conversation(batches):
            facts, again = Facts(), set(p["again"] or ())
            for i, r in enumerate(p["rows"]):
                facts.add(r, i in again)
            ways = [w and {"cost": w[0], "audit": w[1]} for layer in matrix("".join(facts.kinds)) for w in layer]
            yield from out.put({"conv_id": conv, "pid": p["pid"], "seq": p["seq"], "ways": ways} | facts.piece(), 24 * len(p["rows"]))
        yield from out.flush()

    return run


def _composed(key: pa.DataType):
    """Of measured pieces in order: the counts, cost and audit string of each conversation."""

    def run(batches):
        out = _Out(pa.schema([("conv_id", key), *_COUNTS]))
        now, facts, layer, began = None, Facts(), start(), False

        def ended():
            cost, audit = best(layer)
            return out.put({"conv_id": now} | facts.counts() | {"cost": cost, "audit": audit}, len(audit))

        for conv, p in _by_conversation(batches):
            if began and conv != now:
                yield from ended()
                facts, layer = Facts(), start()
            now, began = conv, True
            ways = [w and (w["cost"], w["audit"]) for w in p["ways"]]
            layer = compose(layer, [ways[i : i + 4] for i in range(0, 16, 4)])
            facts.then(p)
        if began:
            yield from ended()
        yield from out.flush()

    return run


def _hashed(key: pa.DataType):
    """Of each conversation's result and then its pieces in order: the result with the hash of the repaired conversation."""

    def run(batches):
        out = _Out(pa.schema([("conv_id", key), ("done", _DONE)]))
        now, found, replay = None, None, None
        for conv, p in _by_conversation(batches):
            if p["rows"] is None:
                if replay:
                    yield from out.put({"conv_id": now, "done": found | {"repaired_sha256": replay.end()}}, len(found["audit"]))
                now, found = conv, {k: p[k] for k, _ in _COUNTS}
                replay = Replay(found["audit"])
            else:
                for r in p["rows"]:
                    replay.row(r["role"], r["text"])
        if replay:
            yield from out.put({"conv_id": now, "done": found | {"repaired_sha256": replay.end()}}, len(found["audit"]))
        yield from out.flush()

    return run


def repaired(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """conv_id, counts of faults, cost, audit and repaired_sha256 of every conversation. rows: conv_id, turn, role, text; a row without a role is no turn, it names a conversation only."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    key = pa.schema(rows.select("conv_id").limit(0).toArrow().schema).field("conv_id").type
    # equal rows may change places, so the number by which they are dealt out decides nothing
    told = _told(rows.select("conv_id", "turn", "role", "text")).withColumn("_i", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "digest", "_i"]
    laid = told.repartitionByRange(*order).sortWithinPartitions(*order)
    base = f"conv_id {kind}, pid int, seq long"
    found = saved(laid.drop("_i").mapInArrow(_sort_out(key, piece_rows), f"{base}, done {_DONE_SQL}, rows array<{_ROW_SQL}>"))
    pieces = found.filter("rows is not null").drop("done")
    # duplicates between pieces: the least place of each digest, then all other places
    places = pieces.select("conv_id", "pid", "seq", F.posexplode("rows").alias("pos", "r")).select("conv_id", F.struct("pid", "seq", "pos").alias("at"), F.col("r.digest").alias("digest"))
    firsts = places.groupBy("conv_id", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("_c"), F.col("digest").alias("_d"), "first")
    later = places.join(firsts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d"))).filter("at <> first")
    again = later.groupBy(F.col("at.pid").alias("pid"), F.col("at.seq").alias("seq")).agg(F.collect_list("at.pos").alias("again"))
    sums = "n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string"
    measured = pieces.join(again, ["pid", "seq"], "left").select("conv_id", "pid", "seq", "rows", "again").mapInArrow(_measured(key), f"{base}, {sums}, ways array<struct<cost: long, audit: string>>")
    told_of = measured.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "seq").mapInArrow(_composed(key), f"conv_id {kind}, {_COUNTS_SQL}")
    names = [c for c, _ in _COUNTS]
    none = [F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in names]
    both = told_of.select("conv_id", F.lit(-1).alias("pid"), F.lit(0).cast("long").alias("seq"), *names, F.lit(None).cast(f"array<{_ROW_SQL}>").alias("rows"))
    both = both.unionByName(pieces.select("conv_id", "pid", "seq", *none, "rows"))
    split = both.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "seq").mapInArrow(_hashed(key), f"conv_id {kind}, done {_DONE_SQL}")
    return found.filter("done is not null").select("conv_id", "done").union(split).select("conv_id", "done.*")


def op11_conversation_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the contract has it and repaired."""
    return repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


ORACLE_SQL = r"""WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f
  FROM conversations, tab),
e AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE f <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, role[1:1] AS initial FROM e),
r AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN seen THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS odd FROM n),
moves(s, x, t, role) AS (VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
ways AS (SELECT range AS s, range AS t, NULL::VARCHAR AS x, 4 AS c, 'D' AS l, NULL::VARCHAR AS role FROM range(4) UNION ALL SELECT s, t, x, 0, 'K', NULL FROM moves UNION ALL SELECT s, t, NULL, 3, 'R', role FROM moves WHERE role IS NOT NULL),
shut(t, z, c, l, put) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
    (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:'])),
v(conv_id, i, s, cost, audit, put) AS (
  SELECT conv_id, 0::BIGINT, z, c, l, put FROM (SELECT DISTINCT conv_id FROM conversations), shut WHERE t = 0
  UNION ALL
  SELECT conv_id, i, z, m.cost, m.audit, m.put FROM (
    SELECT v.conv_id, r.i, h.z, min({'cost': v.cost + w.c + h.c + CASE WHEN r.fault = 't' AND w.l <> 'D' THEN 3 ELSE 0 END, 'audit': v.audit || w.l || h.l,
      'put': v.put || CASE w.l WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [w.role || ':' || r.text] END || h.put}) AS m
    FROM v JOIN r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i + 1 JOIN ways w ON w.s = v.s JOIN shut h ON h.t = w.t
    WHERE w.l = 'D' OR (r.fault NOT IN ('b', 'd') AND (w.l = 'R' OR w.x = r.initial)) GROUP BY ALL)),
k AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum((fault = 'b')::INT) AS blank, sum((fault = 'd')::INT) AS duplicate, sum((fault = 't')::INT) AS truncated, coalesce(sum(odd::INT), 0) AS illegal FROM r GROUP BY conv_id),
b AS (SELECT v.conv_id, min({'cost': cost, 'audit': audit, 'put': put}) AS m FROM v LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM v.conv_id WHERE s IN (0, 3) AND i = coalesce(n, 0) GROUP BY v.conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  m.cost::BIGINT AS cost, m.audit AS audit, sha256(array_to_string(m.put, chr(10))) AS repaired_sha256
FROM b LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM b.conv_id"""
