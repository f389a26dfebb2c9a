"""Periodic runs of words, found by a suffix automaton with merged end positions.

A run is a stretch of words with smallest period q, of at least ``least`` words
and ``times`` periods, that no neighbouring word extends. A suffix automaton of
the words gives for each state the ordered set of places where its strings end.
Sets of child states are merged into their parent's, the smaller into the larger;
a place that comes to stand beside another at a distance no greater than the
state's length ends a square, and squares are the seeds of runs: each is extended
to both sides as far as its distance is a period. Two ends of a run one primitive
period apart have nothing between them when they meet (it would give the square a
smaller period), so no run is missed; distances that are multiples of the period
come to the same stretch and the least is kept. As the two ends of a run that
counts meet in a state of its length less the period, shorter states seed nothing.

Only words that lie in a run can matter: of a run, less its last period, every
piece of ``least * (times - 1) / times`` words comes again. Stretches of words
without such a piece that comes again in the same stretch are left out before an
automaton is made; pieces are told by a hash that may only let through too much,
the automaton compares the words themselves.

A document is one row and its work one task's; memory is that of its words and of
the automaton of one stretch (about 600 bytes a word). Null and empty texts have
no words and no runs, repeated rows each get a row, an empty table gives none, and
columns besides the two are not read. Equal exponents go to the smaller start,
then the smaller period.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.text import Block, covered, map_blocks, mix

LEAST, TIMES = 24, 3
#: The most places in one part of an ordered set.
PART = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def stretches(x: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(start, end) of stretches of words covered by pieces of ``size`` words that come again within the same stretch."""
    if len(x) <= size:
        return []
    h, k = mix(x.astype(np.uint64) + _ODD), 1
    while k < size:
        step = min(k, size - k)
        h = mix(h[: len(h) - step] * _ODD + h[step:])
        k += step
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    first, then = order[:-1][same], order[1:][same]
    while len(first):
        inside = covered(np.concatenate([first, then]), size, len(x))
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        part = np.searchsorted(edges, first, "right")
        stay = part == np.searchsorted(edges, then, "right")
        if stay.all():
            return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        first, then = first[stay], then[stay]
    return []


class Ends:
    """An ordered set of places, in parts of bounded size."""

    __slots__ = ("parts", "size")

    def __init__(self, place: int):
        self.parts, self.size = [[place]], 1

    def add(self, place: int) -> tuple[int | None, int | None]:
        """Add a new place; the ones before and after it."""
        parts, at = self.parts, 0
        if len(parts) > 1:
            at = max(bisect_right(parts, place, key=lambda p: p[0]) - 1, 0)
        part = parts[at]
        i = bisect_left(part, place)
        before = part[i - 1] if i else (parts[at - 1][-1] if at else None)
        after = part[i] if i < len(part) else (parts[at + 1][0] if at + 1 < len(parts) else None)
        part.insert(i, place)
        self.size += 1
        if len(part) > PART:
            parts[at : at + 1] = [part[: PART // 2], part[PART // 2 :]]
        return before, after


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of each state, and the state of each prefix; state 0 is the root."""
    length, link, moves, prefix, last = [0], [-1], [{}], [], 0
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        moves.append({})
        at = last
        while at >= 0 and word not in moves[at]:
            moves[at][word] = new
            at = link[at]
        if at >= 0:
            to = moves[at][word]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                # the state holds longer strings too: the shorter ones get a state of their own
                split = len(length)
                length.append(length[at] + 1)
                link.append(link[to])
                moves.append(dict(moves[to]))
                link[to] = link[new] = split
                while at >= 0 and moves[at].get(word) == to:
                    moves[at][word] = split
                    at = link[at]
        prefix.append(new)
        last = new
    return length, link, prefix


def seeds(words: list[int], least: int, times: int) -> dict[int, list[int]]:
    """By distance: where squares of that distance end, of runs that can count."""
    length, link, prefix = automaton(words)
    sets: list[Ends | None] = [None] * len(length)
    for place, state in enumerate(prefix):
        sets[state] = Ends(place)
    found: dict[int, list[int]] = {}
    for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
        up, mine = link[state], sets[state]
        sets[state] = None
        if up == 0:
            continue
        held, most = sets[up], length[up]
        if held is None:
            sets[up] = mine
            continue
        small, large = (mine, held) if mine.size < held.size else (held, mine)
        for part in small.parts:
            for place in part:
                before, after = large.add(place)
                for low, high in ((before, place), (place, after)):
                    if low is not None and high is not None:
                        apart = high - low
                        if apart * (times - 1) <= most and apart <= most and most + apart >= least:
                            found.setdefault(apart, []).append(high)
        sets[up] = large
    return found


def _equal_for(x: np.ndarray, at: int, apart: int, way: int) -> int:
    """How many words from ``at`` on, going up or down, equal the word ``apart`` places before."""
    room = len(x) - at if way > 0 else at - apart + 1
    done, size = 0, 64
    while done < room:
        n = min(size, room - done)
        low = at + done if way > 0 else at - done - n + 1
        differs = np.flatnonzero(x[low : low + n] != x[low - apart : low - apart + n])
        if len(differs):
            return done + int(differs[0] if way > 0 else n - 1 - differs[-1])
        done, size = done + n, size * 2
    return done


def runs(x: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """(start, length, period) of every run of a row of numbers, by start and then period."""
    found: dict[tuple[int, int], int] = {}
    size = -(-least * (times - 1) // times)
    for low, high in stretches(x, size):
        for apart, ends in seeds(x[low:high].tolist(), least, times).items():
            past = -1
            for end in sorted(ends):
                end += low
                if end < past:
                    continue
                start = end - _equal_for(x, end, apart, -1) - apart + 1
                past = end + 1 + _equal_for(x, end + 1, apart, 1)
                span = (start, past)
                found[span] = min(found.get(span, apart), apart)
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(least, times * q))


def most_periodic(found: list[Run]) -> Run | None:
    """The run of greatest exponent, compared exactly."""
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words that stay if of each run only the first period does."""
    if not found:
        return words
    delta = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        delta[start + period] += 1
        delta[start + length] -= 1
    gone = np.cumsum(delta[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by the checksum of its id, has its words from a place on replaced by the first of them, over and over; null ids leave the text as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", least: int = LEAST, times: int = TIMES, edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """id, n_words, runs (start, length, period), best (the run of greatest exponent) and collapsed (the text without what runs repeat) of every document.

    ``edit`` may replace a document's words before they are looked at.
    """

    def work(block: Block, rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, n_words, each, best, texts = rows.column(id_col), [], [], [], []
        for i, doc_id in enumerate(ids.to_pylist()):
            words = block.text(i).split()
            if edit:
                words = edit(doc_id, words)
            found: list[Run] = []
            if len(words) >= least:
                number: dict[bytes, int] = {}
                found = runs(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)), least, times)
            n_words.append(len(words))
            each.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
            top = most_periodic(found)
            best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
            texts.append(b" ".join(collapsed(words, found)))
        kinds = [(id_col, ids.type), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("collapsed", pa.string())]
        made = [ids, pa.array(n_words, pa.int64()), pa.array(each, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(texts, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(made, schema=pa.schema(kinds))

    run = "struct<start: long, length: long, period: long>"
    return map_blocks(docs, [id_col], work, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, runs array<{run}>, best {run}, collapsed string")


def op12_suffix_automaton_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the tails that the contract repeats."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), edit=repeated_tail)
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
