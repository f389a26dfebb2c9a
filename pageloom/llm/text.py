"""Word and shingle hashing over Arrow string columns, vectorised with numpy.

All functions see whole texts. A batch is cut into blocks of whole rows of
about ``BLOCK_BYTES`` bytes, so memory follows the block and the longest single
text, never the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

BLOCK_BYTES = 1 << 21
#: Spans above so many bytes are hashed one by one.
LONG = 64
_MULT = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_STEP_INV = np.uint64(pow(int(_STEP), -1, 1 << 64))

#: Bytes of words that white space ends: [^\x20\x09-\x0D]
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of letters, digits and non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _MULT) | np.uint64(1)
#: A-Z as a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Keeps the first n of eight bytes.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the step (or its inverse) modulo 2**64."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = np.full(size, _STEP if kind == "up" else _STEP_INV, np.uint64)
        made[0] = 1
        made = np.multiply.accumulate(made)
        if size <= 2 * BLOCK_BYTES:
            _powers[kind] = made
        return made[:n]
    return have[:n]


@dataclass
class Block:
    """Whole rows of a string column: bytes and the offset of each row's text."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of whole rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield Block(row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop


@dataclass
class Words:
    """Words of a block: byte start and end, row of each, first word of each row."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def words(block: Block, table: np.ndarray, cut: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes of the table; runs never cross rows, nor the positions that cut marks."""
    inside = table[block.data]
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[block.offsets] = True
    if cut is not None:
        edge[:n] |= cut
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, block.offsets)
    row = np.repeat(np.arange(len(block)), np.diff(first))
    return Words(start, end, row, first)


def rolling_sums(block: Block) -> np.ndarray:
    """Prefix sums from which ``rolling_hash`` of any byte span follows."""
    sums = np.zeros(len(block.data) + 1, np.uint64)
    np.cumsum(_CODES[block.data] * _power("up", len(block.data)), out=sums[1:])
    return sums


def rolling_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash to choose by, of the bytes from start to end: equal bytes hash alike, but long unequal ones may be made to, so it never tells texts apart."""
    inverse = _power("down", len(sums))
    body = (sums[end] - sums[start]) * inverse[start]
    return mix(body + (end - start).astype(np.uint64) * _MULT)


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of the data on as a number; after the end come zeros."""
    return np.ndarray(len(data), "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """64-bit hash of the bytes from start to end; equal bytes hash alike wherever the key is the same.

    Spans of up to ``LONG`` bytes are mixed eight bytes at a time, longer ones go
    to XXH3, or with a key to BLAKE2. Without a key words can be built that
    collide, so what decides between texts gives one that the builder can't know.
    """
    size = end - start
    out = mix(size.astype(np.uint64) * _MULT ^ np.uint64(key))
    short = np.flatnonzero((size <= LONG) & (size > 0))
    wide, at = _eight(data), 0
    while len(short):
        left = size[short] - at
        value = wide[start[short] + at] & _MASKS[np.minimum(left, 8)]
        out[short] = mix(out[short] * _STEP ^ value)
        at += 8
        short = short[left > 8]
    far = np.flatnonzero(size > LONG)
    if len(far):
        view = memoryview(np.ascontiguousarray(data))
        secret = key.to_bytes(8, "little")
        one = (lambda x: int.from_bytes(blake2b(x, digest_size=8, key=secret).digest(), "little")) if key else xxh3_64_intdigest
        out[far] = np.fromiter((one(view[a:b]) for a, b in zip(start[far].tolist(), end[far].tolist(), strict=True)), np.uint64, len(far))
    return out


def word_hash(block: Block, found: Words, lower: bool, key: int = 0) -> np.ndarray:
    return span_hash(LOWER[block.data] if lower else block.data, found.start, found.end, key)


def corpus_key(docs, text: str = "text") -> int:
    """A key for hashes that follows from all texts: the same on each run, and to build words that collide under it one would have to build them after it."""
    part = lambda at: F.conv(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), at, 12), 16, 10).cast("decimal(38,0)")
    sums = docs.agg(*[F.sum(part(at)).alias(f"s{at}") for at in (1, 13, 25)]).first()
    return int.from_bytes(blake2b(repr([int(s or 0) for s in sums]).encode(), digest_size=8).digest(), "little") | 1


class WordMemo:
    """A number for each word, remembered by the bytes of the word and not by a hash of them.

    ``make`` gets a list of distinct words (bytes) and gives their numbers. Words
    of up to 16 bytes that were seen lately are found in a table of slots.
    """

    def __init__(self, make, slots: int = 1 << 20):
        self.make = make
        self.mask = np.uint64(slots - 1)
        self.first, self.second = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.size, self.number = np.zeros(slots, np.uint8), np.zeros(slots, np.int64)

    def clear(self) -> None:
        self.size[:] = 0

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word from start to end (one byte at least)."""
        if not len(start):
            return np.zeros(0, np.int64)
        size, wide = end - start, _eight(data)
        first = wide[start] & _MASKS[np.minimum(size, 8)]
        second = wide[np.minimum(start + 8, len(data) - 1)] & _MASKS[np.clip(size - 8, 0, 8)]
        slot = (mix(first ^ mix(second + size.astype(np.uint64) * _MULT)) & self.mask).astype(np.int64)
        out = self.number[slot]
        miss = np.flatnonzero((self.first[slot] != first) | (self.second[slot] != second) | (self.size[slot] != size))
        if len(miss):
            held = data.tobytes()
            texts = [held[a:b] for a, b in zip(start[miss].tolist(), end[miss].tolist(), strict=True)]
            own = list(dict.fromkeys(texts))
            made = dict(zip(own, np.asarray(self.make(own)).tolist(), strict=True))
            out[miss] = np.fromiter((made[t] for t in texts), np.int64, len(texts))
            keep = miss[size[miss] <= 16]
            at = slot[keep]
            self.first[at], self.second[at], self.size[at], self.number[at] = first[keep], second[keep], size[keep], out[keep]
        return out


def gram_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, by position of the first; rows are not looked at."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ (out >> np.uint64(32))) * _STEP + hashes[j : j + n]
    return mix(out ^ np.uint64(k))


def gram_inside(found: Words, k: int) -> np.ndarray:
    """True where k consecutive words from here are of one row."""
    n = max(len(found) - k + 1, 0)
    return found.row[:n] == found.row[k - 1 : k - 1 + n]


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Boolean of length n: positions inside any [start, start + width)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + width, -1)
    return np.cumsum(delta[:n]) > 0


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the whole numbers values[first[i]:first[i+1]] for each row."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def map_blocks(frame, columns: list[str], fn, schema: str, text: str = "text", limit: int = BLOCK_BYTES):
    """Apply ``fn(block, rows)`` to blocks of whole rows (of about ``limit`` bytes) of the text column and return its record batches.

    ``rows`` holds the columns asked for, of the same rows as the block. The
    columns are selected by name first, so extra ones in the frame do no harm.
    """

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(text), limit):
                made = fn(block, batch.slice(block.first, len(block)))
                if made is not None and made.num_rows:
                    yield made

    return frame.select(*dict.fromkeys([*columns, text])).mapInArrow(run, schema)


def filter_blocks(frame, fn, text: str = "text", limit: int = BLOCK_BYTES):
    """The rows of the frame for which ``fn(block)`` is true, with all their columns and without a shuffle."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for block in blocks(batch.column(at), limit):
                yield batch.slice(block.first, len(block)).filter(pa.array(fn(block)))
        pa.default_memory_pool().release_unused()  # workers live on

    return frame.mapInArrow(run, frame.schema)
