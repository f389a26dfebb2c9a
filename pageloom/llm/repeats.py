"""Repeated passages by enhanced suffix arrays over anchored contexts.

A sorted array of all suffixes of a large corpus can't be shuffled, and need not
be. Of the k-byte grams of each ``LENGTH``-byte window the smallest (rightmost
of equals) is the window's anchor, so equal windows have equal anchors at equal
places. An anchor stands for a run of neighbouring windows; the bytes these
cover are its context. Contexts of one anchor that are equal as a whole need no
further work: all but the first occurrence are repeats. Only the distinct
contexts of an anchor are sorted, as suffixes from the anchor on, with their
longest common prefixes (an enhanced suffix array of the anchor). A scan with a
stack over the prefixes gives the tree of common-prefix intervals; in each
interval the occurrences are told apart by what stands to the left of the
anchor, again by a scan, and those that share a left extension and are at least
``LENGTH`` bytes with it are a maximal repeat: all its occurrences are known,
not just neighbours, and every one but the first is covered.

Equal contexts are joined within a task before they are sent, so a passage that
very many documents share costs each task one row. An anchor with more than
``MOST_CONTEXTS`` distinct contexts is not sorted in one task: its windows are
shuffled by a 128-bit hash instead, and of equal ones all but the first are
repeats. Null and empty texts have no bytes. Matches never cross documents. Texts
of any length are read whole. Documents are ordered by id, rows of one id by the
place at which they were read first, so of repeated rows all but one go. Integer
ids; null ids come first. Columns besides id and text are not read. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from pageloom.llm.storage import saved
from pageloom.llm.text import blocks, map_blocks, mix, rolling_hash, rolling_sums, span_hash
from pageloom.llm.tokens import list_array

LENGTH, GRAM = 100, 24
#: Text of a partition of anchors, in bytes; anchors that a task joins before sending them.
PART_BYTES = 16 << 20
SEGMENT = 1 << 20
#: Partitions at most; beyond it they grow.
MAX_PARTS = 65_536
#: Distinct contexts of an anchor that one task sorts; those of anchors with more meet by their windows.
MOST_CONTEXTS = 4096
_NULL_ID = -(1 << 63)


def anchors(block, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of each anchor: hash, context hash, row, first window, bytes to the anchor, last window less the first."""
    n = len(block.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    at = np.arange(n - gram + 1)
    grams = rolling_hash(rolling_sums(block), at, at + gram)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
    width, have, low = length - gram + 1, 1, key
    while 2 * have <= width:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    # windows that lie in one row
    size = np.diff(block.offsets)
    rows = np.flatnonzero(size >= length)
    counts = size[rows] - length + 1
    starts = np.repeat(block.offsets[rows] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    row = np.repeat(rows, counts)
    anchor = (np.uint64(0xFFFFFFFF) - (low[starts] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    if not len(starts):
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    last = np.r_[new[1:], len(starts)] - 1
    first, final, place = starts[new], starts[last], anchor[new]
    context = mix(span_hash(block.data, first, final + length) ^ (place - first).astype(np.uint64))
    return grams[place], context, row[new], first - block.offsets[row[new]], place - first, final - first


def lcp_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of the common-prefix tree, by a scan with a stack.

    lcp[i] is the common prefix of the suffixes i - 1 and i; lcp[0] is not read.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else -1
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low + 1 < high:
        half = (low + high) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            high = half
    return low


def maximal_repeats(contexts: list[tuple[bytes, bytes]], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the repeats of length or more around one anchor.

    contexts: bytes before the anchor, reversed, and bytes from it on. A repeat
    is what left bytes before and right bytes from the anchor of its members have
    in common; members are all contexts that have it.
    """
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    right = [0] + [_common(contexts[a][1], contexts[b][1]) for a, b in zip(order, order[1:], strict=False)]
    for r, first, last in lcp_intervals(right):
        need = max(length - r, 0)
        members = sorted((i for i in order[first : last + 1] if len(contexts[i][0]) >= need), key=lambda i: contexts[i][0])
        left = [0] + [_common(contexts[a][0], contexts[b][0]) for a, b in zip(members, members[1:], strict=False)]
        for x, low, high in lcp_intervals(left):
            # left-extension diversity: the scan yields an interval where its members' left neighbours differ
            # or end; those whose right ones do not are found again with a longer right part
            if x >= need:
                found = members[low : high + 1]
                after = {contexts[i][1][r : r + 1] for i in found}
                if len(after) > 1 or b"" in after:
                    yield x, r, found


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    return start[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]]


_PACK = "p int, kind int, docs binary, rids binary, doc binary, anchor binary, context binary, lo binary, off binary, span binary"
_FOUND = "kind int, rid long, id long, lo array<int>, end array<int>, off array<int>, anchor array<long>"


def _pack(p: int, kind: int, docs, rids, doc, anchor, context, lo, off, span) -> dict:
    return {"p": p, "kind": kind, "docs": docs.tobytes(), "rids": rids.tobytes(), "doc": doc.astype("<u4").tobytes(), "anchor": anchor.tobytes(), "context": context.tobytes(), "lo": lo.astype("<u4").tobytes(), "off": off.astype("u1").tobytes(), "span": span.astype("<u4").tobytes()}


def _packs(made: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(made, pa.schema([("p", pa.int32()), ("kind", pa.int32()), *[(n, pa.binary()) for n in ("docs", "rids", "doc", "anchor", "context", "lo", "off", "span")]]))


def _found(kind: int, rid, ids, lo, end, off, anchor, by) -> pa.RecordBatch:
    """Rows of _FOUND, one for each run of equal by."""
    new = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
    sizes = np.diff(np.r_[new, len(by)])
    cut = lambda x, t: list_array(x.astype(t), sizes)
    return pa.record_batch({"kind": np.full(len(new), kind, np.int32), "rid": rid[new], "id": ids[new], "lo": cut(lo, np.int32), "end": cut(end, np.int32), "off": cut(off, np.int32), "anchor": cut(anchor, np.int64)})


def _order(anchor, context, ids, rids, lo):
    """Sorted by anchor, context and occurrence, and where a new context begins."""
    order = np.lexsort((lo, rids, ids, context, anchor))
    a, c = anchor[order], context[order]
    return order, np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])] if len(a) else np.zeros(0, bool)


def _send_anchors(rows: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """Packed anchors by part; of equal contexts in a segment of a task the first, and ranges for the others."""

    def run(batches):
        held: list = []
        size, turn = 0, 0

        def flush():
            ids, rids = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            base = np.cumsum([0] + [len(h[0]) for h in held])
            doc = np.concatenate([h[2][2] + b for h, b in zip(held, base, strict=False)])
            anchor, context, lo, off, span = (np.concatenate([h[2][i] for h in held]) for i in (0, 1, 3, 4, 5))
            order, first = _order(anchor, context, ids[doc], rids[doc], lo)
            made, again = [], order[~first]
            if len(again):
                again = again[np.lexsort((lo[again], doc[again]))]
                # ranges of one document that touch become one: keep documents apart by a stride
                stride = np.int64(1) << 32
                start, end = _merged(lo[again] + doc[again] * stride, lo[again] + doc[again] * stride + span[again] + length)
                own = start // stride
                used, at = np.unique(own, return_inverse=True)
                made.append(_pack((turn * 7919) % parts, 0, ids[used], rids[used], at, np.zeros(0), np.zeros(0), start - own * stride, np.zeros(0), end - start))
            keep = order[first]
            part = (mix(anchor[keep]) % np.uint64(parts)).astype(np.int64)
            keep = keep[np.argsort(part, kind="stable")]
            part.sort()
            edges = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                own = keep[edges[p] : edges[p + 1]]
                used, at = np.unique(doc[own], return_inverse=True)
                made.append(_pack(p, 1, ids[used], rids[used], at, anchor[own], context[own], lo[own], off[own], span[own]))
            return _packs(made)

        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for block in blocks(pa.array([expand(z) if z else None for z in batch.column("z").to_pylist()], pa.large_binary())):
                found = anchors(block, length, gram)
                cut = slice(block.first, block.first + len(block))
                held.append((batch.column("id").to_numpy()[cut], batch.column("rid").to_numpy()[cut], found))
                size += len(found[0])
                if size >= SEGMENT:
                    yield flush()
                    held, size, turn = [], 0, turn + 1
        if size:
            yield flush()

    return rows.mapInArrow(run, _PACK)


def _unpack(batches, kinds: dict[int, list]) -> None:
    for batch in batches:
        for r in batch.to_pylist():
            ids, rids, doc = np.frombuffer(r["docs"], np.int64), np.frombuffer(r["rids"], np.int64), np.frombuffer(r["doc"], "<u4")
            kinds[r["kind"]].append((ids[doc], rids[doc], np.frombuffer(r["anchor"], np.uint64), np.frombuffer(r["context"], np.uint64), np.frombuffer(r["lo"], "<u4").astype(np.int64), np.frombuffer(r["off"], "u1").astype(np.int64), np.frombuffer(r["span"], "<u4").astype(np.int64)))


def _meet_anchors(packs: DataFrame, length: int) -> DataFrame:
    """Ranges (kind 0) of all but the first of equal contexts; of anchors with several contexts the first of each (kind 2, or 3 for more than MOST_CONTEXTS)."""
    most = MOST_CONTEXTS

    def run(batches):
        kinds: dict[int, list] = {0: [], 1: []}
        _unpack(batches, kinds)
        for ids, rids, _, _, lo, _, size in kinds[0]:
            yield _found(0, rids, ids, lo, lo + size, lo, lo, rids)
        if not kinds[1]:
            return
        ids, rids, anchor, context, lo, off, span = (np.concatenate([x[i] for x in kinds[1]]) for i in range(7))
        kinds[1].clear()
        order, first = _order(anchor, context, ids, rids, lo)
        again = order[~first]
        if len(again):
            again = again[np.argsort(rids[again], kind="stable")]
            yield _found(0, rids[again], ids[again], lo[again], lo[again] + span[again] + length, off[again], anchor[again].view(np.int64), rids[again])
        keep = order[first]
        same = anchor[keep][1:] == anchor[keep][:-1]
        keep = keep[np.r_[same, False] | np.r_[False, same]] if len(keep) > 1 else keep[:0]
        _, own, n = np.unique(anchor[keep], return_inverse=True, return_counts=True)
        many = n[own.reshape(-1)] > most
        for kind, keep in ((2, keep[~many]), (3, keep[many])):
            if len(keep):
                keep = keep[np.argsort(rids[keep], kind="stable")]
                yield _found(kind, rids[keep], ids[keep], lo[keep], lo[keep] + span[keep] + length, off[keep], anchor[keep].view(np.int64), rids[keep])

    return packs.mapInArrow(run, _FOUND)


def _contexts(asked: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """p and packed contexts: for each one its anchor, document, place and bytes."""
    rows = asked.join(texts, "rid")

    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: dict[int, list] = {}
            for r in batch.to_pylist():
                text = expand(r["z"]) if r["z"] else b""
                for lo, end, off, anchor in zip(r["lo"], r["end"], r["off"], r["anchor"], strict=True):
                    out.setdefault(int(mix(np.array([anchor], np.int64).view(np.uint64))[0] % np.uint64(parts)), []).append((anchor, r["id"], r["rid"], lo, off, text[lo:end]))
            for p, found in out.items():
                cols = list(zip(*found, strict=True))
                yield pa.record_batch({
                    "p": pa.array([p], pa.int32()), **{n: pa.array([list(c)], pa.list_(t)) for n, c, t in zip(("anchor", "id", "rid", "lo", "off", "context"), cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)},
                })

    return rows.select("rid", "id", "lo", "end", "off", "anchor", "z").mapInArrow(run, "p int, anchor array<long>, id array<long>, rid array<long>, lo array<int>, off array<int>, context array<binary>")


def _sort_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """Ranges (rid, lo, end) that maximal repeats cover, the first occurrence left out."""

    def run(batches):
        cols = [np.zeros(0, np.int64)] * 5
        texts: list[bytes] = []
        for batch in batches:
            cols = [np.concatenate([c, batch.column(n).flatten().to_numpy().astype(np.int64)]) for c, n in zip(cols, ("anchor", "id", "rid", "lo", "off"), strict=True)]
            texts += batch.column("context").flatten().to_pylist()
        anchor, ids, rids, lo, off = cols
        order = np.lexsort((lo, rids, ids, anchor))
        edges = np.r_[0, np.flatnonzero(np.diff(anchor[order])) + 1, len(order)] if len(order) else [0]
        got: list[tuple[int, int, int]] = []
        offs, places, names = off.tolist(), lo.tolist(), rids.tolist()
        order = order.tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = order[a:b]  # in order of occurrence
            sides = [(texts[i][: offs[i]][::-1], texts[i][offs[i] :]) for i in own]
            reach: dict[int, set] = {}
            for left, right, members in maximal_repeats(sides, length):
                first = min(members)
                for m in members:
                    if m != first:
                        reach.setdefault(m, set()).add((left, right))
            for m, spans in reach.items():
                i = own[m]
                at = places[i] + offs[i]
                start, end = _merged(np.array([at - x for x, _ in spans]), np.array([at + y for _, y in spans]))
                got += [(names[i], s, e) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        got.sort()
        if got:
            rid, start, end = (np.array(x) for x in zip(*got, strict=True))
            yield _found(0, rid, rid, start, end, start, start, rid)

    return contexts.mapInArrow(run, _FOUND)


def _windows(asked: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """A row for each window of the contexts: its 128-bit hash (h1, h2), id, rid and place lo."""
    rows = asked.join(texts.select("rid", "id", "z"), "rid")

    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for r in batch.to_pylist():
                text = expand(r["z"])
                start, end = _merged(np.array(r["lo"]), np.array(r["end"]) - length + 1)
                at = np.concatenate([np.arange(a, b) for a, b in zip(start.tolist(), end.tolist(), strict=True)])
                hashes = np.frombuffer(b"".join(xxh3_128_digest(text[i : i + length]) for i in at.tolist()), np.int64).reshape(-1, 2)
                yield pa.record_batch({"h1": hashes[:, 0], "h2": hashes[:, 1], "id": np.full(len(at), r["id"]), "rid": np.full(len(at), r["rid"]), "lo": at.astype(np.int32)})

    return rows.select("rid", "id", "lo", "end", "z").mapInArrow(run, "h1 long, h2 long, id long, rid long, lo int")


def shared_windows(windows: DataFrame, length: int) -> DataFrame:
    """rid and arrays lo, end of all windows but the first of equal ones."""
    windows = saved(windows)
    place = F.struct("id", "rid", "lo")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("h1", "h2", "first")
    again = windows.join(first, ["h1", "h2"]).filter(place != F.col("first"))
    return again.groupBy("rid").agg(F.collect_list("lo").alias("lo")).withColumn("end", F.transform("lo", lambda x: x + F.lit(length)))


def numbered_texts(docs: DataFrame, id_col: str) -> DataFrame:
    """rid (a number for each row), id and zstd text z (null if empty) of every row, saved: a lost task computes no other numbers."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("id"), "text").withColumn("rid", F.monotonically_increasing_id())

    def press(block, batch):
        z = zstandard.ZstdCompressor(level=1)
        return pa.record_batch({"rid": batch.column("rid"), "id": batch.column("id"), "z": pa.array([z.compress(block.text(i)) if block.offsets[i + 1] > block.offsets[i] else None for i in range(len(block))], pa.binary())})

    return saved(map_blocks(rows, ["rid", "id"], press, "rid long, id long, z binary"))


def repeated_ranges(docs: DataFrame, *, id_col: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(texts, ranges): rid, id and zstd text z of every row; rid and arrays lo, end of repeated ranges."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(1, math.ceil(total / PART_BYTES)), MAX_PARTS)
    texts = numbered_texts(docs, id_col)
    met = saved(_meet_anchors(_send_anchors(texts, parts, length, gram).repartition(parts, "p"), length))
    joined = [F.flatten(F.collect_list(c)).alias(c) for c in ("lo", "end", "off", "anchor")]
    asked = met.filter("kind = 2").groupBy("rid").agg(*joined)
    sorted_ = _sort_contexts(_contexts(asked, texts, parts).repartition(parts, "p"), length)
    many = shared_windows(_windows(met.filter("kind = 3").groupBy("rid").agg(*joined), texts, length), length)
    ranges = met.filter("kind = 0").select("rid", "lo", "end").unionByName(sorted_.select("rid", "lo", "end")).unionByName(many).groupBy("rid").agg(*joined[:2])
    return texts, ranges


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """id, n_bytes, n_removed, removed (array of start, end), kept (bytes) of every row."""
    texts, ranges = repeated_ranges(docs, id_col=id_col, length=length, gram=gram)
    rows = texts.join(ranges, "rid", "left")

    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text = expand(r["z"]) if r["z"] else b""
                start, end = _merged(np.array(r["lo"] or [], np.int64), np.array(r["end"] or [], np.int64))
                spans = list(zip(start.tolist(), end.tolist(), strict=True))
                kept, at = [], 0
                for s, e in spans:
                    kept.append(text[at:s])
                    at = e
                kept.append(text[at:])
                out.append({"id": None if r["id"] == _NULL_ID else r["id"], "n_bytes": len(text), "n_removed": sum(e - s for s, e in spans), "removed": [{"start": s, "end": e} for s, e in spans], "kept": b"".join(kept)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]))

    done = rows.select("id", "z", "lo", "end").mapInArrow(run, "id long, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept binary")
    return done.withColumnRenamed("id", id_col)


def op8_common_prefix_interval_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: A row for each byte of each document: for small tables.
ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, md5(substr(h, 2 * i + 1, 200)) AS w, i FROM (SELECT rid, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
again AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY w ORDER BY rid, i) AS k FROM w) WHERE k > 1),
new AS (SELECT *, (i - lag(i, 1, -1000) OVER (PARTITION BY rid ORDER BY i) > 100)::INT AS new FROM again),
span AS (SELECT rid, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM new) GROUP BY rid, s),
cut AS (SELECT rid, a, b FROM span UNION ALL SELECT rid, length(h) // 2, length(h) // 2 FROM d),
kept AS (SELECT rid, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a, b) AS k FROM (SELECT c.*, d.h, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a, b) AS z FROM cut c JOIN d USING (rid)) GROUP BY rid),
sums AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY rid)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM d JOIN kept USING (rid) LEFT JOIN sums USING (rid)
"""
