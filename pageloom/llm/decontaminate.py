"""Benchmark decontamination by winnowing.

Of every run of ``window - k + 1`` consecutive k-word grams the smallest hash is
kept. Two texts that share ``window`` consecutive words therefore share a kept
gram, so joining the kept grams of documents and items misses no shared window.
Each joined gram is extended word by word along its diagonal, and runs of at
least ``window`` words count. Items shorter than a window count where they
occur whole; their grams are all kept (a winnowing window of one).

Grams and short items are found by hash and confirmed word by word. Null and
empty texts have no words and hit nothing. Repeated document rows give repeated
result rows. Repeated items count once per id. Texts of any length are read
whole. Columns besides id and text are not read. Without documents there are no
rows, without items no hits.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.storage import saved
from pageloom.llm.text import ALNUM, Words, blocks, covered, filter_blocks, gram_hash, gram_inside, map_blocks, row_sums, word_hash, words

#: Largest total of item bytes that is sent to every task; beyond it the grams are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: What an item counts besides its text.
ITEM_BYTES = 64
#: Items that are held against a text at a time where grams are joined by a shuffle.
LOT = 64


def winnow(hashes: np.ndarray, found, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept k-grams (rightmost smallest of each window)."""
    grams = gram_hash(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window - k + 1):
        other = grams[j : j + n]
        take = other <= best
        best[take] = other[take]
        at[take] = np.flatnonzero(take) + j
    at = at[gram_inside(found, window)]
    if len(at):
        at = at[np.r_[True, at[1:] != at[:-1]]]
        at = np.unique(at)
    return at, grams[at]


def runs(same: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Start and length of the runs of at least window true neighbours."""
    same = np.r_[False, same, False]
    edges = np.flatnonzero(same[1:] != same[:-1])
    return [(s, e - s) for s, e in zip(edges[::2], edges[1::2], strict=True) if e - s >= window]


def word_bytes(block, found: Words, low: int, high: int) -> list[bytes]:
    """The words from low to high, lower-cased in A-Z."""
    return [block.data[a:b].tobytes().lower() for a, b in zip(found.start[low:high].tolist(), found.end[low:high].tolist(), strict=True)]


@dataclass
class ItemIndex:
    """Kept grams of the items, sorted by hash, and the items' words."""

    ids: list
    words: list[list[bytes]]
    gram: np.ndarray
    item: np.ndarray
    at: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    k: int
    window: int

    @classmethod
    def build(cls, ids: list, texts: list[str | None], k: int, window: int) -> ItemIndex:
        own: list[list[bytes]] = []
        grams, items, ats = [], [], []
        short: dict[int, list[tuple[int, int]]] = {}
        for block in blocks(pa.array(texts, pa.string())):
            found = words(block, ALNUM)
            hashes = word_hash(block, found, lower=True)
            at, gram = winnow(hashes, found, k, window)
            row = found.row[at]
            grams.append(gram)
            items.append(row + len(own))
            ats.append(at - found.first[row])
            for r in range(len(block)):
                low, high = int(found.first[r]), int(found.first[r + 1])
                if 0 < high - low < window:
                    short.setdefault(high - low, []).append((int(gram_hash(hashes[low:high], high - low)[0]), len(own)))
                own.append(word_bytes(block, found, low, high))
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        cut = lambda parts: np.concatenate(parts)[order] if parts else np.zeros(0, np.int64)
        tables = {n: (np.array([h for h, _ in sorted(x)], np.uint64), np.array([i for _, i in sorted(x)])) for n, x in short.items()}
        return cls(ids, own, gram[order], cut(items), cut(ats), tables, k, window)

    def lookup(self, table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index into values, index into the sorted table) of equal hashes."""
        low, high = np.searchsorted(table, values, "left"), np.searchsorted(table, values, "right")
        n = high - low
        at = np.repeat(np.arange(len(values)), n)
        return at, np.repeat(low, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)

    def match(self, block, found: Words) -> list[tuple[int, int, int, int]]:
        """(row, item, first word, words) of every maximal match; words count from the block's first. Hashes only propose, words are compared by their bytes."""
        out = []
        hashes = word_hash(block, found, lower=True)
        at, gram = winnow(hashes, found, self.k, self.window)
        near = np.flatnonzero(self.gram[np.minimum(np.searchsorted(self.gram, gram), max(len(self.gram) - 1, 0))] == gram) if len(self.gram) else []
        if len(near):
            at, gram = at[near], gram[near]
            p, q = self.lookup(self.gram, gram)
            spots = np.unique(np.stack([found.row[at[p]], self.item[q], at[p] - self.at[q]]), axis=1)
            for row, item, shift in spots.T.tolist():
                own = self.words[item]
                low, high = max(0, int(found.first[row]) - shift), min(len(own), int(found.first[row + 1]) - shift)
                same = np.fromiter(map(eq, own[low:high], word_bytes(block, found, shift + low, shift + high)), bool, high - low)
                out += [(row, item, shift + low + s, n) for s, n in runs(same, self.window)]
        for n, (table, items) in self.short.items():
            grams = gram_hash(hashes, n)
            inside = np.flatnonzero(gram_inside(found, n))
            p, q = self.lookup(table, grams[inside])
            for s, item in zip(inside[p].tolist(), items[q].tolist(), strict=True):
                if self.words[item] == word_bytes(block, found, s, s + n):
                    out.append((int(found.row[s]), item, s, n))
        return out


_FOUND = "{id} {kind}, n_words long, n_hit long, item_ids array<string>"


def _scan(docs: DataFrame, index, id_col: str) -> DataFrame:
    """One pass over the texts with the index in every task."""

    def fn(block, rows):
        found = words(block, ALNUM)
        hits = index.value.match(block, found)
        hit = covered(np.array([h[2] for h in hits], np.int64), np.array([h[3] for h in hits], np.int64), len(found)) if hits else np.zeros(len(found), bool)
        ids: list[set] = [set() for _ in range(len(block))]
        for row, item, _, _ in hits:
            ids[row].add(str(index.value.ids[item]))
        return pa.record_batch({
            id_col: rows.column(id_col), "n_words": found.per_row.astype(np.int64), "n_hit": row_sums(hit, found.first),
            "item_ids": pa.array([sorted(x) for x in ids], pa.list_(pa.string())),
        })

    kind = docs.schema[id_col].dataType.simpleString()
    return map_blocks(docs, [id_col], fn, _FOUND.format(id=id_col, kind=kind))


def _grams(frame: DataFrame, key: str, k: int, window: int, lengths: list[int]) -> DataFrame:
    """Distinct (key, kept gram) of a frame of whole texts; of the given short lengths an item's whole text and all grams of a document."""

    def fn(block, rows):
        found = words(block, ALNUM)
        hashes = word_hash(block, found, lower=True)
        at, gram = winnow(hashes, found, k, window)
        row, gram = [found.row[at]], [gram]
        for n in lengths:
            inside = np.flatnonzero(gram_inside(found, n))
            if key == "_item":
                inside = inside[found.per_row[found.row[inside]] == n]
            row.append(found.row[inside])
            gram.append(gram_hash(hashes, n)[inside])
        row, gram = np.concatenate(row), np.concatenate(gram)
        return pa.record_batch({key: rows.column(key).take(pa.array(row)), "_gram": gram.view(np.int64)})

    return map_blocks(frame, [key], fn, f"{key} long, _gram long").distinct()


def _joined(docs: DataFrame, items: DataFrame, id_col: str, item_id: str, k: int, window: int) -> DataFrame:
    """The same result with the grams joined by a shuffle, for items of any size.

    Rows get numbers that are saved with them; a text meets its items in lots of about ``LOT``, so neither is held as a whole.
    """
    number = F.monotonically_increasing_id()
    docs = saved(docs.select(number.alias("_doc"), id_col, "text"))
    items = saved(items.select(number.alias("_item"), F.col(item_id).cast("string").alias("_id"), F.col("text").alias("_text")))

    def size(block, rows):
        return pa.record_batch({"n": words(block, ALNUM).per_row.astype(np.int64)})

    own = items.select("_item", F.col("_text").alias("text"))
    lengths = sorted(r.n for r in map_blocks(own, ["_item"], size, "n long").filter(f"n between 1 and {window - 1}").distinct().collect())
    item_grams = _grams(own, "_item", k, window, lengths)
    pairs = _grams(docs, "_doc", k, window, lengths).join(item_grams, "_gram").select("_doc", "_item").distinct()
    lots = pairs.groupBy("_doc").agg(F.ceil(F.count("*") / LOT).alias("_lots"))
    pairs = pairs.join(lots, "_doc").withColumn("_lot", F.pmod(F.xxhash64("_item"), "_lots")).join(items, "_item")
    lots = pairs.groupBy("_doc", "_lot").agg(F.collect_list(F.struct("_id", "_text")).alias("_items"))
    rows = lots.join(docs.select("_doc", "text"), "_doc")

    def verify(block, rows):
        found = words(block, ALNUM)
        out: dict[str, list] = {"_doc": [], "_id": [], "_start": [], "_n": []}
        for row, (doc, held) in enumerate(zip(rows.column("_doc").to_pylist(), rows.column("_items").to_pylist(), strict=True)):
            index = ItemIndex.build([str(x["_id"]) for x in held], [x["_text"] for x in held], k, window)
            low, high = found.first[row], found.first[row + 1]
            part = Words(found.start[low:high], found.end[low:high], np.zeros(high - low, np.int64), np.array([0, high - low]))
            for _, item, start, n in index.match(block, part):
                for name, value in zip(out, (doc, index.ids[item], start, n), strict=True):
                    out[name].append(value)
        return pa.record_batch({"_doc": pa.array(out["_doc"], pa.int64()), "_id": pa.array(out["_id"], pa.string()), "_start": pa.array(out["_start"], pa.int64()), "_n": pa.array(out["_n"], pa.int64())})

    hits = map_blocks(rows, ["_doc", "_items"], verify, "_doc long, _id string, _start long, _n long")
    # words of the union of the matches of a text: sorted by start, what each adds beyond the farthest end so far
    spans = F.array_sort(F.collect_set(F.struct("_start", (F.col("_start") + F.col("_n")).alias("_end"))))
    union = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), x["_end"] - F.greatest(acc["end"], x["_start"]))).alias("n"), F.greatest(acc["end"], x["_end"]).alias("end")),
        lambda acc: acc["n"],
    )
    hits = hits.groupBy("_doc").agg(union.alias("n_hit"), F.array_sort(F.collect_set("_id")).alias("item_ids"))

    def count(block, rows):
        return pa.record_batch({id_col: rows.column(id_col), "_doc": rows.column("_doc"), "n_words": words(block, ALNUM).per_row.astype(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    counted = map_blocks(docs, [id_col, "_doc"], count, f"{id_col} {kind}, _doc long, n_words long")
    none = F.array().cast("array<string>")
    return counted.join(hits, "_doc", "left").select(id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))


def _index(docs: DataFrame, items: DataFrame, item_id: str, window: int, k: int, limit: int):
    """The items' index as a broadcast, or None if they are too large for one."""
    if not 0 < k <= window:
        raise ValueError("k must be between 1 and window")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ITEM_BYTES))).first()[0] or 0
    if size > limit:
        return None
    held = items.select(item_id, "text").collect()
    return docs.sparkSession.sparkContext.broadcast(ItemIndex.build([r[0] for r in held], [r[1] for r in held], k, window))


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", item_id: str = "item_id", window: int = 10, k: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Words of each document inside a window of any item: id, n_words, n_hit, item_ids (sorted strings)."""
    index = _index(docs, items, item_id, window, k, broadcast_bytes)
    return _joined(docs, items, id_col, item_id, k, window) if index is None else _scan(docs, index, id_col)


def _digest(text):
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def keep_clean(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", item_id: str = "item_id", window: int = 10, k: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows that share no window with any item, with all their columns."""
    index = _index(docs, items, item_id, window, k, broadcast_bytes)
    if index is None:
        # a row goes by its own text, also where its id has another one
        keyed = docs.select(F.struct(docs[id_col].alias("id"), _digest(docs["text"]).alias("text")).alias("_key"), docs["text"])
        hit = _joined(keyed, items, "_key", item_id, k, window).filter("n_hit > 0").select("_key").distinct()
        hit = hit.select(F.col("_key.id").alias("_id"), F.col("_key.text").alias("_text"))
        return docs.join(hit, docs[id_col].eqNullSafe(hit["_id"]) & (_digest(docs["text"]) == hit["_text"]), "left_anti")

    def clean(block):
        found = words(block, ALNUM)
        out = np.ones(len(block), bool)
        out[[h[0] for h in index.value.match(block, found)]] = False
        return out

    return filter_blocks(docs, clean)


def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, unnest(CASE WHEN len(w) > 10 THEN [array_to_string(w[i:i + 9], ' ') for i in range(1, len(w) - 8)] ELSE [array_to_string(w, ' ')] END) AS win FROM b WHERE len(w) > 0),
spot AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw)),
hit AS (SELECT a.rid, a.i, a.n, bw.item FROM spot a JOIN bw ON bw.n = a.n AND bw.win = array_to_string(a.w[a.i:a.i + a.n - 1], ' ')),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
