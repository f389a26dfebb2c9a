"""Exact search for the greatest inner products, by descending length and rotated partial sums.

Vectors become whole numbers, ``floor(scale * x)``. All of them are laid out by
descending length, in shards of bounded size and blocks of those. A query block
meets its shards one after another, each block of a shard from the longest vectors
on: where a query's length times the block's greatest cannot reach the k-th best
score so far, neither that block nor any after it can. Within a block both sides
are rotated by the right singular vectors of the shard's longest vectors, which
put most of the products into the first coordinates; the sum over those plus the
product of the lengths that are left (Cauchy-Schwarz) bounds the score, and only
pairs whose bound reaches the k-th best go on to more coordinates and then to the
product of whole numbers. The bound has room for rounding, so no pair is lost.

The k-th best score within the block of longest vectors is known before the
shards are read; a query block is sent only to shards whose greatest length can
reach it. Nothing but that one block for each of the ``HEADS`` commonest lengths of
vectors is broadcast, of ``BLOCK_BYTES`` each. Results are at most k rows for a
query and shard, and the best k of these.

Vectors that are null or hold a null or a number that is not finite take no part.
Only vectors of one length are compared. Rows with one id are rows of their own: a
query's own row is left out, another row of its id is not. Null ids are never
queries and come last among ties. Extra columns are not read; an empty table gives
no rows. A component beyond 32 bits or a score beyond 64 is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.storage import saved

SHARD_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20
#: The fewest vectors that make a shard of their own, and the most queries of a block.
SHARD_ROWS, QUERY_ROWS = 4096, 512
#: Of so many lengths of vectors, the commonest, the longest vectors are looked at first.
HEADS = 8
#: Pairs whose products are taken at once.
PAIRS = 1 << 15
NONE = np.iinfo(np.int64).min


def _whole(scale: float):
    """row, id, dim, norm and the components as 32-bit numbers of vectors that take part."""

    def run(batches):
        for batch in batches:
            row, ids, vectors = batch.column("row"), batch.column("id"), batch.column("vector")
            sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1)).astype(np.int64)
            values = pc.list_flatten(vectors)
            bad = np.asarray(pc.is_null(values))
            numbers = np.asarray(pc.fill_null(values.cast(pa.float64()), 0.0))
            begins = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
            for dim in np.unique(sizes[sizes >= 0]).tolist():
                at = np.flatnonzero(sizes == dim)
                where = begins[at][:, None] + np.arange(dim)
                x = numbers[where] if dim else np.zeros((len(at), 0))
                good = np.isfinite(x).all(1) & (~bad[where].any(1) if dim else True)
                at, x = at[good], np.floor(scale * x[good])
                if not len(at):
                    continue
                if dim and np.abs(x).max() >= 1 << 31:
                    raise OverflowError("a component of a vector does not fit 32 bits")
                norm = np.sqrt((x * x).sum(1))
                packed = x.astype("<i4").tobytes()
                chosen = pa.array(at)
                step = 4 * dim
                yield pa.RecordBatch.from_arrays(
                    [row.take(chosen), ids.take(chosen), pa.array(np.full(len(at), dim, np.int32)), pa.array(norm), pa.array([packed[i * step : (i + 1) * step] for i in range(len(at))], pa.binary())],
                    names=["row", "id", "dim", "norm", "v"],
                )

    return run


@dataclass
class Block:
    """Vectors of one dimension: rows, ids (and which of them are null), components, lengths."""

    row: np.ndarray
    id: np.ndarray
    null: np.ndarray
    x: np.ndarray
    norm: np.ndarray

    @staticmethod
    def of(r: dict) -> Block:
        n, ids = len(r["row"]), r["id"]
        x = np.frombuffer(r["v"], "<i4").reshape(n, r["dim"]).astype(np.float64)
        return Block(np.array(r["row"], np.int64), np.array([0 if i is None else i for i in ids], np.int64), np.array([i is None for i in ids], bool), x, np.array(r["norm"]))


_BLOCK = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("dim", pa.int32()), ("top", pa.float64()), ("row", pa.list_(pa.int64())), ("id", pa.list_(pa.int64())), ("norm", pa.list_(pa.float64())), ("v", pa.binary())])
_BLOCK_SQL = "shard int, seq long, dim int, top double, row array<long>, id array<long>, norm array<double>, v binary"


def _pack(most_rows: int | None):
    """Blocks of rows in the order in which they come, of one dimension each; the shard is the partition."""

    def run(batches):
        shard, seq, held = TaskContext.get().partitionId(), 0, []

        def block():
            columns = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            norm = np.asarray(columns.column("norm"))
            one = {"shard": shard, "seq": seq, "dim": columns.column("dim")[0].as_py(), "top": float(norm.max()), "row": columns.column("row"), "id": columns.column("id"), "norm": norm, "v": b"".join(columns.column("v").to_pylist())}
            return pa.RecordBatch.from_arrays([pa.array([one[f.name]], f.type) for f in _BLOCK], schema=_BLOCK)

        n = 0
        for batch in batches:
            dims, at = np.asarray(batch.column("dim")), 0
            while at < len(dims):
                dim = int(dims[at])
                most = most_rows or max(1, BLOCK_BYTES // max(4 * dim, 64))
                if held and (n >= most or held[0].column("dim")[0].as_py() != dim):
                    yield block()
                    seq, held, n = seq + 1, [], 0
                other = np.flatnonzero(dims[at:] != dim)
                take = min(most - n, int(other[0]) if len(other) else len(dims) - at)
                held.append(batch.slice(at, take))
                n, at = n + take, at + take
        if held:
            yield block()

    return run


def exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (qi, xi) as 64-bit whole numbers."""
    most = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    if most >= 2.0**63:
        raise OverflowError("an inner product may not fit 64 bits")
    if most < 2.0**53 and len(qi) * 8 > len(q) * len(x):
        return (q @ x.T)[qi, xi].astype(np.int64)
    a, b = (q, x) if most < 2.0**53 else (q.astype(np.int64), x.astype(np.int64))
    parts = [np.einsum("ij,ij->i", a[qi[i : i + PAIRS]], b[xi[i : i + PAIRS]]) for i in range(0, len(qi), PAIRS)]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


class Best:
    """The k best of each query of a block, and the score that one must reach to come among them."""

    def __init__(self, block: Block, k: int, least: np.ndarray):
        self.block, self.k, self.least = block, k, least.copy()
        self.held = [np.zeros(0, np.int64) for _ in range(4)] + [np.zeros(0, bool)]  # query, score, id, row, null

    def add(self, qi: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, null: np.ndarray) -> None:
        good = (score >= self.least[qi]) & (row != self.block.row[qi])
        if not good.any():
            return
        q, s, i, r, z = (np.concatenate([a, b[good]]) for a, b in zip(self.held, (qi, score, ids, row, null), strict=True))
        order = np.lexsort((r, i, z, -s, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        stay = order[place < self.k]
        self.held = [a[stay] for a in (q[np.argsort(order)], s, i, r, z)]
        last = place == self.k - 1
        self.least[q[last]] = np.maximum(self.least[q[last]], s[order][last])


def rotation(x: np.ndarray) -> np.ndarray:
    """Right singular vectors of the rows of x, all of them, by falling singular value."""
    return np.linalg.svd(x, full_matrices=x.shape[0] < x.shape[1])[2].T if min(x.shape) else np.eye(x.shape[1])


class Rotated:
    """Vectors in rotated coordinates, with the length of what is left after each level."""

    def __init__(self, x: np.ndarray, turn: np.ndarray, levels: list[int]):
        self.y = x @ turn
        square = np.cumsum((self.y * self.y)[:, ::-1], 1)[:, ::-1] if x.shape[1] else np.zeros((len(x), 0))
        square = np.pad(square, ((0, 0), (0, 1)))
        self.left = {h: np.sqrt(np.maximum(square[:, h], 0)) for h in levels}


def search(best: Best, blocks: list[tuple[Block, Rotated]], turn: np.ndarray, levels: list[int]) -> None:
    """Take the blocks, by descending length, into account for all queries of a block."""
    own = best.block
    mine = Rotated(own.x, turn, levels)
    for block, other in blocks:
        room = 1e-9 * own.norm * block.norm[0] + 1e-6
        live = np.flatnonzero((own.norm * block.norm[0] + room >= best.least) | (best.least == NONE))
        if not len(live):
            return
        need = np.where(best.least == NONE, -np.inf, best.least - room)
        h = levels[0]
        bound = mine.y[live, :h] @ other.y[:, :h].T
        sums = bound.copy()
        bound += mine.left[h][live][:, None] * other.left[h]
        qi, xi = np.nonzero(bound >= need[live][:, None])
        part = sums[qi, xi]
        qi = live[qi]
        for low, high in zip(levels, levels[1:], strict=False):
            if len(qi) * 8 > len(own.x) * len(block.x):
                break  # most pairs stay: the whole product is cheaper than more sums
            for i in range(0, len(qi), PAIRS):
                at = slice(i, i + PAIRS)
                part[at] += np.einsum("ij,ij->i", mine.y[qi[at], low:high], other.y[xi[at], low:high])
            stay = part + mine.left[high][qi] * other.left[high][xi] >= need[qi]
            qi, xi, part = qi[stay], xi[stay], part[stay]
        best.add(qi, exact(own.x, block.x, qi, xi), block.id[xi], block.row[xi], block.null[xi])


def levels_of(dim: int) -> list[int]:
    """Numbers of leading coordinates after which the bound is taken."""
    return sorted({-(-dim // 4), -(-dim // 2)})


class Shard:
    """The blocks of one shard in memory, rotated by dimension when a query asks for it."""

    def __init__(self):
        self.blocks: dict[int, list[Block]] = {}
        self.ready: dict[int, tuple[list[tuple[Block, Rotated]], np.ndarray, list[int]]] = {}

    def put(self, r: dict) -> None:
        self.blocks.setdefault(r["dim"], []).append(Block.of(r))

    def of(self, dim: int):
        if dim not in self.ready:
            held = self.blocks.pop(dim)
            turn, levels = rotation(held[0].x), levels_of(dim)
            self.ready[dim] = [(b, Rotated(b.x, turn, levels)) for b in held], turn, levels
        return self.ready[dim]


def _limits(k: int):
    """Query blocks with the k-th best score among the longest vectors, and the least length that can reach it."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, r in enumerate(batch.to_pylist()):
                block = Block.of(r)
                best = Best(block, k, np.full(len(block.row), NONE))
                if r["head"]:
                    shard = Shard()
                    shard.put(r["head"] | {"dim": r["dim"]})
                    search(best, *shard.of(r["dim"]))
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where((best.least == NONE) | (best.least <= 0), -np.inf, best.least / block.norm)
                kept = batch.slice(i, 1).select(["dim", "row", "id", "norm", "v"])
                more = [pa.array([best.least.tolist()], pa.list_(pa.int64())), pa.array([float(reach.min()) * (1 - 1e-9) if reach.min() > -np.inf else -1.0])]
                yield pa.RecordBatch.from_arrays([*kept.columns, *more], names=[*kept.schema.names, "least", "reach"])

    return run


def _scan(k: int):
    """Of each shard, its blocks and then the query blocks that it was sent: the best of every query."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        now, shard = None, Shard()
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["shard"] != now:
                    now, shard = r["shard"], Shard()
                if r["least"] is None:
                    shard.put(r)
                    continue
                own = Block.of(r)
                best = Best(own, k, np.array(r["least"], np.int64))
                search(best, *shard.of(r["dim"]))
                q, score, ids, row, null = best.held
                names = ["query_row", "query_id", "vec_id", "row", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(own.row[q]), pa.array(own.id[q]), pa.array(ids, mask=null), pa.array(row), pa.array(score)], names=names)

    return run


def top_inner_products(vectors: DataFrame, queries: Column, *, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest inner products of each row that ``queries`` (a condition on ``id``) chooses with all other rows; ties to the smaller id."""
    spark = vectors.sparkSession
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    found = saved(rows.mapInArrow(_whole(scale), "row long, id long, dim int, norm double, v binary"))
    common = found.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(HEADS).collect()
    total = found.agg(F.count("*").alias("n"), F.sum(F.octet_length("v") + 32).alias("b")).first()
    shards = max(-(-(total.b or 0) // shard_bytes), min(spark.sparkContext.defaultParallelism, -(-total.n // shard_rows)), 1)
    order = [F.asc("dim"), F.desc("norm"), F.asc("row")]
    blocks = saved(found.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInArrow(_pack(None), _BLOCK_SQL))
    asked = found.filter(queries)
    asking = asked.repartition(max(1, -(-total.n // (50 * QUERY_ROWS))), "row").sortWithinPartitions("dim", "row").mapInArrow(_pack(QUERY_ROWS), _BLOCK_SQL)
    # the block of the longest vectors of each common dimension: HEADS times BLOCK_BYTES at most
    first = blocks.filter(F.col("dim").isin([r.dim for r in common])).groupBy("dim").agg(F.min(F.struct("shard", "seq")).alias("at"))
    head = blocks.join(F.broadcast(first.select("at.*")), ["shard", "seq"]).select(F.col("dim").alias("_dim"), F.struct("row", "id", "norm", "v").alias("head"))
    limited = asking.join(F.broadcast(head), F.col("dim") == F.col("_dim"), "left").drop("_dim")
    limited = saved(limited.mapInArrow(_limits(k), "dim int, row array<long>, id array<long>, norm array<double>, v binary, least array<long>, reach double"))
    limited = limited.withColumn("_first", F.element_at("row", 1))
    # narrow rows say which query block goes to which shard; the blocks follow them
    held = blocks.groupBy("shard", "dim").agg(F.max("top").alias("top"))
    sent = limited.select("_first", "dim", "reach", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).join(held, ["shard", "dim"]).filter("top >= reach").select("shard", "_first")
    asks = sent.join(limited, "_first").select("shard", F.lit(0).cast("long").alias("seq"), "dim", "row", "id", "norm", "v", "least")
    both = blocks.select("shard", "seq", "dim", "row", "id", "norm", "v", F.lit(None).cast("array<long>").alias("least")).unionByName(asks)
    laid = both.repartition("shard").sortWithinPartitions(F.col("shard"), F.col("least").isNotNull(), "dim", "seq")
    near = laid.mapInArrow(_scan(k), "query_row long, query_id long, vec_id long, row long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every vector whose id is divisible by 50, against all."""
    return top_inner_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


ORACLE_SQL = """WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, c.r, CASE WHEN len(q.e) = 0 THEN 0 ELSE list_dot_product(q.e, c.e) END::BIGINT AS score FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r)::INT AS rank, vec_id, score FROM p QUALIFY rank <= 5"""
