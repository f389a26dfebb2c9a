"""Token ids in wavelet matrices, one compressed file for each shard.

Documents are dealt out by ranges of their id, sorted, encoded, and each
partition writes its ids as a wavelet matrix: one plane of bits for each bit of
an id, most significant first, each plane stably sorting the ids by its bit.
With the counts of ones before every ``BLOCK`` bits, a token can be read,
counted up to a place and looked up by occurrence from the file, without the
other tokens. Files are Parquet with zstd (a row of a file is one matrix), as
every store that Spark can reach takes them.

Null and empty texts have only the end id. Repeated rows (same id and text) are
kept each; rows of one id are ordered by a hash of their text. Null ids come
first. Texts of any length are encoded whole, in one matrix. An id that does not
fit ``BITS`` bits is an error. Columns besides id and text are not read. An
empty table writes no rows.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pageloom.llm.storage import shared_dir
from pageloom.llm.text import blocks
from pageloom.llm.tokens import PieceEncoder, list_array

BITS = 16
#: Bits between two stored counts of ones.
BLOCK = 512
#: Text of a shard, in bytes, and the ids after which a partition begins another matrix.
SHARD_BYTES = 16 << 20
SHARD_IDS = 8 << 20
#: Partitions at most, so that what is known of each can go to every task; larger tables get more shards in each.
MAX_PARTS = 16_384


def check_ids(ids: np.ndarray) -> np.ndarray:
    """The ids, if they fit the planes."""
    if len(ids) and (int(ids.max()) >> BITS or int(ids.min()) < 0):
        raise ValueError(f"ids need more than {BITS} bits")
    return ids


class WaveletMatrix:
    """Ids below 2**BITS with access, rank and select."""

    def __init__(self, n: int, planes: np.ndarray, zeros: np.ndarray, counts: np.ndarray):
        self.n, self.planes, self.zeros, self.counts = n, planes, zeros, counts

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        check_ids(ids)
        now, n = ids.astype(np.uint16), len(ids)
        width = -(-n // BLOCK) * BLOCK // 8
        planes, zeros, counts = np.zeros((BITS, width), np.uint8), np.zeros(BITS, np.int64), np.zeros((BITS, width * 8 // BLOCK), np.uint32)
        for level in range(BITS):
            bit = (now >> (BITS - 1 - level)) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            planes[level, : len(packed)] = packed
            ones = np.bitwise_count(planes[level].view(np.uint64)).reshape(-1, BLOCK // 64).sum(1)
            counts[level] = np.cumsum(ones) - ones
            low = now[~bit]
            zeros[level] = len(low)
            now = np.concatenate([low, now[bit]])
        return cls(n, planes, zeros, counts)

    def to_bytes(self) -> bytes:
        return b"".join([np.array([self.n, BITS, BLOCK], "<i8").tobytes(), self.zeros.astype("<i8").tobytes(), self.counts.astype("<u4").tobytes(), self.planes.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, bits, block = np.frombuffer(data, "<i8", 3).tolist()
        if (bits, block) != (BITS, BLOCK):
            raise ValueError("not a file of this format")
        groups = -(-n // block)
        at = 24
        zeros = np.frombuffer(data, "<i8", bits, at)
        at += 8 * bits
        counts = np.frombuffer(data, "<u4", bits * groups, at).reshape(bits, groups)
        at += 4 * bits * groups
        return cls(n, np.frombuffer(data, np.uint8, bits * groups * block // 8, at).reshape(bits, -1), zeros, counts)

    def _ones(self, level: int, at: int) -> int:
        """Ones before a place of a plane."""
        if at <= 0:
            return 0
        group = min(at // BLOCK, self.counts.shape[1] - 1)
        first = group * BLOCK
        bits = np.unpackbits(self.planes[level, first // 8 : -(-at // 8)], bitorder="little")[: at - first]
        return int(self.counts[level, group]) + int(bits.sum())

    def access(self, at: int) -> int:
        value = 0
        for level in range(BITS):
            one = int(self.planes[level, at >> 3]) >> (at & 7) & 1
            ones = self._ones(level, at)
            at = int(self.zeros[level]) + ones if one else at - ones
            value = value << 1 | one
        return value

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        """Where the token's occurrences before a place stand after the last plane."""
        low, high = 0, upto
        for level in range(BITS):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (BITS - 1 - level) & 1:
                low, high = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, upto: int | None = None) -> int:
        """How often the token stands before a place (in all, without one)."""
        low, high = self._range(token, self.n if upto is None else upto)
        return high - low

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of the token."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for level in reversed(range(BITS)):
            one = token >> (BITS - 1 - level) & 1
            at = self._find(level, one, at - int(self.zeros[level]) if one else at)
        return at

    def _find(self, level: int, one: int, k: int) -> int:
        """Place of the k-th one (or zero) of a plane."""
        before = self.counts[level].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        group = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[level, group * BLOCK // 8 : (group + 1) * BLOCK // 8], bitorder="little")
        return group * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[group])])

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.rank(token))]

    def all_ids(self) -> np.ndarray:
        """Every id in order: the planes undone from the last."""
        now = np.zeros(self.n, np.uint16)
        for level in reversed(range(BITS)):
            bit = np.unpackbits(self.planes[level], bitorder="little")[: self.n].view(bool)
            before = np.empty_like(now)
            cut = int(self.zeros[level])
            before[~bit] = now[:cut]
            before[bit] = now[cut:] | np.uint16(1 << (BITS - 1 - level))
            now = before
        return now


_encoders: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """One for each worker process: its pieces serve the tasks to come."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def write_shards(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, id_col: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode whole texts and write them in ascending order of id.

    Columns: part and seq (shards are ordered by them), first (ids of the part
    before the shard), n_tokens, doc_ids, doc_tokens (with the end id) and matrix.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(1, math.ceil(total / shard_bytes)), MAX_PARTS)
    rows = docs.select(id_col, "text").repartitionByRange(parts, id_col).sortWithinPartitions(id_col, F.xxhash64("text"))

    def run(batches):
        held: list = []  # (doc ids, sizes, ids)
        size, seq, first = 0, 0, 0
        part = TaskContext.get().partitionId()

        def flush():
            nonlocal held, size, seq, first
            ids = np.concatenate([h[2] for h in held])
            sizes = np.concatenate([h[1] for h in held])
            doc_ids = pa.concat_arrays([h[0] for h in held])
            made = pa.record_batch({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "first": pa.array([first], pa.int64()), "n_tokens": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
                "doc_tokens": list_array(sizes.astype(np.int64), np.array([len(sizes)])),
                "matrix": pa.array([WaveletMatrix.build(ids).to_bytes()], pa.binary()),
            })
            held, size, seq, first = [], 0, seq + 1, first + len(ids)
            return made

        for batch in batches:
            for block in blocks(batch.column("text"), 1 << 20):
                ids, sizes = _encoder(tokenizer).encode(block)
                edge = np.cumsum(sizes)
                ids = check_ids(np.insert(ids.astype(np.int64), edge, end_id))
                held.append((batch.column(id_col).slice(block.first, len(block)), sizes + 1, ids.astype(np.uint16)))
                size += len(ids)
                if size >= SHARD_IDS:
                    yield flush()
        if held:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    rows.mapInArrow(run, f"part int, seq int, first long, n_tokens long, doc_ids array<{kind}>, doc_tokens array<long>, matrix binary").write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens and ids_crc32 of every document, from the files."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType
    sizes = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # MAX_PARTS rows at most
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("_before"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes = row.column("doc_tokens").flatten().to_numpy()
                data = memoryview(WaveletMatrix.from_bytes(row.column("matrix")[0].as_buffer()).all_ids().astype("<u4")).cast("B")
                edge = np.r_[0, np.cumsum(sizes)]
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                yield pa.record_batch({id_col: row.column("doc_ids").flatten(), "start": edge[:-1] + row.column("first")[0].as_py(), "n_tokens": sizes, "ids_crc32": pa.array(crc, pa.int64())})

    schema = T.StructType([T.StructField(id_col, kind)] + [T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")])
    rows = shards.join(F.broadcast(starts), "part").withColumn("first", F.col("first") + F.col("_before"))
    return rows.select("first", "doc_ids", "doc_tokens", "matrix").mapInArrow(run, schema)


def token_files(docs: DataFrame, *, tokenizer: str, end_id: int, id_col: str = "doc_id") -> DataFrame:
    """Write the shards in a new folder of the shared folder and read them back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_shards(docs, path, tokenizer=tokenizer, end_id=end_id, id_col=id_col)
    return read_shards(spark, path, id_col=id_col)


def op4_wavelet_matrix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=1)
