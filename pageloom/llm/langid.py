"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for each bit a binary classifier over
hashed byte n-grams tells the languages with a one from those with a zero. A
text's bits are read softly, as mean log odds per n-gram, and decoded with a
loss for each bit, weighted by how well that bit was told apart in training; the
codeword with the least loss names the language. Where the two best codewords
lie close together, or the bits speak for the best one by far less than is usual
for its language (a text of no learned language), the text is ambiguous.

The classifiers are naive Bayes, so training is one pass of counts over every
training text (no sample), added up per language and bucket. For up to
``EXHAUSTIVE`` languages the code has all splits of them; beyond it, random
splits of a fixed seed.

Null texts and texts without a letter are ``und`` with score 0. Null and empty
lang values are not learned. Without training rows everything is ``und``; an
empty table gives no rows. Repeated rows are counted and answered each. Texts of
any length are read whole. Of languages with equal losses the first by name is
taken, and the text is ambiguous. Sums are of whole numbers, so a score does not
depend on which rows share a task. Columns besides id, text and lang are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.text import LOWER, blocks, filter_blocks, map_blocks, mix, row_sums

BUCKETS = 1 << 15
#: Bytes in an n-gram.
SIZES = (1, 2, 3)
#: Up to so many languages the code has every split.
EXHAUSTIVE = 7
#: Occurrences added to each bucket of a language of mean size, and to others in proportion.
PSEUDO = 0.5
#: Below this gap between the best and the second share of the decoded weights a text is ambiguous.
LEAST_GAP = 0.05
#: A text's margin must be so much of what is usual for its language.
LEAST_FIT = 0.15
SHARPNESS = 4.0

#: Weights are whole numbers of this part, so that sums are the same however rows are put together.
UNIT = 2.0**-20

#: Bytes of text that are looked at together: each takes some dozens of bytes of numbers.
BLOCK = 1 << 19

_LETTER = regex.compile(r"\p{L}")


def _grams(block, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size: bucket of the n-gram at each byte, and whether it lies within its row."""
    data = LOWER[block.data].astype(np.uint64)
    n = len(data)
    row = np.repeat(np.arange(len(block)), np.diff(block.offsets))
    out = []
    for size in SIZES:
        count = max(n - size + 1, 0)
        code = np.full(count, size, np.uint64)
        for j in range(size):
            code = code << np.uint64(8) | data[j : j + count]
        out.append(((mix(code) & np.uint64(buckets - 1)).astype(np.int64), row[:count] == row[size - 1 : size - 1 + count]))
    return out


def count_grams(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """lang, bucket, n over whole texts; each task sends a row for each pair it has seen."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for block in blocks(batch.column("text"), BLOCK):
                own = langs[block.first : block.first + len(block)]
                names, code = np.unique(own.astype(str), return_inverse=True)
                at = np.repeat(code.reshape(-1), np.diff(block.offsets))
                for bucket, inside in _grams(block, buckets):
                    flat = at[: len(bucket)] * buckets + bucket
                    found = np.bincount(flat[inside], minlength=len(names) * buckets).reshape(len(names), buckets)
                    for name, counts in zip(names.tolist(), found, strict=True):
                        total[name] = total.get(name, 0) + counts
        for name, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.record_batch({"lang": pa.array([name] * len(seen), pa.string()), "bucket": seen, "n": counts[seen].astype(np.int64)})

    return rows.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int) -> np.ndarray:
    """A row of bits for each language."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:  # every split once: the first language always has a one
        splits = np.arange(2 ** (n - 1) - 1)
        return np.array([[1] * len(splits)] + [[int(s) >> k & 1 for s in splits] for k in range(n - 1)], np.int8)
    rng, best = np.random.default_rng(7), None
    for _ in range(50):  # the random code whose closest rows are farthest apart
        code = rng.integers(0, 2, (n, int(np.ceil(10 * np.log2(n))))).astype(np.int8)
        code = code[:, (code.min(0) != code.max(0))]
        gap = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if best is None or gap > best[0]:
            best = (gap, code)
    return best[1]


@dataclass
class Decoder:
    langs: list[str]
    code: np.ndarray  # +1 and -1, a row for each language
    weights: np.ndarray  # log odds in UNITs, a row for each bucket and a column for each bit
    trust: np.ndarray  # weight of the loss of each bit
    usual: np.ndarray  # for each language the weighed margin of its codeword over its own n-grams

    @classmethod
    def fit(cls, counts: DataFrame, buckets: int = BUCKETS) -> Decoder:
        """From counts: languages times buckets rows come to the driver."""
        table: dict[str, np.ndarray] = {}
        for r in counts.toLocalIterator():
            table.setdefault(r.lang, np.zeros(buckets))[r.bucket] = r.n
        langs = sorted(table)
        bits = codewords(len(langs))
        if not langs:
            return cls([], bits, np.zeros((buckets, 1), np.int32), np.ones(1), np.zeros(0))
        count = np.stack([table[x] for x in langs])
        total = np.maximum(count.sum(1, keepdims=True), 1)
        p = count / total + PSEUDO / total.mean()  # each language counts alike, and a bucket that none has speaks for none
        p /= p.sum(1, keepdims=True)
        columns, trust = [], []
        for bit in bits.T:
            if bit.min() == bit.max():
                columns.append(np.zeros(buckets))
                trust.append(1.0)
                continue
            one, zero = p[bit == 1].mean(0), p[bit == 0].mean(0)
            odds = np.log(one / zero)
            columns.append(odds)
            # how far apart the two sides' expected log odds lie: the surer a bit, the more its loss counts
            trust.append(min(float((p[bit == 1] @ odds).min() - (p[bit == 0] @ odds).max()), 1.0))
        held = np.maximum(np.array(trust), 0.01)
        code, trust = bits * 2.0 - 1, held / held.sum()
        usual = (code * (p @ np.stack(columns, 1)) * trust).sum(1)
        return cls(langs, code, np.rint(np.stack(columns, 1) / UNIT).astype(np.int32), trust, usual)

    def decode(self, margins: np.ndarray, least_gap: float = LEAST_GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share and whether it is unsure, of each row of soft bits."""
        # loss of bit b for language l: log(1 + exp(-sharpness * code * margin)) times the bit's trust
        agree = SHARPNESS * margins[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -agree) * self.trust).sum(2)
        share = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, axis=1)
        if share.shape[1] == 1:  # nothing to tell apart
            return share.argmax(1), order[:, -1], np.zeros(len(share), bool)
        best = share.argmax(1)
        fit = (self.code[best] * margins * self.trust).sum(1) / self.usual[best]
        return best, order[:, -1], (order[:, -1] - order[:, -2] < least_gap) | (fit < LEAST_FIT)


def _answer(model: Decoder, block, least_gap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each row of a block."""
    n = len(block)
    pred, score, unsure = np.full(n, "und", object), np.zeros(n), np.ones(n, bool)
    told = np.array([_LETTER.search(block.text(r).decode()) is not None for r in range(n)], bool)
    if model.langs and told.any():
        width = model.weights.shape[1]
        sums, grams = np.zeros((n, width), np.int64), np.zeros(n, np.int64)
        for bucket, inside in _grams(block, len(model.weights)):
            edge = np.minimum(block.offsets, len(bucket))
            grams += row_sums(inside, edge)
            for b in range(width):
                sums[:, b] += row_sums(model.weights[:, b][bucket] * inside, edge)
        best, share, doubt = model.decode(sums * UNIT / np.maximum(grams, 1)[:, None], least_gap)
        pred[told] = np.array(model.langs, object)[best[told]]
        score[told] = share[told]
        unsure[told] = doubt[told]
    return pred, score, unsure


def predict(docs: DataFrame, decoder: Decoder, *, id_col: str = "doc_id", least_gap: float = LEAST_GAP) -> DataFrame:
    """id, lang_pred, score (0 to 1), ambiguous; only the text is read besides the id."""
    held = docs.sparkSession.sparkContext.broadcast(decoder)

    def fn(block, rows):
        pred, score, unsure = _answer(held.value, block, least_gap)
        return pa.record_batch({id_col: rows.column(id_col), "lang_pred": pa.array(pred.tolist(), pa.string()), "score": score, "ambiguous": unsure})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_blocks(docs, [id_col], fn, f"{id_col} {kind}, lang_pred string, score double, ambiguous boolean", limit=BLOCK)


def keep_told(docs: DataFrame, decoder: Decoder) -> DataFrame:
    """The rows whose language the decoder tells (neither ``und`` nor ambiguous), with their columns. A decoder that has learned nothing is an error if there are rows."""
    if not decoder.langs and not docs.isEmpty():
        raise ValueError("no language was learned: no row with a text and a language that is not held out")
    held = docs.sparkSession.sparkContext.broadcast(decoder)
    return filter_blocks(docs, lambda block: ~_answer(held.value, block, LEAST_GAP)[2], limit=BLOCK)


def held_out(id_col: str = "doc_id"):
    """Documents that training leaves aside: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, *, id_col: str = "doc_id") -> Decoder:
    rows = docs.filter(~held_out(id_col) & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull())
    return Decoder.fit(count_grams(rows))


def identify(docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Train on the rows that are not held out and answer every row."""
    return predict(docs, train(docs, id_col=id_col), id_col=id_col)


def op5_ecoc_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
