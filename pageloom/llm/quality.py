"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed to ``buckets`` buckets. One pass counts the
buckets over every raw document and over every trusted one (two multinomials);
a second pass scores each document with the mean of log(p_trusted / p_raw) over
its n-grams, so length does not matter; buckets of nearly equal shares count as
equal. A quarter of the trusted documents, told by a hash of the id, counts as
raw only; as any other clean document they did not shape the ratio in their
favour, and the threshold is a low quantile of their scores, however few they
are: the greatest score below which no more than that share lies, which of under
a hundred is the least one. It decides every document (a score equal to it
passes): no noise, the same verdict on each run.

Texts without words (null, empty, white space) have no score and are not kept.
Texts of any length are read whole. Without trusted documents the ratio is zero
everywhere and only the base rules decide. A document counts as trusted if any
of its label rows says so; repeated document rows are each counted and each get
a row. Columns of docs besides id and text are not read, so any names may stand
beside them. Empty documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.langid import held_out
from pageloom.llm.storage import checkpoint
from pageloom.llm.text import SPACED, blocks, covered, gram_hash, gram_inside, map_blocks, row_sums, span_hash, word_hash, words

#: Half for words, half for pairs: a word that trusted text avoids is not drowned by the many rare pairs.
BUCKETS = 1 << 17
#: Share of the trusted documents held out that may lie below the threshold.
QUANTILE = 0.01
#: Scores are counted in steps of so many nats for the quantile.
STEP = 1e-5
#: Occurrences added to both sides of each bucket's ratio: n-grams too rare to tell apart weigh nothing.
PSEUDO = 32.0
#: Buckets whose log ratio is nearer to zero weigh nothing: languages and topics differ by as much.
LEAST_RATIO = 0.3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _ngram_buckets(hashes: np.ndarray, found, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of each word and each pair of neighbouring words: one half of the buckets for either."""
    pairs, half = np.flatnonzero(gram_inside(found, 2)), np.uint64(buckets // 2)
    bucket = np.concatenate([gram_hash(hashes, 1) % half, gram_hash(hashes, 2)[pairs] % half + half])
    return bucket.astype(np.int64), np.concatenate([found.row, found.row[pairs]])


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw, trusted: n-gram counts over all documents and over those with ``_trusted``.

    Each task adds up its own counts and sends a row for each bucket it has seen.
    """

    def run(batches):
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            trusted = batch.column("_trusted").to_numpy(zero_copy_only=False)
            for block in blocks(batch.column("text")):
                found = words(block, SPACED)
                bucket, row = _ngram_buckets(word_hash(block, found, lower=True), found, buckets)
                total[0] += np.bincount(bucket, minlength=buckets)
                total[1] += np.bincount(bucket[trusted[block.first + row]], minlength=buckets)
        seen = np.flatnonzero(total[0])
        yield pa.record_batch({"bucket": seen, "raw": total[0][seen], "trusted": total[1][seen]})

    part = docs.select("_trusted", "text").mapInArrow(run, "bucket long, raw long, trusted long")
    return part.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def log_ratio(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log(p_trusted / p_raw) of each bucket, smoothed, zero below LEAST_RATIO; at most ``buckets`` rows come to the driver."""
    table = counts.select("bucket", "raw", "trusted").toArrow()
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    at = table.column("bucket").to_numpy()
    raw[at], trusted[at] = table.column("raw").to_numpy(), table.column("trusted").to_numpy()
    if not trusted.sum():
        return np.zeros(buckets)
    ratio = np.log((trusted + PSEUDO) / (raw * (trusted.sum() / raw.sum()) + PSEUDO))
    ratio[np.abs(ratio) < LEAST_RATIO] = 0
    return ratio


def _base(block, found, hashes) -> dict[str, np.ndarray]:
    """The counts of the base rules for each row."""
    n = len(block)
    # code points: bytes that do not continue one
    lead = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=lead[1:])
    chars = row_sums(lead[found.end] - lead[found.start], found.first)
    symbols = row_sums(_SYMBOL[block.data], block.offsets)
    # lines: cut after each \n and at each row
    breaks = np.union1d(np.flatnonzero(block.data == 10), block.offsets[1:] - 1)
    breaks = breaks[breaks >= 0]
    stop = breaks + 1
    start = np.r_[0, stop[:-1]] if len(stop) else stop
    ends = stop - (block.data[stop - 1] == 10) if len(stop) else stop
    worded = np.searchsorted(found.start, ends) > np.searchsorted(found.start, start)
    start, ends = start[worded], ends[worded]
    row = np.searchsorted(block.offsets, start, "right") - 1
    dup = _repeated_lines(block, row, start, ends)
    # repeated 8-word windows
    width = 8
    inside = np.flatnonzero(gram_inside(found, width))
    again = inside[_twice(found.row[inside], gram_hash(hashes, width)[inside])]
    again = again[_equal_windows(block, found, again, width)]
    repeat = covered(again, np.full(len(again), width), len(found))
    return {
        "word_chars": chars, "n_symbols": symbols, "n_dup_lines": np.bincount(row, weights=dup, minlength=n).astype(np.int64),
        "n_repeat_words": row_sums(repeat, found.first),
    }


def _groups(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by row, then value, and where in it a (row, value) differs from the one before."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    return order, np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])] if len(r) else np.zeros(0, bool)


def _repeated_lines(block, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """1 where an equal line stands earlier in the same row; lines of one hash are compared by their bytes."""
    out, seen, data = np.zeros(len(row), np.int64), set(), block.data.tobytes()
    for i in np.flatnonzero(_twice(row, span_hash(block.data, start, end))).tolist():
        line = (int(row[i]), data[start[i] : end[i]])
        out[i] = line in seen
        seen.add(line)
    return out


def _equal_windows(block, found, at: np.ndarray, width: int) -> np.ndarray:
    """True where the words of the window at this place stand at another of the places of the same row: told by the words' bytes."""
    if not len(at):
        return np.zeros(0, bool)
    used = np.flatnonzero(covered(at, np.full(len(at), width), len(found)))
    data, number = block.data.tobytes(), {}
    numbers = np.zeros(len(found), np.int32)
    numbers[used] = [number.setdefault(data[a:b], len(number)) for a, b in zip(found.start[used].tolist(), found.end[used].tolist(), strict=True)]
    wide = np.column_stack([found.row[at].astype(np.int32), numbers[at[:, None] + np.arange(width)]])
    _, same, count = np.unique(np.ascontiguousarray(wide).view(f"V{wide.shape[1] * 4}").ravel(), return_inverse=True, return_counts=True)
    return count[same] > 1


def _twice(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the value stands twice or more in the row."""
    order, new = _groups(row, value)
    alone = new & np.r_[new[1:], True] if len(new) else new
    out = np.zeros(len(row), bool)
    out[order] = ~alone
    return out


def score_documents(docs: DataFrame, ratio: np.ndarray, *, id_col: str = "doc_id") -> DataFrame:
    """Base counts and ``score`` (null without words) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(ratio)

    def fn(block, rows):
        found = words(block, SPACED)
        hashes = word_hash(block, found, lower=True)
        bucket, row = _ngram_buckets(hashes, found, len(held.value))
        n = np.bincount(row, minlength=len(block))
        score = np.bincount(row, weights=held.value[bucket], minlength=len(block)) / np.maximum(n, 1)
        base = _base(block, found, word_hash(block, found, lower=False))
        return pa.record_batch({id_col: rows.column(id_col), "n_words": found.per_row.astype(np.int64)} | base | {"score": pa.array(score, mask=n == 0)})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_blocks(docs, [id_col], fn, f"{id_col} {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")


def trusted_ids(labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """_id of the documents that a label row calls good and not toxic."""
    return labels.filter("quality = 1 and toxic = 0").select(F.col(id_col).alias("_id")).distinct()


def trusted_limit(held: DataFrame, quantile: float = QUANTILE) -> float | None:
    """The threshold: at most the share ``quantile`` of the held scores lies below; without any, none. A row for each step of scores comes to the driver."""
    steps = held.filter("score is not null").groupBy(F.floor(F.col("score") / F.lit(STEP)).alias("step")).agg(F.count("*").alias("n")).orderBy("step").collect()
    below, total = 0, sum(r.n for r in steps)
    for r in steps:
        below += r.n
        if below > total * quantile:
            return r.step * STEP


def quality_filter(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """Base counts, base_failed, score, threshold and verdict for every document.

    The texts are shuffled once, to meet the labels for the counts; scores are
    made by a second scan and only they meet the labels for the threshold.
    """
    trusted = trusted_ids(labels, id_col=id_col)
    # without a hint small tables would broadcast the ids and larger ones not
    marked = docs.select(id_col, "text").join(trusted.filter(~held_out("_id")).hint("merge"), F.col(id_col) == F.col("_id"), "left").select("text", F.col("_id").isNotNull().alias("_trusted"))
    scored = checkpoint(score_documents(docs, log_ratio(bucket_counts(marked, buckets), buckets), id_col=id_col))
    limit = trusted_limit(scored.join(trusted.filter(held_out("_id")), F.col(id_col) == F.col("_id"), "left_semi").select("score"))
    passes = F.col("score").isNotNull() & (F.col("threshold").isNull() | (F.col("score") >= F.col("threshold")))
    return (
        scored.withColumn("threshold", F.lit(limit).cast("double"))
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & passes)
    )


def op1_hashed_ngram_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_filter(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and the base verdict alone, which SQL can say."""
    found = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), np.zeros(BUCKETS))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


BASE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
h AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1), p AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM h) GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
o AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN l USING (r) LEFT JOIN p USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM o"""
