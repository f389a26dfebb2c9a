"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size times, where size is the
source's words and target its share of the mix. The documents of a source are
laid in a row, their expected copies are added up, one offset in [0, 1) that
depends on the source alone is added, and a document is taken once for each
whole number its stretch crosses. So a document is taken the expected times
rounded down or up, and never more often than the cap.

The row is ordered by size class, then id, so that large and small documents are
spread evenly and a source's taken words stay near its target. The sort is over
all partitions by ranges, so no source or size has to fit a task, and positions
come from the counts of the partitions.

Null texts have size 0. A null source is a source of its own, the last by code
point. A source without words has target 0 and all its documents copies 0.
Repeated rows are documents each; of rows with equal source, size and id any may
come first. Texts of any length are counted whole. Columns besides id, source and
text are carried, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.storage import saved

SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target of a table with a row for each source.

    Weights repeat over the sources in code-point order, null last. A target stops at ``cap`` times its source's size and what is above goes to the others by
    weight, until none is above: the sources with the least cap for their weight stop first, so sorted by that ratio a running sum finds which ones stop.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(rank) - 1) % len(weights) + 1)
    frame = sizes.withColumn("_w", weight.cast("double")).withColumn("_ratio", F.col("source_size") / F.col("_w"))
    by = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    rest = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    frame = (
        frame.withColumn("_total", F.sum("source_size").over(whole) * F.lit(share))
        .withColumn("_stopped", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(cap))
        .withColumn("_left", F.sum("_w").over(rest))
    )
    # words for a unit of weight if all sources before this one stop, and whether this one stops too
    frame = frame.withColumn("_unit", (F.col("_total") - F.col("_stopped")) / F.col("_left"))
    frame = frame.withColumn("_stops", F.col("source_size") * F.lit(cap) <= F.col("_unit") * F.col("_w"))
    unit = F.min(F.when(~F.col("_stops"), F.struct("_ratio", "source", "_unit"))).over(whole)["_unit"]
    target = F.when(F.col("_stops"), F.col("source_size") * F.lit(cap)).otherwise(unit * F.col("_w"))
    return frame.select("source", "source_size", target.alias("target"))


def _size_class(size: Column) -> Column:
    """Classes of sizes by leading digits: a step is at most a quarter."""
    digits = F.length(size.cast("string"))
    lead = F.rpad(size.cast("string"), 2, "0").cast("long")
    return F.when(size == 0, F.lit(0).cast("long")).otherwise(digits * 100 + lead).cast("long")


def _offset(source: Column, seed: str) -> Column:
    """The offset of a source in [0, 1), the same on each run."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("="), source), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def place(docs: DataFrame, *, keep: list[str], id_col: str, source_col: str) -> DataFrame:
    """Saved rows with source, size, their place ``at`` in their source (from 1) and a struct ``row`` of the columns to keep.

    Rows are sorted by source, size class and id over all partitions, ranges of which split a hot source; a place is the rows of the source in partitions
    before, and the ones before it in its own.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(source_col).alias("source"), F.col(id_col).alias("id"), n_words(F.col("text")).alias("size"))
    order = [F.col("source").asc_nulls_last(), _size_class(F.col("size")).asc(), F.col("id").asc_nulls_first(), F.col("size").asc()]
    number = F.monotonically_increasing_id()
    rows = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.shiftright(number, 33)).withColumn("seq", number.bitwiseAND((1 << 33) - 1)))
    stretch = rows.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretch = stretch.select(F.col("source").alias("_source"), F.col("part").alias("_part"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("_shift"))
    placed = rows.join(stretch, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    return placed.select("row", "source", "size", (F.col("seq") + F.col("_shift")).alias("at"))


def mix_rows(docs: DataFrame, *, keep: list[str] | None = None, id_col: str = "doc_id", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = SEED) -> DataFrame:
    """row (a struct of the columns to keep, all of docs if not told), source, size, source_size, target and copies of every document."""
    placed = place(docs, keep=keep or docs.columns, id_col=id_col, source_col=source_col)
    targets = source_targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights=weights, share=share, cap=cap)
    placed = placed.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    expected = F.when(F.col("t.source_size") == 0, 0.0).otherwise(F.col("t.target") / F.col("t.source_size"))
    at, offset = F.col("r.at").cast("double"), _offset(F.col("r.source"), seed)
    copies = F.floor(at * expected + offset) - F.floor((at - 1) * expected + offset)
    return placed.select("r.row", "r.source", "r.size", "t.source_size", "t.target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """id, source, size, source_size, target, copies of every document; columns of the same names in docs are not read."""
    own = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), "text")
    made = mix_rows(own, keep=["id"], id_col="id", source_col="source", **how)
    return made.select(F.col("row.id").alias(id_col), "source", "size", "source_size", "target", "copies")


def op9_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM sizes
), summed AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT::DOUBLE * 1.5 AS total,
    coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT::DOUBLE * 2.0 AS stopped,
    sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM weighed
), units AS (
  SELECT *, (total - stopped) / rest AS unit, source_size * 2.0::DOUBLE <= (total - stopped) / rest * w AS stops FROM summed
), targets AS (
  SELECT source, source_size, CASE WHEN stops THEN source_size * 2.0::DOUBLE
    ELSE w * (SELECT u.unit FROM units u WHERE NOT u.stops ORDER BY u.source_size / u.w, u.source NULLS LAST LIMIT 1) END::DOUBLE AS target
  FROM units
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY
    CASE WHEN size = 0 THEN 0 ELSE len(size::VARCHAR) * 100 + rpad(size::VARCHAR, 2, '0')[1:2]::BIGINT END, doc_id NULLS FIRST, size) AS pos
  FROM rows
), laid AS (
  SELECT p.doc_id, p.size, t.source_size, t.target, p.pos::DOUBLE AS pos,
    CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END::DOUBLE AS expected,
    ('0x' || md5('mix-1:' || coalesce('=' || p.source, 'null'))[1:8])::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor(pos * expected + shift) - floor((pos - 1) * expected + shift)) * size)::BIGINT AS taken FROM laid
"""
