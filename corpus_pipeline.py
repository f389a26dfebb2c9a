"""From raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read as the next one's docs. All but the last keep the columns of
documents, whatever others stand beside them. No stage adds or alters text; the
mix repeats rows. Texts of any length are read whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.decontaminate import keep_clean
from pageloom.llm.langid import keep_told, train
from pageloom.llm.mixing import mix_rows
from pageloom.llm.neardup import near_duplicates
from pageloom.llm.storage import shared_dir
from pageloom.llm.wavelet import token_files


def _with(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of docs that the verdict (a table of ``_id``) holds; null ids meet null ids."""
    return docs.join(verdict, docs["doc_id"].eqNullSafe(verdict["_id"]), "left_semi")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the decoder rejects: null, without a letter, or ambiguous (two codewords as near, or none nearer than chance).

    Repeated rows all stay or go. If nothing was learned from a table with rows, that is an error; an empty table stays one. Long texts are judged whole.
    """
    return keep_told(docs, train(docs))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component; of repeated rows all go or stay.

    Texts without words are of no component and stay, rows without an id stay.
    """
    found = near_duplicates(docs).filter("doc_id is null or doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    return _with(docs, found).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a window of words with any benchmark item; null texts share none, and without items all stay."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop each row by the copies that the mix takes of it.

    Null texts have no words and are taken as often as others of their source; ties of source, size and id may change places.
    """
    rows = mix_rows(docs).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and give what they hold: doc_id, start, n_tokens, ids_crc32; a null or empty text is the end id alone, no documents give no rows."""
    import public_tokenizers

    return token_files(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("language ID", language), ("near duplicates", near_duplicate), ("benchmark decontamination", benchmark), ("mix of sources", mixture), ("token files", tokens)]

#: The tokenizer library and the language classifier can't be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the table documents; each stage's rows are kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
