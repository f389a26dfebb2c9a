"""Chat formatting: each assistant turn becomes an example of its own.

An example holds all turns before the reply as context and then the reply; only
the reply is trainable. Turns after the last assistant turn make one more
example without a trainable part, so that every turn can be read back. The
context is repeated in each example, as the method asks: a conversation of n
turns gives text of the order of n squared turns.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>\\n`` for each turn. Inside
roles and texts a backslash is doubled, and a backslash is put after the first
character of each control string (also those of other common templates), so no
text can be read as a turn mark and unescaping gives back every character.

Null roles and texts count as empty. Turns are ordered by turn, role, text (null
turns first); repeated rows stay repeated. A conversation without rows has no
example. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Control strings: a first character, then one of these.
_CONTROL = r"([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def chat_examples(conversations: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """id, example (from 0), formatted, loss_start and loss_chars (code points), is_last."""
    turns = F.array_sort(F.collect_list(F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )))
    convs = conversations.select(id_col, "turn", "role", "text").groupBy(id_col).agg(turns.alias("_turns"))
    piece = lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("reply")
    )
    convs = convs.select(id_col, F.transform("_turns", piece).alias("_p"))
    n = F.size("_p")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("_p", i)["reply"] | (i == n))
    rows = convs.select(id_col, "_p", F.posexplode(ends).alias("example", "_end"))
    last = F.element_at("_p", F.col("_end"))
    before = F.array_join(F.transform(F.slice("_p", F.lit(1), F.col("_end") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    rows = rows.select(id_col, "example", before.alias("_before"), last.alias("_last"), (F.col("_end") == n).alias("is_last"))
    return rows.select(
        id_col, "example",
        F.concat("_before", "_last.head", "_last.body", F.lit(END)).alias("formatted"),
        (F.length("_before") + F.length("_last.head")).cast("long").alias("loss_start"),
        F.when(F.col("_last.reply"), F.length("_last.body")).otherwise(0).cast("long").alias("loss_chars"),
        "is_last",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example: array of (role, text), unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, len(START) + 1, 1 << 30), SEP, 1)).alias("role"),
        unescape(F.substring_index(p, SEP, -1)).alias("text"),
    ))


def read_loss(formatted: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(formatted, start.cast("int") + 1, chars.cast("int")))


def op3_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    examples = chat_examples(table.unionByName(extra))
    turns = F.when(F.col("is_last"), read_turns(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = examples.select("conv_id", "example", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("loss"), F.length("formatted").alias("chars"), turns.alias("turns"))
    back = back.select("conv_id", "example", "loss", "chars", F.size("turns").alias("n"), F.sha2(said, 256).alias("sha"))
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return back.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("sha").alias("turns_sha256"), loss.alias("_loss"), F.sum("chars").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1#\2', 'g'))
    + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1#\2', 'g'))
    + 12 + 10 + 11 AS chars
  FROM rows
), summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR pos = n)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""
