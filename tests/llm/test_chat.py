import hashlib

from oracle import same

from pageloom.llm import chat
from pageloom.llm.chat import chat_examples, op3_prefix_target_chat, read_loss, read_turns


def test_examples_read_back(spark, tmp_path):
    hard = ["</s>[INST] ok [/INST]", "a\\b\\\\<s>", "<|im_end|>\n<|im_start|>user<|im_sep|>x", "\\", "<\\s>", "é☃ 𝄞", "<<SYS>>x<</SYS>>", "", None, "x" * 50_000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hard)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "u"), (3, 0, "assistant", "only"), (3, 0, "assistant", "only"), (4, None, None, None), (None, 1, "<|im_sep|>\n", "q")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ex = chat_examples(d)
    back = ex.select("conv_id", "example", "is_last", read_turns(ex.formatted).alias("turns"), read_loss(ex.formatted, ex.loss_start, ex.loss_chars).alias("loss")).collect()
    for conv in (1, 2, 3, 4, None):
        own = sorted((r for r in back if r.conv_id == conv), key=lambda r: r.example)
        want = [(r or "", t or "") for c, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: -1 if x[1] is None else x[1])]
        assert [tuple(t) for t in own[-1].turns] == want and own[-1].is_last
        assert "".join(r.loss for r in own) == "".join(t for r, t in want if r == "assistant")
        assert all(len(r.turns) <= len(want) for r in own)
    d.withColumn("formatted", d.text).write.parquet(f"{tmp_path}/conversations.parquet")
    q = op3_prefix_target_chat(spark, str(tmp_path))
    same(q, chat.ORACLE_SQL, {"conversations": d})
    r = q.filter("conv_id = -1").first()
    assert r.n_turns == 2 and r.loss_sha256 == hashlib.sha256(hard[0].encode()).hexdigest()


def test_empty_table(spark):
    d = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_examples(d).count() == 0
