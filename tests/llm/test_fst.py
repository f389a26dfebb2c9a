import random

import public_tokenizers
import pyarrow as pa
import sentencepiece
from oracle import binary_digits

from pageloom.llm.fst import MARK, BlockCounter, ChunkMap, Transducer, count_tokens, scan
from pageloom.llm.text import blocks

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(n, seed=3):
    rng = random.Random(seed)
    pieces = [SP.id_to_piece(i).replace(MARK, " ") for i in range(259, 32000)]
    bits = ["a", "b", "aa", "the", "ing", " ", " ", "  ", "   ", "\n", "\t", "é", "☃", "𝄞", "中", "1", "23", ".", "</s>", "<s>", "<0x41>", MARK, " " * 37, "\x00", "　", "th", "tion", "e", "r", "in", "on"]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))) for _ in range(n)]
    out += ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))) for _ in range(n)]
    out += ["".join(rng.choice("abcdetionrsh") for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    return out + [" " * k for k in range(0, 140)] + ["a" * k for k in range(1, 80)] + ["", "x" * 20_000, "ab " * 20_000, " " * 5000]


def test_blocks_count_as_the_library():
    own = texts(4000)
    counter, got = BlockCounter(PATH, chunk_bytes=4096), []
    for block in blocks(pa.array(own), 20_000):
        got += counter.count(block).tolist()
    want = [len(SP.encode(t)) for t in own]
    assert [(t, g, w) for t, g, w in zip(own, got, want, strict=True) if g != w][:5] == []


def test_maps_compose_from_any_cut():
    machine, rng = Transducer(PATH, max_states=500), random.Random(5)
    for t in texts(150, seed=9):
        t = t[:300]
        whole, at, maps = MARK + t.replace(" ", MARK), 0, []
        while at < len(whole):
            n = rng.randrange(1, 9)
            maps.append(ChunkMap.of(whole[at : at + n], machine))
            at += n
        got = scan(maps, machine)
        if t:
            assert got[-1].total(machine) == len(SP.encode(t)), repr(t)


def test_table(spark):
    rows = [(1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world")]
    d = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(d, model_file=PATH).collect())
    n = len(SP.encode("Hello  world"))
    assert got == [(1, 0, 0), (2, 0, 0), (3, 12, n), (3, 12, n)]
    assert count_tokens(d.limit(0), model_file=PATH).count() == 0


def test_words_are_told_apart_by_their_bytes():
    own = [binary_digits(n, two) for n in (1024, 2048) for letters in ("in", "xy", "th") for two in (letters, letters[::-1])]
    own += ["a\x00", "a", "a\x00\x00", "abcdefgh", "abcdefgh\x00", "abcdefghijklmnop", "abcdefghijklmnopq"]
    counter, got = BlockCounter(PATH), []
    for block in blocks(pa.array(own * 2)):
        got += counter.count(block).tolist()
    assert got == [len(SP.encode(t)) for t in own * 2]
