import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from oracle import binary_digits
from tokenizers import Tokenizer

from pageloom.llm.text import blocks
from pageloom.llm.tokens import PieceEncoder


def test_as_the_library_encodes():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(2)
    bits = ["a", "Ab", "é", "É", "ß", "×", "÷", "é", "́", "'", "'s", "'LL", "1", "½", "٣", ",", ".", "…", "$$", "-", " ", "  ", "\n", "\t", " ", "　", "\x0b", "\x1f", "\x00", "<|endoftext|>", "<|", "中文", "𝄞", "_", "~", "İ", "ﬁ", "Σ", "the", "I'm"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 25))) for _ in range(4000)] + ["", None, "x" * 30_000, "<|startoftext|>a", "A <|endoftext|>"]
    encoder = PieceEncoder(path, cache=300)
    for block in blocks(pa.array(texts), 3000):
        ids, sizes = encoder.encode(block)
        own = [texts[block.first + r] or "" for r in range(len(block))]
        want = [e.ids for e in library.encode_batch(own, add_special_tokens=False)]
        for text, w, g in zip(own, want, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
            assert w == g.tolist(), repr(text)


def test_pieces_are_told_apart_by_their_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), PieceEncoder(path)
    own = [binary_digits(n, two) for n in (1024, 2048) for letters in ("th", "in", "xy") for two in (letters, letters[::-1])]
    for block in blocks(pa.array(own)):
        ids, sizes = encoder.encode(block)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in own]
