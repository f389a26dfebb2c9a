"""Encoding whole texts with a tokenizer of the tokenizers library, word by word.

The pre-tokenizer of ``word_bpe_49k.json`` never joins characters across white
space, nor Latin letters with digits or ASCII punctuation (but the apostrophe),
so the ids of a text are those of its pieces between such places one after the
other, and a piece seen before need not be encoded again. Case of A-Z does not
matter to it. Texts that hold one of the added special tokens are encoded whole,
as such a token may span pieces. Tests hold both against the library's own
encoding.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from pageloom.llm.text import LOWER, Block, WordMemo, words

#: Pieces that a worker remembers before it starts anew, at about 150 bytes each, and their bytes in all.
CACHE_PIECES = 500_000
CACHE_BYTES = 32 << 20
#: Pieces are cut at these bytes only: space, tab, line feed, carriage return.
_PIECE = np.ones(256, bool)
_PIECE[[0x20, 0x09, 0x0A, 0x0D]] = False
#: 1 letter, 2 digit, 3 punctuation (the apostrophe begins contractions and stays out), 0 any other byte
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[*range(0x30, 0x3A)]] = 2
_KIND[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 3

#: A piece of Latin letters only, which the pre-tokenizer leaves whole and the normalizer but lower-cases.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes themselves, the others from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def _cuts(data: np.ndarray) -> np.ndarray:
    """True where a letter, digit or punctuation mark follows one of another kind, or a digit a digit."""
    before = _KIND[data]
    after = before.copy()
    # letters of two bytes from U+00C0 to U+00FF: the lead counts as what comes, the other byte as what was before
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    after[lead] = 1
    before[lead + 1] = 1
    out = np.zeros(len(data), bool)
    a, b = before[:-1], after[1:]
    out[1:] = (a > 0) & (b > 0) & ((a != b) | (a == 2))
    return out


class PieceEncoder:
    """Ids of the texts of blocks, with a bounded store of the pieces met so far."""

    def __init__(self, path: str, cache: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = cache
        self.bytes = _byte_letters()
        self.memo = WordMemo(self._look_up)
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}  # number of each piece
        self.held = 0  # bytes of these pieces
        self.offsets = np.zeros(1, np.int64)  # of each number: where its ids begin
        self.ids = np.zeros(0, np.int32)
        self.memo.clear()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Pieces of plain letters are one word each and go to the library's model alone, others through all of it."""
        model, letters = self.tokenizer.model, self.bytes
        out: list = [[t.id for t in model.tokenize(p.lower().encode().decode("latin-1").translate(letters))] if _PLAIN(p) else None for p in pieces]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._encode([pieces[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _look_up(self, pieces: list[bytes]) -> list[int]:
        """The number of each piece in the store; new pieces are encoded and added."""
        fresh = [p for p in pieces if p not in self.known]
        if fresh:
            made = self._encode_pieces([p.decode() for p in fresh])
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            self.known.update(zip(fresh, range(len(self.offsets) - 1, len(self.offsets) - 1 + len(fresh)), strict=True))
            self.held += sum(map(len, fresh))
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.fromiter((i for x in made for i in x), np.int32, int(sizes.sum()))])
        return [self.known[p] for p in pieces]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block's texts, and how many each text has."""
        found = words(block, _PIECE, _cuts(block.data))
        if not len(found):
            return np.zeros(0, np.int32), np.zeros(len(block), np.int64)
        if len(self.known) > self.cache or self.held > CACHE_BYTES:
            self._reset()
        number = self.memo.numbers(LOWER[block.data], found.start, found.end)
        sizes = self.offsets[number + 1] - self.offsets[number]
        total = int(sizes.sum())
        begin = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(self.offsets[number] - begin, sizes) + np.arange(total)]
        edge = np.r_[begin, total][found.first]
        if any(x in block.data.tobytes() for x in self.special):
            parts = [ids[edge[r] : edge[r + 1]] for r in range(len(block))]
            for r in range(len(block)):
                text = block.text(r)
                if any(x in text for x in self.special):
                    parts[r] = np.array(self._encode([text.decode("utf-8")])[0], np.int32)
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, np.diff(edge)


def list_array(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """An Arrow array of lists cut from the values."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values))
