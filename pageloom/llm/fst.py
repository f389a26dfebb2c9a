"""Token counts from a tokenizer compiled to a deterministic transducer.

A byte-pair tokenizer gives every prefix of a text one last token, which depends
on the last tokens of a few earlier prefixes only: those from which the text
read so far could still grow into a piece of the vocabulary. These last tokens
(and how many tokens each prefix has, against the present one) are the state of
a deterministic transducer over characters; each transition is annotated with
the tokens it emits, which is negative where pieces join. States are made when
they are first met and the table starts anew beyond ``MAX_STATES``.

A word mark (a space) after another character resets the machine, because no
piece holds a mark after anything else. So the state map of a chunk of text that
holds such a place is constant but for what stands before the first of them and
after the last: maps compose associatively, and a prefix scan over the maps of a
text's chunks gives its count. In a block of texts most chunks are single words,
whose maps are sums; the scan over them is a running sum.

The model must be of the sentencepiece kind with byte fallback, a dummy prefix
and no normalisation; ``Transducer`` refuses others. Null and empty texts have
no tokens. Repeated rows are counted each. Texts of any length are counted
whole. Columns besides id and text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.text import Block, WordMemo, map_blocks, row_sums, words

MARK = "▁"
_MARK_BYTES = MARK.encode()
MAX_STATES = 200_000
#: Texts above this size are cut into chunks of it, and their maps composed.
CHUNK_BYTES = 1 << 20
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[0x20] = False
_NEVER = 1 << 60


class Transducer:
    """Counts of tokens by character transitions, compiled from a vocabulary with scores."""

    def __init__(self, model_file: str, max_states: int = MAX_STATES):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in normal}
        runs = {p for p in self.rank if p == MARK * len(p)}
        if sp.encode("é 　x", out_type=str)[:1] != [MARK + "é"] or any(MARK in p.lstrip(MARK) for p in self.rank) or any(p[:2] == MARK * 2 and p not in runs for p in self.rank):
            raise ValueError("this model is not of the supported kind")
        self.pieces = {p: r for p, r in self.rank.items() if p not in runs or p == MARK}
        self.prefixes = {p[:n] for p in self.pieces for n in range(1, len(p))}
        self.longest = max(map(len, self.pieces))
        self.max_states = max_states
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.joins: dict[tuple[str, str], bool] = {}
        self.run_counts: dict[int, int] = {0: 0, 1: 1}
        self.bare_heads: dict[str, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # state 0: before the first character; a state is its open prefixes: (length, last token before it, tokens before it)
        self.states: list[tuple] = [((0, "", 0),)]
        self.tails = [""]
        self.numbers = {(self.states[0], ""): 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces that the last merge of a piece joins; None for a character."""
        if piece not in self.parts:
            now = list(piece)
            while len(now) > 2:
                ranks = [self.pieces.get(a + b, _NEVER) for a, b in zip(now, now[1:], strict=False)]
                best = min(ranks)
                if best == _NEVER:
                    break
                i = ranks.index(best)
                now[i : i + 2] = [now[i] + now[i + 1]]
            self.parts[piece] = (now[0], now[1]) if len(now) == 2 else None
        return self.parts[piece]

    def _time(self, piece: str) -> float:
        return self.pieces[piece] if len(piece) > 1 else -_NEVER

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether two neighbouring tokens are not merged across their border at any time of their making."""
        key = (a, b)
        if key not in self.joins:
            if len(self.joins) > 1_000_000:
                self.joins.clear()
            self.joins[key] = self._walk(a, b)
        return self.joins[key]

    def _walk(self, a: str, b: str) -> bool:
        until: float = _NEVER  # before this time the two stand side by side
        while True:
            if self.pieces.get(a + b, _NEVER) < until:
                return False
            if len(a) == 1 and len(b) == 1:
                return True
            if self._time(a) > self._time(b):
                until, a = self._time(a), self._split(a)[1]
            else:  # of equal merges the left one comes first
                until, b = self._time(b) + 0.5, self._split(b)[0]

    def _make(self, state: int, char: str) -> tuple[int, int]:
        """A transition and the state it leads to."""
        tail = self.tails[state] + char
        token, count = char, None
        for length, last, before in self.states[state]:  # longest first
            piece = tail[len(tail) - length - 1 :]
            if (piece in self.pieces or length == 0) and (not last or self._stay_apart(last, piece)):
                token = piece
                count = before + (1 if piece in self.pieces else len(char.encode()))
                break
        if count is None:
            raise AssertionError("no last token")
        open_now = [(n + 1, last, before) for n, last, before in self.states[state] if tail[len(tail) - n - 1 :] in self.prefixes]
        found = tuple((n, last, before - count) for n, last, before in [*open_now, (0, token, count)])
        tail = tail[len(tail) - found[0][0] :]
        number = self.numbers.get((found, tail))
        if number is None:
            number = self.numbers[found, tail] = len(self.states)
            self.states.append(found)
            self.tails.append(tail)
            self.next.append({})
        self.next[state][char] = number, count
        return number, count

    def count(self, word: str) -> int:
        """Tokens of a word mark and the word after it."""
        if len(self.states) > self.max_states:
            self._reset()
        state, total, table = 0, 0, self.next
        for char in MARK + word:
            step = table[state].get(char)
            if step is None:
                step = self._make(state, char)
            state = step[0]
            total += step[1]
        return total

    def bare_head(self, word: str) -> bool:
        """Whether the mark before a word stays a token of its own."""
        if word not in self.bare_heads:
            if len(self.bare_heads) > 100_000:
                self.bare_heads.clear()
            state, lasts = 0, [""]
            for char in MARK + word:
                state = (self.next[state].get(char) or self._make(state, char))[0]
                lasts.append(self.states[state][-1][1])
            at = len(lasts) - 1
            while at > len(lasts[at]):
                at -= len(lasts[at])
            self.bare_heads[word] = lasts[at] == MARK
        return self.bare_heads[word]

    def marks(self, n: int) -> int:
        """Tokens of a run of marks alone."""
        if n not in self.run_counts:
            self.run_counts[n] = len(self.library.encode(" " * (n - 1)))
        return self.run_counts[n]

    def spaced(self, n: int, word: str, count: int) -> int:
        """Tokens of n marks and a word, from those of one mark and the word."""
        if n == 1:
            return count
        return self.marks(n) + count - 1 if self.bare_head(word) else self.marks(n - 1) + count


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the count, whatever comes before: head is the text before its first reset.

    ``body`` is the number of tokens between the first and the last reset and
    ``tail`` the text from the last one; without a reset (tail None) the chunk is all head.
    """

    head: str
    body: int = 0
    tail: str | None = None

    @classmethod
    def of(cls, text: str, machine: Transducer) -> ChunkMap:
        """text: marks for spaces. A reset is a mark after another character."""
        resets = [i for i in range(1, len(text)) if text[i] == MARK and text[i - 1] != MARK]
        if not resets:
            return cls(text)
        body = sum(segment(text[a:b], machine) for a, b in zip(resets, resets[1:], strict=False))
        return cls(text[: resets[0]], body, text[resets[-1] :])

    def then(self, other: ChunkMap, machine: Transducer) -> ChunkMap:
        if not self.head and self.tail is None:
            return other
        if not other.head and other.tail is None:
            return self
        border = self.tail if self.tail is not None else self.head
        if other.head[:1] == MARK and border[-1:] != MARK or not other.head:
            # the other chunk begins with a reset, or is told apart at its first character
            inner = ChunkMap("", segment(border, machine) if self.tail is not None else 0, other.head) if other.head else None
            if inner is not None:
                left = replace(self, body=self.body + inner.body, tail=other.head) if self.tail is not None else ChunkMap(self.head, 0, other.head)
                return left if other.tail is None else ChunkMap(left.head, left.body + segment(left.tail, machine) + other.body, other.tail)
        joined = border + other.head
        left = replace(self, tail=joined) if self.tail is not None else ChunkMap(joined)
        if other.tail is None:
            return left
        if left.tail is None:
            return ChunkMap(left.head, other.body, other.tail)
        return ChunkMap(left.head, left.body + segment(left.tail, machine) + other.body, other.tail)

    def total(self, machine: Transducer) -> int:
        return segment(self.head, machine) + self.body + (segment(self.tail, machine) if self.tail is not None else 0)


def segment(text: str, machine: Transducer) -> int:
    """Tokens of some marks and then characters that are none."""
    if not text:
        return 0
    word = text.lstrip(MARK)
    n = len(text) - len(word)
    if not n:
        raise AssertionError("a segment begins with a mark")
    return machine.spaced(n, word, machine.count(word)) if word else machine.marks(n)


def scan(maps: list[ChunkMap], machine: Transducer) -> list[ChunkMap]:
    """The maps of all prefixes, in a number of rounds that is the logarithm of theirs."""
    now, step = list(maps), 1
    while step < len(now):
        now = now[:step] + [now[i - step].then(now[i], machine) for i in range(step, len(now))]
        step *= 2
    return now


class BlockCounter:
    """Counts for blocks of texts; words met lately are remembered."""

    def __init__(self, model_file: str, chunk_bytes: int = CHUNK_BYTES):
        self.machine = Transducer(model_file)
        self.chunk = chunk_bytes
        self.memo = WordMemo(lambda texts: [self.machine.count(t.decode()) for t in texts])

    def _long(self, text: str) -> int:
        """A text by chunks: a map for each, composed by the scan."""
        text = MARK + text.replace(" ", MARK)
        size = self.chunk // 2
        maps = [ChunkMap.of(text[i : i + size], self.machine) for i in range(0, len(text), size)]
        return scan(maps, self.machine)[-1].total(self.machine)

    def count(self, block: Block) -> np.ndarray:
        size = np.diff(block.offsets)
        slow = size > self.chunk
        data = block.data.tobytes()
        if _MARK_BYTES in data:
            slow = slow | np.array([_MARK_BYTES in block.text(r) for r in range(len(block))])
        found = words(block, _NOT_SPACE)
        fast = ~slow[found.row]
        start, end, row = found.start[fast], found.end[fast], found.row[fast]
        count = self.memo.numbers(block.data, start, end)
        # spaces before each word (and the mark that every text begins with), and after the last
        opens = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        marks = start - np.where(opens, block.offsets[row], np.r_[0, end[:-1]] if len(end) else end) + opens
        for i in np.flatnonzero(marks > 1).tolist():
            count[i] = self.machine.spaced(int(marks[i]), data[start[i] : end[i]].decode(), int(count[i]))
        first = np.searchsorted(row, np.arange(len(block) + 1))
        out = row_sums(count, first)
        has = first[1:] > first[:-1]
        last = np.where(has, end[np.maximum(first[1:] - 1, 0)] if len(end) else 0, block.offsets[:-1] - 1)
        after = np.where(slow | (size == 0), 0, block.offsets[1:] - last)
        for r in np.flatnonzero(after > 0).tolist():
            out[r] += self.machine.marks(int(after[r]))
        for r in np.flatnonzero(slow).tolist():
            out[r] = self._long(block.text(r).decode())
        return out


_counters: dict[str, BlockCounter] = {}


def _counter(model_file: str) -> BlockCounter:
    """One for each worker process: what it has compiled serves the tasks to come."""
    if model_file not in _counters:
        _counters[model_file] = BlockCounter(model_file)
    return _counters[model_file]


def count_tokens(docs: DataFrame, *, model_file: str, id_col: str = "doc_id") -> DataFrame:
    """id, n_bytes and n_tokens of every whole text."""

    def fn(block, rows):
        return pa.record_batch({id_col: rows.column(id_col), "n_bytes": np.diff(block.offsets).astype(np.int64), "n_tokens": _counter(model_file).count(block).astype(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    return map_blocks(docs, [id_col], fn, f"{id_col} {kind}, n_bytes long, n_tokens long")


def op2_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
