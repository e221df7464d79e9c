"""Problem 8: the token ids of every text by a public byte-level BPE tokenizer.

The merges are compiled into a finite-state transducer that reads the bytes of a pre-token. A state holds what later
bytes can still depend on: the longest suffix that begins a longer token, and the last token of the encoding of each
prefix that ends in it. An encoding is the only token sequence whose adjacent pairs are each what BPE makes of their
bytes, so the last token of the next prefix is the longest vocabulary suffix that agrees with the prefix before it.
States are determinised lazily: the arcs of a state are made when a text first takes them, and equal states are one.
A prefix that can still become the end of a token ends in the live suffix, which is shorter than the longest token; once
all of these prefixes have their last boundary in common, what lies before it is final. It is given out every
``LOOKAHEAD`` bytes, so that a pre-token of any length is run with a short buffer.

Texts are read in one streaming pass: the pre-token pattern cuts them, each pre-token is looked up in the transducer's
memo of finished paths and run through the arcs only when it is new. ``decode`` streams the other way by an incremental
UTF-8 state machine. The vocabulary file's path is a parameter; the file is read on the driver and goes to the executors
with the task.

Defined results: null and empty texts give an empty list; strings that look like special tokens are ordinary text;
lone surrogates cannot occur in Spark strings; repeated rows are each encoded; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The pre-token pattern of byte-level BPE; a fixed value of the public tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Finished pre-tokens kept per Python worker; beyond it the memo starts anew, which costs time only.
MEMO = 400_000
#: States kept per Python worker; beyond it they are made anew.
STATES = 50_000
#: Bytes of a pre-token after which what is final is given out.
LOOKAHEAD = 256
#: Where the public vocabulary files lie unless told otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


class Transducer:
    """A lazily determinised transducer from the bytes of a pre-token to its token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.begins = {b[:k] for b in ranks for k in range(1, len(b))}
        self.pattern = regex.compile(PATTERN)
        # parts[t]: the two tokens whose merge makes t, None for single bytes
        self.parts: dict[int, tuple[int, int] | None] = {}
        for piece, rank in ranks.items():
            self.parts[rank] = self._last_merge(piece, rank) if len(piece) > 1 else None
        self.agrees: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self._restart()

    def _restart(self) -> None:
        # a state: the live bytes and the last tokens of the prefixes before and at each of them; -1: the empty prefix
        self.numbers: dict[tuple[bytes, tuple[int, ...]], int] = {(b"", (-1,)): 0}
        self.states: list[tuple[bytes, tuple[int, ...]]] = [(b"", (-1,))]
        self.arcs: list[dict[int, int]] = [{}]

    def _last_merge(self, piece: bytes, rank: int) -> tuple[int, int] | None:
        """The pair that the merges below ``rank`` leave of ``piece``; its merge gives the token."""
        parts = self._merge(piece, rank)
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _merge(self, piece: bytes, below: int | None = None) -> list[int]:
        """Plain BPE, used to compile the merges: the lowest pair first, leftmost on ties."""
        ranks = self.ranks
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            low, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if low == 1 << 60 or below is not None and low >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _agree(self, left: int, right: int) -> bool:
        """Whether BPE keeps the boundary between two adjacent tokens: no earlier merge would cross it."""
        known = self.agrees.get((left, right))
        if known is not None:
            return known
        a, b, limit = left, right, 1 << 60  # merges from ``limit`` on came too late to cross the boundary
        while True:
            crossing = self.ranks.get(self.tokens[a] + self.tokens[b])
            if crossing is not None and crossing < limit:
                known = False
                break
            # undo the younger token to see the pair that met here before it; equal ones merge from the left
            if a > b and (parts := self.parts[a]):
                limit, a = a, parts[1]
            elif parts := self.parts[b]:
                limit, b = b + 1, parts[0]
            elif parts := self.parts[a]:
                limit, a = a, parts[1]
            else:
                known = True
                break
        self.agrees[left, right] = known
        return known

    def _step(self, state: int, byte: int) -> int:
        recent, last = self.states[state]
        recent += bytes((byte,))
        ranks, token = self.ranks, -1
        for size in range(len(recent), 0, -1):
            t = ranks.get(recent[-size:])
            if t is not None and (last[-size] < 0 or self._agree(last[-size], t)):
                token = t
                break
        # only what begins a longer token can matter to later bytes
        live = next((k for k in range(len(recent), 0, -1) if recent[-k:] in self.begins), 0)
        key = (recent[len(recent) - live :], (*last, token)[-live - 1 :])
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.arcs.append({})
        self.arcs[state][byte] = number
        return number

    def _final(self, ends: list[int], live: int) -> int:
        """The last boundary that all prefixes ending in the last ``live`` bytes have in common; ``ends`` holds the last token of each prefix."""
        n = len(ends)
        if live >= n:
            return 0
        back = lambda at: at - len(self.tokens[ends[at - 1]])
        known, at = {0}, n - live
        common = at
        while at > 0:
            known.add(at)
            at = back(at)
        for at in range(n - live + 1, n + 1):
            while at not in known:
                at = back(at)
            common = min(common, at)
        return common

    def _run(self, piece: bytes) -> tuple[int, ...]:
        """The tokens of one pre-token: forward over the arcs; what is final is read backwards and given out."""
        if len(self.states) > STATES:
            self._restart()
        state, ends, out = 0, [], []
        arcs = self.arcs

        def give(upto: int) -> None:
            tokens, at = [], upto
            while at > 0:
                tokens.append(ends[at - 1])
                at -= len(self.tokens[tokens[-1]])
            out.extend(reversed(tokens))
            del ends[:upto]

        for byte in piece:
            following = arcs[state].get(byte)
            state = self._step(state, byte) if following is None else following
            ends.append(self.states[state][1][-1])
            if not len(ends) % LOOKAHEAD:
                give(self._final(ends, len(self.states[state][0])))
        give(len(ends))
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; null and empty texts give an empty list."""
        if not text:
            return []
        memo, out = self.memo, []
        for piece in self.pattern.findall(text):
            ids = memo.get(piece)
            if ids is None:
                if len(memo) >= MEMO:
                    memo.clear()
                ids = self._run(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= 64:
                    memo[piece] = ids
            out.extend(ids)
        return out

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of ids in stretches, each given out as soon as its characters are whole."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if part := machine.decode(self.tokens[i]):
                yield part
        if part := machine.decode(b"", final=True):
            yield part


@lru_cache(maxsize=4)
def compiled(vocabulary: bytes) -> Transducer:
    """The transducer of a vocabulary (base64 token and rank per line), compiled once per Python worker."""
    lines = (line.split() for line in vocabulary.splitlines())
    return Transducer({base64.b64decode(x[0]): int(x[1]) for x in lines if len(x) == 2})


def transducer(path: str = VOCABULARY) -> Transducer:
    """The transducer of a vocabulary file."""
    return compiled(Path(path).read_bytes())


def encode_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id_column, ids ARRAY<INT>) of every row of ``df``; rows stay where they are, there is no shuffle."""
    held = Path(vocabulary).read_bytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(held)
        for b in batches:
            encoded = [machine.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(encoded, pa.list_(pa.int32()))], names=[id_column, "ids"])

    kind = dict(df.dtypes)[id_column]
    return df.select(id_column, text_column).mapInArrow(run, f"{id_column} {kind}, ids array<int>")


def decode_texts(df: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id_column, text) of every row of ``df``: its ids as text, empty for no ids."""
    held = Path(vocabulary).read_bytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(held)
        for b in batches:
            texts = ["".join(machine.decode(ids or ())) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_column, "text"])

    kind = dict(df.dtypes)[id_column]
    return df.select(id_column, ids_column).mapInArrow(run, f"{id_column} {kind}, text string")
