"""Problem 9: corpus documents that hold passages of evaluation items, wholly, in part, or with single words replaced.

Winnowing: the words of a text (letter case, punctuation, spacing and line breaks removed) are hashed in k-grams, and of
every window of ``WINDOW`` consecutive k-grams the least hash is kept as a fingerprint. Two texts that share at least
GRAM + WINDOW - 1 consecutive words always share a fingerprint. The fingerprints of the documents are joined with those
of the items; a hit gives a diagonal (the distance between the two places), and every distinct diagonal of a document and
an item is extended over the words themselves: a run of ``RUN`` words or more, or the whole passage with at most one
word in ``SPARE`` replaced, is a leak. With at most n // 8 words of n replaced, some stretch of at least 6 words stays
for every n from ``LONG`` on, so the guarantee covers both cases. A shorter passage is cut into one piece more than words
may be replaced, so that one piece stays whole: the first ``PIECE`` words of its pieces are its fingerprints (of passages
of fewer words their first word), joined with the k-grams of all places of the documents.

The readers pass on only documents with a fingerprint that is in a filter of the items' fingerprints (``filters``), as
the hashes of their words; no other document is moved. Items and documents may both be of any number.

Defined results: null, empty and blank texts and passages hold and leak nothing; passages of fewer than ``RUN`` words
leak only whole; items with equal passages each leak; a repeated document id is reported once per item; other columns
are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm.filters import bit_filter, in_filter
from quirefold.session import cut

GRAM, WINDOW, RUN, SPARE = 5, 2, 14, 8
#: Words from which a passage has winnowed fingerprints; words of a shorter one's piece that are its fingerprint.
LONG, PIECE = 18, 4
#: Diagonals extended at once.
STRIDE = 2048
#: Pieces of text kept per Python worker once taken apart; beyond it the memo starts anew, which costs time only.
MEMO = 500_000

_BREAK = re.compile(r"[\s–—―/|…​﻿]+")
_MARKS = re.compile(r"[^\w%]|_")
_MIX = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64 | 1 for k in range(8)], dtype=np.uint64)


def _pieces(text: str) -> list[str]:
    """What stands between blanks, in one Unicode form and without case; a percent sign stands alone and counts as a word."""
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return (text.replace("%", " % ") if "%" in text else text).casefold().split()


def _words(piece: str) -> list[str]:
    return [w for w in (_MARKS.sub("", p) for p in _BREAK.split(piece)) if w]


def words_of(text: str) -> list[str]:
    """The words of a text without case, punctuation and spacing."""
    return [w for p in _pieces(text) for w in _words(p)]


class Numbers:
    """The words of texts as 64-bit hashes; a piece between blanks is taken apart once."""

    def __init__(self) -> None:
        self.memo: dict[str, int | tuple[int, ...]] = {}

    def of(self, text: str) -> np.ndarray:
        memo, out = self.memo, []
        for piece in _pieces(text):
            known = memo.get(piece)
            if known is None:
                if len(memo) >= MEMO:
                    memo.clear()
                known = [int.from_bytes(xxhash.xxh64_digest(w.encode("utf-8", "surrogatepass")), "big", signed=True) for w in _words(piece)]
                known = memo[piece] = known[0] if len(known) == 1 else tuple(known)
            if known.__class__ is int:
                out.append(known)
            else:
                out.extend(known)
        return np.array(out, np.int64)


def gram_hashes(ids: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive words."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    v = ids.view(np.uint64) + np.uint64(size)
    h = v[:n] * _MIX[0]
    for k in range(1, size):
        h = (h ^ (v[k : k + n] * _MIX[k])) * _MIX[7]
    h = (h ^ (h >> np.uint64(29))) * _MIX[6]
    return h ^ (h >> np.uint64(32))


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Positions of the least hash of every window, the rightmost of equal ones."""
    n = len(hashes)
    if n <= WINDOW:
        return np.array([n - 1 - int(np.argmin(hashes[::-1]))]) if n else np.empty(0, np.int64)
    least = np.zeros(n - WINDOW + 1, np.int64)  # the place of the least hash of each window, counted from its end
    best = hashes[WINDOW - 1 :].copy()
    for back in range(1, WINDOW):
        other = hashes[WINDOW - 1 - back : n - back]
        least[other < best] = back
        np.minimum(best, other, out=best)
    kept = np.zeros(n, bool)
    kept[np.arange(WINDOW - 1, n) - least] = True
    return np.flatnonzero(kept)


def item_prints(ids: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """(words of a gram, [(hash, place), ...]): the fingerprints of a passage."""
    n = len(ids)
    if n >= LONG:
        size, places = GRAM, [int(p) for p in winnow(gram_hashes(ids))]
    elif n >= PIECE:
        parts = n // SPARE + 1
        size, places = PIECE, [n * k // parts for k in range(parts)]
    else:
        size, places = 1, [0] * (n > 0)
    hashes = gram_hashes(ids, size).view(np.int64)
    return size, [(int(hashes[p]), p) for p in places]


def text_prints(ids: np.ndarray, sizes: Iterable[int], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of a text's grams of these sizes that items may have."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for size in sizes:
        hashes = gram_hashes(ids, size)
        at = winnow(hashes) if size == GRAM else np.arange(len(hashes))
        at = at[in_filter(bits, hashes[at])]
        if len(at):
            out.append((hashes[at].view(np.int64), at))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def leaks(ids: np.ndarray, passage: np.ndarray, shifts: np.ndarray) -> bool:
    """Whether a passage, laid on a text at one of the shifts, has a long enough run or lies there whole but for few words."""
    n = len(passage)
    padding = np.zeros(n, np.int64)
    padded, inside = np.concatenate((padding, ids, padding)), np.concatenate((padding, np.ones(len(ids), np.int64), padding)) == 1
    for k in range(0, len(shifts), STRIDE):
        shift = shifts[k : k + STRIDE]
        shift = shift[(shift > -n) & (shift < len(ids))]
        places = shift[:, None] + n + np.arange(n)
        same = (padded[places] == passage) & inside[places]
        whole = (shift >= 0) & (shift + n <= len(ids)) & (n - same.sum(axis=1) <= n // SPARE)
        count = np.cumsum(same, axis=1)
        run = (count - np.maximum.accumulate(np.where(same, 0, count), axis=1)).max(axis=1, initial=0)
        if (whole | (run >= RUN)).any():
            return True
    return False


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The arrays of a list column."""
    for x in column:
        yield np.asarray(x.values, np.int64)


def _list_column(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64), pa.int64()))


def fingerprints(items: DataFrame, item_column: str, passage_column: str) -> DataFrame:
    """(item_key, item, passage, size, prints) of every item with words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for b in batches:
            rows = [(i, ids, *item_prints(ids)) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if len(ids := numbers.of(t))]
            prints = pa.array([[{"print": h, "place": p} for h, p in r[3]] for r in rows], pa.list_(pa.struct([("print", pa.int64()), ("place", pa.int32())])))
            keys = pa.array([xxhash.xxh64_intdigest(r[1].tobytes()) >> 1 for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array([r[0] for r in rows], b.schema.field(0).type), _list_column([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.int32()), prints], names=["item_key", "item", "passage", "size", "prints"])

    kind = dict(items.dtypes)[item_column]
    return items.select(item_column, passage_column).dropna().mapInArrow(run, f"item_key long, item {kind}, passage array<long>, size int, prints array<struct<print:bigint,place:int>>")


def find_leaks(documents: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", passage_column: str = "passage") -> DataFrame:
    """(id_column, item_column) of every document into which an item leaked."""
    prints = cut(fingerprints(items, item_column, passage_column))
    sizes = sorted(r[0] for r in prints.select("size").distinct().collect())  # three at most
    bits = bit_filter(prints.select(F.explode("prints.print").alias("print")), "print")

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = numbers.of(t)
                hashes, places = text_prints(ids, sizes, bits)
                if len(hashes):
                    rows.append((i, ids, hashes, places))
            keys = pa.array([xxhash.xxh64_intdigest(r[1].tobytes()) >> 1 for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array([r[0] for r in rows], b.schema.field(0).type), *(_list_column([r[k] for r in rows]) for k in (1, 2, 3))], names=["text_key", "doc", "words", "hashes", "places"])

    kind = dict(documents.dtypes)[id_column]
    slim = documents.select(id_column, text_column).dropna(subset=[text_column])
    met = cut(slim.mapInArrow(meet, f"text_key long, doc {kind}, words array<long>, hashes array<long>, places array<long>"))
    # equal texts (or keys) are looked up once
    places = met.select("text_key", F.inline(F.arrays_zip(F.col("hashes").alias("print"), F.col("places").alias("at")))).distinct()
    hits = places.join(prints.select("item_key", F.inline("prints")), "print").select("text_key", "item_key", (F.col("at") - F.col("place")).alias("shift")).distinct()
    diagonals = hits.groupBy("text_key", "item_key").agg(F.collect_list("shift").alias("shifts"))  # at most the words of one text and one passage
    pairs = diagonals.join(met.select("text_key", "doc", "words"), "text_key").join(prints.select("item_key", "item", "passage"), "item_key").select("doc", "item", "words", "passage", "shifts")

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [leaks(*x) for x in zip(*(_lists(b.column(k)) for k in (2, 3, 4)))]
            out = b.filter(pa.array(kept, pa.bool_()))
            yield pa.RecordBatch.from_arrays(out.columns[:2], names=[id_column, item_column])

    return pairs.mapInArrow(extend, f"{id_column} {kind}, {item_column} {dict(items.dtypes)[item_column]}").dropDuplicates([id_column, item_column])
