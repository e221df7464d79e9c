"""Problem 3: the language of every document and of every segment of a mixed one, with a confidence.

Rank-order profiles: a language's most frequent n-grams (letter trigrams with word edges; for words of Han, kana and
Hangul single characters and pairs) are ranked, a segment's own n-grams likewise, and the language of least out-of-place
distance is taken; the confidence is the share by which the second-best is farther. Profiles are trained on a bounded
sample of labelled documents (``SAMPLE_DOCS`` per label), then once more on the sample's segments that agree with their
label, so that wrong labels and mixed documents do not blur them.

Segments are the paragraphs of the text (after encoding repair) and of each page's body. Quotations inside a paragraph
are set aside, as are headings, captions, page numbers, asset references and lines that the source repeats.

Defined results: null, empty and too short texts have no segment, nor have paragraphs whose characters are mostly lost; a document without any segment has no language; und,
null and empty labels name no language; pages without a document are ignored; repeated rows do not count twice; ties go
to the alphabetically first language.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm import boilerplate, mojibake
from quirefold.llm.sampling import labelled_sample
from quirefold.session import cut

#: Two-letter label of documents -> three-letter code.
CODES = {"ko": "kor", "en": "eng", "ja": "jpn", "de": "deu", "fr": "fra", "es": "spa"}
#: Bound of the training sample and size of a profile.
SAMPLE_DOCS, SAMPLE_CHARS, PROFILE = 250, 4000, 300
#: Letters that make a segment; characters that make one of a single line of a page that ends no sentence. CJK letters count double.
LETTERS, LINE_LETTERS = 30, 110
#: A segment of less confidence than this (half of it for longer ones) tells only where a document has no other.
SURE, SURE_LETTERS = 0.1, 80
#: Rows classified at once.
CHUNK = 256
#: Words, and words with the marks about them, kept per Python worker with their n-grams; beyond it the memo starts anew, which costs time only.
MEMO = 300_000
#: Characters of a stretch without blanks from which it is not kept as a whole, but word by word.
LONG_STRETCH = 24

_WORD = re.compile(r"[^\W\d_]+")
_CJK = re.compile(r"[぀-ヿ一-鿿가-힯]")
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
#: What ends a sentence; and Latin-1 and typographic characters, of which written texts have few.
_ENDS = tuple(".!?。！？…”\"»」』)")
_SENTENCE = re.compile(r"[.!?…。！？][\"'”»」』)]*$")
_GARBLED = re.compile("[\u0080-\u00ff\u0152-\u0192\u02c6\u02dc\u2013-\u203a\u20ac\u2122]")
_QUOTE = re.compile(r"“[^”]{12,}”|„[^“”]{12,}[“”]|«[^»]{12,}»|「[^」]{6,}」|『[^』]{6,}』|\"[^\"\n]{24,}\"")
#: Headings, captions, numbers, asset references, contents lines. Fixed values.
_ASIDE = re.compile(
    r"\W*(?:\d+(?:\.\d+)+\.?\s+\S.*|\d{1,2}\s{1,4}\S.*|.*(?:\s{2,}|\.{3,}\s*)\d{1,4}|(?:figure|fig|table|abbildung|abb|tabelle|tab|tableau|figura|tabla|그림|표|図|表)\.?\s*\d+.*|\[(?:TABLE|FIGURE)_\d+\]\W*|[\W\d]*)", re.I
)


def ngrams(word: str) -> list[str]:
    """The n-grams of one lower-case word."""
    if _CJK.search(word):
        return [*word, *(word[i : i + 2] for i in range(len(word) - 1))]
    w = f"_{word}_"
    return [w[i : i + 3] for i in range(len(w) - 2)] if len(w) > 2 else []


class _Known(dict):
    """Stretch of a text without blanks -> the numbers of its words' n-grams, those of the profiles, as the bytes of an array."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers

    def __missing__(self, stretch: str) -> bytes:
        words = _WORD.findall(stretch)
        if words == [stretch]:
            out = array("H", [n for g in ngrams(stretch) if (n := self.numbers.get(g)) is not None]).tobytes()
        else:
            out = b"".join([self[w] for w in words])
            if len(stretch) > LONG_STRETCH:
                return out
        if len(self) >= MEMO:
            self.clear()
        self[stretch] = out
        return out

    def __reduce__(self) -> tuple:
        return _Known, (self.numbers,)


class Profiles:
    """Rank-order profiles of languages, and the classification of segments by out-of-place distance."""

    def __init__(self, ranked: dict[str, list[str]]):
        self.languages = sorted(ranked)
        self.numbers = {g: k for k, g in enumerate(sorted({g for r in ranked.values() for g in r}))}
        self.ranks = np.full((len(self.languages), len(self.numbers) + 1), PROFILE, np.int32)
        for k, language in enumerate(self.languages):
            for rank, gram in enumerate(ranked[language]):
                self.ranks[k, self.numbers[gram]] = rank
        self.known = _Known(self.numbers)

    @classmethod
    def train(cls, samples: dict[str, list[str]]) -> Profiles:
        """Profiles of label -> texts, trained twice: the second time on the segments that agree with their label."""
        segments = {code: [s for t in texts for s in paragraphs(t)] for code, texts in samples.items()}
        first = cls({code: cls._ranked(s) for code, s in segments.items() if s})
        if len(first.languages) < 2:
            return first
        agreed = {code: [s for s, (c, _) in zip(segs, first.classify(segs)) if c == code] for code, segs in segments.items()}
        return cls({code: cls._ranked(agreed[code] or segments[code]) for code in first.languages})

    @staticmethod
    def _ranked(segments: list[str]) -> list[str]:
        words = Counter(w for s in segments for w in _WORD.findall(s.lower()))
        grams: Counter[str] = Counter()
        for w, n in words.items():
            for g in ngrams(w):
                grams[g] += n
        return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], x[0]))[:PROFILE]]

    def classify(self, segments: list[str]) -> list[tuple[str | None, float]]:
        """(language, confidence) of each segment; None where it has no known n-gram."""
        if not self.languages:
            return [(None, 0.0)] * len(segments)
        known = self.known.__getitem__
        each = [b"".join(map(known, s.lower().split())) for s in segments]
        flat = np.frombuffer(b"".join(each), np.uint16)
        if not len(flat):
            return [(None, 0.0)] * len(segments)
        width = len(self.numbers)
        keys, counts = np.unique(np.repeat(np.arange(len(segments), dtype=np.int64) * width, [len(x) // 2 for x in each]) + flat, return_counts=True)
        # by segment, most frequent first, then by n-gram: one number each
        most = int(counts.max())
        keys = np.sort((keys // width * (most + 1) + most - counts) * width + keys % width)
        owner, gram = keys // (width * (most + 1)), keys % width
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        own_rank = (np.arange(len(owner)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(owner)]))))).astype(np.int32)
        distance = np.stack([np.add.reduceat(np.minimum(np.abs(r[gram] - own_rank), PROFILE), starts, dtype=np.int64) for r in self.ranks])
        best = distance.argmin(axis=0)
        two = np.sort(distance, axis=0)[:2] if len(self.languages) > 1 else np.stack((distance[0], distance[0] * 2 + 1))
        out: list[tuple[str | None, float]] = [(None, 0.0)] * len(segments)
        for at, b, near, far in zip(owner[starts].tolist(), best.tolist(), *two.tolist()):
            out[at] = (self.languages[b], 1 - near / far if far else 0.0)
        return out


def weight(text: str) -> int:
    """Letters of a text, CJK ones twice."""
    return sum(map(len, _WORD.findall(text))) + len(_CJK.findall(text))


def _enough(text: str) -> bool:
    """Whether a text has letters enough for a segment; long ones are not counted."""
    return len(text) >= LETTERS * 4 and not text[: LETTERS * 4].isspace() or weight(text) >= LETTERS


def _unquoted(text: str) -> str:
    bare = _QUOTE.sub(" ", text)
    return bare if len(bare) == len(text) or weight(bare) >= LETTERS else text


def paragraphs(text: str) -> list[str]:
    """The segments of a text: paragraphs of enough letters, without quotations and headings; else the text as a whole."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    out = []
    for p in _BLANK.split(text):
        bare = p.strip()
        title = len(bare) < LINE_LETTERS and "\n" not in bare and (bare[-1:] not in _ENDS or _ASIDE.fullmatch(bare) is not None)
        if not title and len(p) >= LETTERS // 2 and _enough(p):
            out.append(_unquoted(p))
    return out if out or not text.strip() else [text]


def legible(segment: str) -> bool:
    """Whether a segment is not mostly lost or garbled characters."""
    return segment.count("\ufffd") * 20 <= len(segment) and len(_GARBLED.findall(segment)) * 4 <= len(segment)


def page_paragraphs(body: str, repeated: set[int]) -> list[tuple[str, str | None]]:
    """The segments of a page's body: paragraphs of two lines or more, of one long line, or of one line that ends a sentence.

    Lines whose numbers are in ``repeated`` are left out. With each segment that is one shorter line goes that line.
    """
    out: list[tuple[str, str | None]] = []
    block: list[str] = []

    def close() -> None:
        joined = " ".join(block)
        long = len(joined) >= LINE_LETTERS // 2 and len(joined) + len(_CJK.findall(joined)) >= LINE_LETTERS
        if long or (len(block) > 1 or _SENTENCE.search(joined)) and _enough(joined):
            out.append((_unquoted(joined), joined if len(block) == 1 and not long else None))
        block.clear()

    for k, line in enumerate(body.split("\n")):
        bare = line.strip()
        if not bare:
            if block:
                close()
        elif k not in repeated and (len(bare) >= LINE_LETTERS or not _ASIDE.fullmatch(bare)):
            block.append(bare)
    if block:
        close()
    return out


def train(documents: DataFrame) -> Profiles:
    """Profiles from a bounded sample of the labelled documents."""
    samples = labelled_sample(documents, tuple(CODES), SAMPLE_DOCS, SAMPLE_CHARS, F.length("text") >= 100)
    return Profiles.train({CODES[label]: texts for label, texts in samples.items()})


def segments(documents: DataFrame, pages: DataFrame, profiles: Profiles, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, field_name, page_id, segment_no, lang, confidence, letters) of every segment; letters are its characters."""
    schema = "doc_id long, field_name string, page_id long, segment_no int, lang string, confidence double, letters int, line string"
    kinds = pa.schema([("doc_id", pa.int64()), ("field_name", pa.string()), ("page_id", pa.int64()), ("segment_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("letters", pa.int32()), ("line", pa.string())])

    def emit(found: list[tuple[int, str, int | None, list[tuple[str, str | None]]]]) -> pa.RecordBatch:
        flat = [(d, f, p, k, s, line) for d, f, p, parts in found for k, (s, line) in enumerate(parts)]
        rows = [(d, f, p, k, lang, conf, len(s), line) for (d, f, p, k, s, line), (lang, conf) in zip(flat, profiles.classify([x[4] for x in flat])) if lang is not None]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)] if rows else [pa.array([], t) for t in kinds.types], schema=kinds)

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = mojibake.Repairer(dictionaries)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                b = batch.slice(at, CHUNK)
                yield emit([(d, "text", None, [(s, None) for s in paragraphs(repairer.text(t)[0]) if legible(s)]) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())])

    body_pages = pages.filter(F.col("document_id").isNotNull() & (F.col("body_text") != "")).select(F.col("document_id").alias("doc_id"), F.col("id").alias("page_id"), "body_text")
    # the lines that the page's own source repeats, by number
    lines = cut(boilerplate.hashed_lines(pages))  # hashed once, read twice
    shared = cut(boilerplate.shared_lines(lines, documents, boilerplate.MIN_DOCUMENTS))
    repeated = boilerplate.same_lines(lines.filter("field_name = 'body_text'"), documents, shared).groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))  # lines of one page
    marked = body_pages.join(repeated, "page_id", "left")

    def bodies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = zip(*(batch.slice(at, CHUNK).column(i).to_pylist() for i in range(4)))
                yield emit([(d, "body_text", p, page_paragraphs(t, set(gone or ()))) for d, p, t, gone in rows])

    from_pages = cut(marked.select("doc_id", "page_id", "body_text", "gone").mapInArrow(bodies, schema))
    # a segment of one line is none if the line is, but for misread letters, one that the source repeats
    single = from_pages.filter("line IS NOT NULL").select("page_id", "segment_no", F.col("doc_id").alias("document_id"), boilerplate.letters(F.col("line")).alias("key")).join(boilerplate.owners(documents), "document_id")
    near = boilerplate.near_lines(single, boilerplate.head_keys(pages, shared))
    from_texts = documents.filter(F.col("text").isNotNull() & (F.col("text") != "")).select("doc_id", "text").mapInArrow(texts, schema)
    return from_texts.unionByName(from_pages.join(near, ["page_id", "segment_no"], "left_anti")).drop("line")


def document_languages(documents: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, lang, confidence, letters, segments) per document and language: confidence weighted by letters."""
    return found.groupBy("doc_id", "lang").agg((F.sum(F.col("confidence") * F.col("letters")) / F.greatest(F.sum("letters"), F.lit(1))).alias("confidence"), F.sum("letters").alias("letters"), F.count("*").alias("segments")).join(documents.select("doc_id"), "doc_id", "left_semi")


def mislabelled(documents: DataFrame, pages: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, lang) for every language of each document whose detected_languages does not name exactly its languages."""
    sure = (F.col("confidence") >= SURE) | ((F.col("letters") >= SURE_LETTERS) & (F.col("confidence") >= SURE / 2))
    sets = found.groupBy("doc_id").agg(F.collect_set(F.when(sure, F.col("lang"))).alias("sure"), F.collect_set("lang").alias("any"))  # at most six languages
    real = sets.select("doc_id", F.array_sort(F.when(F.size("sure") > 0, F.col("sure")).otherwise(F.col("any"))).alias("real"))
    named = F.array_sort(F.array_distinct(F.filter(F.regexp_extract_all(F.lower(F.coalesce("detected_languages", F.lit(""))), F.lit("([a-z]{2,3})"), 1), lambda x: x != "und")))
    with_page = pages.filter(F.col("document_id").isNotNull()).select(F.col("document_id").alias("doc_id")).distinct().withColumn("paged", F.lit(True))
    labels = documents.select("doc_id", named.alias("named"), F.length("text").alias("size")).join(with_page, "doc_id", "left")
    cases = labels.filter(F.col("paged").isNotNull() | (F.col("size") >= 60)).join(real, "doc_id").filter(F.col("named") != F.col("real"))
    return cases.select("doc_id", F.explode("real").alias("lang")).distinct()
