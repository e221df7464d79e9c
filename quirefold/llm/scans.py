"""Problem 1: noise in text from scanned pages, found and repaired into continuous paragraphs.

Noisy channel: a read word is what a scanner made of a true word. For every read word that the clean corpus does not
know, the true words from which it follows by one or two of the character confusions below are looked up in the corpus
word counts (a join, so no vocabulary is sent around); the lexicon of words in question and their candidates goes to the
readers. How likely each confusion is, is estimated from the scans: the read words that have one candidate are aligned
with it, and the readings of each kind are counted against the places where they could have been made. A line is decoded
by Viterbi over the candidate words of its tokens: confusion probability times the likelihood of the word after the one
before it, backed off to the single word. Pairs are counted over the whole corpus for contested words only.
Words broken at line ends are joined over running headers, page numbers and repeated blanks between the two lines; their
hyphen stays where the corpus has the hyphenated word more often.

Defined results: null and empty texts hold no noise; a word without a known candidate stays as read; a broken word whose
second half is missing is no case; repeated rows are reported once; pages of documents without a title take the words
of the file name for it; very long lines are read whole. If the lexicon has more than ``LEXICON`` rows, or its contested words
more than ``PAIRS`` pairs, they are not sent around: each text is joined with the rows and the pair counts that its
reading looks up, which gives equal results. Every pair of the clean texts counts, one seen once too.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.session import cut

#: (what a scanner reads, what was printed). Fixed values; their probabilities are estimated.
CONFUSIONS = [
    ("c", "e"), ("l", "i"), ("1", "l"), ("1", "i"), ("f", "t"), ("5", "s"), ("0", "o"), ("ii", "u"), ("cl", "d"),
    ("rn", "m"), ("b", "h"), ("vv", "w"), ("6", "b"), ("9", "g"), ("6", "é"), ("름", "를"), ("올", "을"),
]
#: Probability of a confusion before any scan is seen, the readings that this weighs as, and the bounds of an estimate as
#: multiples of it. Only how the confusions compare is estimated: their mean stays.
PRIOR, WEIGHT, BOUNDS = 0.01, 50.0, (0.2, 5.0)
#: Weight of a single word's count against that of a pair.
BACK_OFF = 0.01
#: Places of a word that can be misread, up to which its readings are listed; those of words with more are found among the known words.
PLACES = 64
#: Letters read for digits within numbers. Fixed values.
DIGITS = {"O": "0", "o": "0", "l": "1", "I": "1", "S": "5"}
#: Occurrences in clean texts from which a word is known; times a candidate must be more frequent than a read word.
KNOWN, TIMES = 2, 10
#: Rows of the lexicon up to which it is sent to the readers; a longer one is joined with the texts.
LEXICON = 200_000
#: Word pairs up to which they are sent to the readers; more are joined with the texts like the lexicon.
PAIRS = 200_000
#: Distinct words counted in memory before they are passed on.
HELD = 500_000

WORD = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")
_NUMBER = re.compile(r"(?<![\w.,])(?=[OolIS.,]*\d)(?=[\d.,]*[OolIS])[\dOolIS]+(?:[.,][\dOolIS]+)*(?![\w])")
_MIXED = re.compile(r"\d[.,]?[OolIS]|[OolIS][.,]?\d")
_ENDS = tuple("-\u00ad\u00ac\u2010")
_BROKEN = re.compile(r"([^\W_]+(?:[-'’][^\W_]+)*)[-­¬‐]\s*$")
_FIRST = re.compile(r"^\W*?([^\W_]+(?:[-'’][^\W_]+)*)")
#: Lines with nothing but a page number. Fixed values.
PAGE_NUMBER = re.compile(r"[\s\W_]*+(?:p|pg|page|seite|s|pág|página|쪽|페이지|ページ)?[\s.:]*+[-–—\[(]?\s*+\d{1,4}(?!\d)\s*+[-–—\])]?\s*+(?:(?:/|of|von|de|sur|중)\s*+\d{1,4}(?!\d))?\s*+(?:쪽|페이지|ページ|頁)?[\s\W_]*+", re.I)
_NUMBERED = re.compile(r"\d+(?:\.\d+)+\.?\s")  # a section heading
_DIGIT = re.compile(r"\d")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_PAIRS = [(read, printed) for read, printed in CONFUSIONS if len(read) > len(printed)]
#: Letters that a scanner confuses -> one of them. Fixed values.
_ALIKE = str.maketrans({"1": "i", "l": "i", "c": "e", "f": "t", "5": "s", "0": "o", "b": "h", "6": "h", "9": "g", "é": "e", "올": "을", "름": "를"})


def tokens(text: str) -> list[str]:
    """The words of a text in lower case, without the punctuation around them."""
    return WORD.findall(text.lower())


def is_page_number(line: str) -> bool:
    return _DIGIT.search(line) is not None and PAGE_NUMBER.fullmatch(line) is not None


def is_running_header(line: str, title: str | None, slug: str | None) -> bool:
    """Whether a line repeats the document's title, whole or shortened, perhaps with a page number and misread letters."""
    bare = re.sub(r"^\s*\d{1,4}\s{2,}|\s{2,}\d{1,4}\s*$", "", line).strip()
    if len(bare) < 6 or _NUMBERED.match(bare):
        return False
    shortened = re.search(r"\s*(?:\.{2,}|…)\s*$", bare) is not None
    letters = _shape(bare)
    if title:
        whole = _shape(title)
        if letters == whole:
            return True
        enough = len(letters) >= max(6, len(whole) * 0.25) and (shortened or len(bare.split()) >= 3 and len(letters) >= len(whole) * 0.4)
        return enough and whole.startswith(letters)
    if slug and len(slug) >= 8:
        if shortened:
            return letters.startswith(slug) or len(letters) >= 8 and slug.startswith(letters)
        return letters.startswith(slug) and len(letters) <= len(slug) * 3 + 12 and not bare.endswith((".", "-", "?", "!", ",", ";"))
    return False


def _shape(text: str) -> str:
    """The letters of a text as a scanner may read them: confused ones are written alike."""
    t = text.casefold()
    for read, printed in _PAIRS:
        t = t.replace(read, printed)
    return _NOT_LETTERS.sub("", t.translate(_ALIKE))


def _may_begin(title: str | None, slug: str | None) -> frozenset[str]:
    """The first letters that a line may have which repeats a title, misread ones included."""
    first = next((c for c in (title or slug or "").casefold() if c.isalpha()), "")
    return frozenset({first} | {read[0] for read, printed in CONFUSIONS if printed == first} | {printed for read, printed in CONFUSIONS if read[0] == first}) if first else frozenset()


def slug_of(file_name: str | None) -> str | None:
    """The letters of a file name without its extension, as a scanner may read them."""
    if not file_name:
        return None
    return _shape(re.sub(r"\.[A-Za-z]{2,5}$", "", file_name)) or None


class Page:
    """The lines of a text, with what stands between the lines of its paragraphs."""

    def __init__(self, text: str, title: str | None = None, slug: str | None = None, page: bool = True):
        self.lines = text.split("\n")
        self.kind = [""] * len(self.lines)
        begins = _may_begin(title, slug)
        for k, line in enumerate(self.lines) if page else ():
            if is_page_number(line):
                self.kind[k] = "page_number"
            elif begins:
                first = line[:1].casefold()
                if not first.isalpha():
                    first = next((c for c in line.casefold() if c.isalpha()), "")
                if first[:1] in begins and is_running_header(line, title, slug):
                    self.kind[k] = "running_header"
        # (line, first half, second half, line of the second half)
        self.breaks: list[tuple[int, str, str, int]] = []
        for k, line in enumerate(self.lines[:-1]):
            if self.kind[k] or line[-1:] not in _ENDS and line[-2:-1] not in _ENDS and line.rstrip()[-1:] not in _ENDS or not (m := _BROKEN.search(line)):
                continue
            n = next((j for j in range(k + 1, len(self.lines)) if not self.kind[j]), None)
            if n is not None and self.lines[n].strip() and (f := _FIRST.search(self.lines[n])):
                self.breaks.append((k, m[1], f[1], n))

    def words(self) -> Iterator[tuple[int, list[str]]]:
        """The whole words of each line of the text; halves of broken words are left out."""
        last, first = {b[0] for b in self.breaks}, {b[3] for b in self.breaks}
        for k, line in enumerate(self.lines):
            if self.kind[k] != "page_number":
                if _MIXED.search(line):  # numbers of several parts are no words
                    line = _NUMBER.sub(lambda m: " " if "." in m[0] or "," in m[0] else m[0], line)
                found = tokens(line)
                yield k, found[(k in first) : len(found) - (k in last)]


def readings(word: str) -> list[tuple[str, int, int]]:
    """(printed word, confusion, second confusion or -1): every word that may have been printed, by one confusion or two."""
    out: dict[str, tuple[int, int]] = {}
    level: dict[str, int] = {word: -1}
    for step in range(2):
        new: dict[str, int] = {}
        for w, before in level.items():
            for number, (read, printed) in enumerate(CONFUSIONS):
                at = w.find(read)
                while at >= 0:
                    x = w[:at] + printed + w[at + len(read) :]
                    if x != word and x not in out and x not in new:
                        new[x] = number
                        out[x] = (before, number) if step else (number, -1)
                    at = w.find(read, at + 1)
        level = new if len(new) <= PLACES else {}
    return [(x, *numbers) for x, numbers in out.items()]


def _step(word: str, printed: str) -> int:
    """The first confusion by which ``printed`` was read as ``word``, -1 if it was none."""
    same = next((k for k, (a, b) in enumerate(zip(word, printed)) if a != b), min(len(word), len(printed)))
    for number, (read, right) in enumerate(CONFUSIONS):
        if len(right) - len(read) == len(printed) - len(word):
            for at in range(max(0, same - max(len(read), len(right))), same + 1):
                if word.startswith(read, at) and printed.startswith(right, at) and word[at + len(read) :] == printed[at + len(right) :]:
                    return number
    return -1


def _undone_once(word: str) -> Iterator[tuple[str, int]]:
    """(printed word, confusion) of one confusion at each place, in the order of ``readings``."""
    for number, (read, printed) in enumerate(CONFUSIONS):
        at = word.find(read)
        while at >= 0:
            yield word[:at] + printed + word[at + len(read) :], number
            at = word.find(read, at + 1)


def is_crowded(word: str) -> bool:
    """Whether a word has more than ``PLACES`` places, so that its readings are not listed but found among the known words."""
    seen: set[str] = set()
    for x, _ in _undone_once(word):
        seen.add(x)
        if len(seen) > PLACES:
            return True
    return False


def reading(word: str, printed: str) -> tuple[int, int] | None:
    """What ``readings`` would give for ``printed``, however many readings the word has."""
    if word == printed:
        return None
    if (number := _step(word, printed)) >= 0:
        return number, -1
    for x, number in _undone_once(word):
        if x != word and (second := _step(x, printed)) >= 0:
            return number, second
    return None


#: The letters of all confusions: what is left of a word without them no misreading changes.
_CONFUSED = "".join(sorted({c for pair in CONFUSIONS for part in pair for c in part}))
#: Letters by which two misreadings change a word's length at most, and the least length of a crowded word.
_SHIFT = 2 * max(abs(len(read) - len(printed)) for read, printed in CONFUSIONS)
_CROWDED = PLACES // max(Counter(read[0] for read, _ in CONFUSIONS).values())


def _crowded_readings(unsure: DataFrame, known: DataFrame, kinds: pa.Schema) -> DataFrame:
    """(word, printed, first, second, own, read, dirty) of the crowded words, whose readings are too many to be listed: each is held against the known words that differ from it in confused letters only."""
    rest = lambda c: F.translate(c, _CONFUSED, "").alias("rest")

    def crowded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([is_crowded(w) for w in b.column(0).to_pylist()], pa.bool_()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(w, printed, *x, own, read, dirty) for w, own, read, dirty, printed in _rows(b) if (x := reading(w, printed))], kinds)

    long = unsure.filter(F.length("word") >= _CROWDED).mapInArrow(crowded, unsure.schema)
    names = known.filter(F.length("printed") >= _CROWDED - _SHIFT).select("printed", rest("printed"))
    met = long.select("*", rest("word")).join(names, "rest").filter(F.abs(F.length("word") - F.length("printed")) <= _SHIFT)
    return met.select("word", "own", "read", "dirty", "printed").mapInArrow(run, "word string, printed string, first int, second int, own long, read long, dirty long")


def _count_words(texts: DataFrame) -> DataFrame:
    """(word, clean, dirty, asked) of ``texts`` (text, clean, scanned): counts per word; asked: forms of broken words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter, set] = (Counter(), Counter(), set())

        def give() -> pa.RecordBatch:
            words = list({**held[0], **held[1], **dict.fromkeys(held[2])})
            out = pa.RecordBatch.from_pydict({"word": words, "clean": [held[0].get(w, 0) for w in words], "dirty": [held[1].get(w, 0) for w in words], "asked": [w in held[2] for w in words]}, schema=schema)
            for h in held:
                h.clear()
            return out

        schema = pa.schema([("word", pa.string()), ("clean", pa.int64()), ("dirty", pa.int64()), ("asked", pa.bool_())])
        for b in batches:
            for text, clean, scanned in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if not scanned:
                    held[not clean].update(tokens(text))
                    continue
                page = Page(text, page=True)
                for _, words in page.words():
                    held[1].update(words)
                for _, one, two, _ in page.breaks:
                    one, two = one.lower(), two.lower()
                    held[2].update((one + two, f"{one}-{two}"))
            if len(held[0]) + len(held[1]) > HELD:
                yield give()
        yield give()

    counted = texts.select("text", "clean", "scanned").mapInArrow(run, "word string, clean long, dirty long, asked boolean")
    return counted.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("dirty").alias("dirty"), F.max("asked").alias("asked"))


def confusion_rates(counts: DataFrame, likely: DataFrame) -> list[float]:
    """The probability of each confusion: readings of words with one candidate by one confusion, over the places where it could have been made."""
    places = [F.sum(F.col("dirty") * (F.length("word") - F.length(F.replace("word", F.lit(printed), F.lit("")))) / len(printed)) for _, printed in CONFUSIONS]
    could = counts.agg(*[F.coalesce(p, F.lit(0.0)).alias(f"c{k}") for k, p in enumerate(places)]).first()
    alone = likely.groupBy("word").agg(F.count("*").alias("several"), F.max("first").alias("first"), F.max("second").alias("second"), F.max("dirty").alias("dirty"))
    made = {r["first"]: r["made"] for r in alone.filter("several = 1 AND second < 0").groupBy("first").agg(F.sum("dirty").alias("made")).collect()}  # one row per confusion
    rates = [(made.get(k, 0) + WEIGHT * PRIOR) / (could[k] + WEIGHT) for k in range(len(CONFUSIONS))]
    mean = sum(rates) / len(rates)
    return [PRIOR * min(max(r / mean, BOUNDS[0]), BOUNDS[1]) for r in rates]


def lexicon(texts: DataFrame) -> DataFrame:
    """(word, printed, chance, n, own, keep): the words in question with what may have been printed and its corpus count.

    ``keep`` marks hyphenated forms of broken words that the corpus has more often than the joined form.
    """
    counts = cut(_count_words(texts))
    unsure = counts.filter((F.col("clean") < KNOWN) & F.col("word").rlike("[cl1f50b69름올]|ii|rn|vv") & ((F.col("dirty") > 0) | F.col("asked")) & F.col("word").rlike(r"[\p{L}]") & (F.length("word") >= 2))
    kinds = pa.schema([("word", pa.string()), ("printed", pa.string()), ("first", pa.int32()), ("second", pa.int32()), ("own", pa.int64()), ("read", pa.int64()), ("dirty", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(w, *x, own, read, dirty) for w, own, read, dirty in _rows(b) if not is_crowded(w) for x in readings(w)], kinds)

    # own: the read word's count in clean texts; read: its count everywhere
    asking = unsure.select("word", F.col("clean").alias("own"), (F.col("clean") + F.col("dirty")).alias("read"), "dirty")
    possible = asking.mapInArrow(run, "word string, printed string, first int, second int, own long, read long, dirty long")
    known = counts.filter((F.col("clean") + F.col("dirty")) >= KNOWN).select(F.col("word").alias("printed"), "clean", (F.col("clean") + F.col("dirty")).alias("n"))
    possible = possible.unionByName(_crowded_readings(asking, known, kinds))
    likely = cut(
        possible.join(known, "printed")
        .filter(((F.col("clean") >= KNOWN) & (F.col("n") >= F.col("read"))) | (F.col("n") >= TIMES * F.greatest("read", F.lit(1))))
        .select("word", "printed", "first", "second", "n", "own", "dirty")
    )
    rates = F.array(*[F.lit(r) for r in confusion_rates(counts, likely)])
    chance = F.get(rates, F.col("first")) * F.when(F.col("second") < 0, 1.0).otherwise(F.get(rates, F.greatest("second", F.lit(0))))
    likely = likely.select("word", "printed", chance.alias("chance"), "n", "own", F.lit(False).alias("keep"))
    joined = counts.filter("asked and word like '%-%'").select("word", (F.col("clean") + F.col("dirty")).alias("n"), F.reverse(F.regexp_replace(F.reverse("word"), "^([^-]*)-", "$1")).alias("plain"))
    hyphens = counts.select(F.col("word").alias("plain"), (F.col("clean") + F.col("dirty")).alias("m"))
    kept = (
        joined.filter("n > 0").join(hyphens, "plain", "left").filter(F.col("n") > F.coalesce("m", F.lit(0)))
        .select("word", F.col("word").alias("printed"), F.lit(1.0).alias("chance"), "n", F.lit(0).cast("long").alias("own"), F.lit(True).alias("keep"))
    )
    return likely.unionByName(kept)


class Reader:
    """Decodes texts with a lexicon (word -> candidates) and counts of word pairs for contested words."""

    def __init__(self, rows: list[tuple], pairs: dict[tuple[str, str], int] | None = None):
        self.candidates: dict[str, list[tuple[str, float, int]]] = defaultdict(list)
        self.own: dict[str, int] = {}
        self.keep: set[str] = set()
        for word, printed, chance, n, own, keep in rows:
            if keep:
                self.keep.add(word)
            else:
                self.candidates[word].append((printed, chance, n))
                self.own[word] = own
        for options in self.candidates.values():
            options.sort()
        self.pairs = {} if pairs is None else pairs

    def contested(self) -> set[str]:
        """The printed words of the words that have several candidates."""
        return {c[0] for cs in self.candidates.values() if len(cs) > 1 for c in cs}

    def decode(self, words: list[str]) -> list[str]:
        """Viterbi over the candidate words of a line."""
        if self.candidates.keys().isdisjoint(words):
            return words
        paths: dict[str, tuple[float, tuple[str, ...]]] = {"": (0.0, ())}
        for w in words:
            options = [(c, math.log(p), n) for c, p, n in self.candidates.get(w, ())]
            options.append((w, math.log(0.5) if options else 0.0, self.own.get(w, 0)))
            new: dict[str, tuple[float, tuple[str, ...]]] = {}
            for c, channel, n in options:
                for last, (cost, path) in paths.items():
                    pair = self.pairs.get((last, c), 0)
                    score = cost + channel + (math.log(pair + BACK_OFF * (n + 0.001)) if len(options) > 1 else 0.0)
                    if c not in new or score > new[c][0]:
                        new[c] = (score, (*path, c))
            paths = new
        return list(max(paths.values())[1])

    def whole(self, one: str, two: str) -> str:
        """A broken word as it must read, in lower case."""
        one, two = one.lower(), two.lower()
        hyphenated = f"{one}-{two}"
        if hyphenated in self.keep:
            return hyphenated
        return self.decode([one + two])[0]

    def noise(self, page: Page) -> list[tuple[str, str]]:
        """(noise, item) of a text, each once."""
        out = {(kind, str(k)): None for k, kind in enumerate(page.kind) if kind}
        for _, one, two, _ in page.breaks:
            out["hyphenation", self.whole(one, two)] = None
        for k, words in page.words():
            if not self.candidates.keys().isdisjoint(words):
                for read, printed in zip(words, self.decode(words)):
                    if read != printed:
                        out["misread", printed] = None
            if _MIXED.search(page.lines[k]):
                for m in _NUMBER.finditer(page.lines[k]):
                    if m[0].lower() not in self.candidates:
                        out["misread", "".join(DIGITS.get(c, c) for c in m[0])] = None
        return list(out)

    def repair(self, page: Page) -> str:
        """The text as continuous paragraphs: no running headers and page numbers, broken words joined, misread words put right."""
        lines = list(page.lines)
        for k, one, two, n in reversed(page.breaks):
            head, tail = _BROKEN.search(lines[k]), _FIRST.search(lines[n])
            if head is None or tail is None:
                continue
            right = self.whole(one, two)
            if right.replace("-", "") == (one + two).lower().replace("-", ""):
                right = one + ("-" if right.count("-") > (one + two).count("-") else "") + two
            lines[k] = lines[k][: head.start()] + right + lines[n][tail.end() :]
            lines[n] = ""
        out, paragraph = [], []
        for k, line in enumerate(lines):
            if page.kind[k] or line == "":
                continue
            if not line.strip():
                out.append(" ".join(paragraph))
                paragraph = []
                continue
            found = list(WORD.finditer(line))
            read = [m[0].lower() for m in found]
            for m, a, b in reversed(list(zip(found, read, self.decode(read)))):
                if a != b:
                    line = line[: m.start()] + (b.capitalize() if m[0][:1].isupper() else b) + line[m.end() :]
            line = _NUMBER.sub(lambda m: "".join(DIGITS.get(c, c) for c in m[0]), line)
            paragraph.append(line.strip())
        return "\n\n".join(p for p in [*out, " ".join(paragraph)] if p)


def scanned_texts(pages: DataFrame, assets: DataFrame, documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """(table_name, row_id, text, title, file_name) of every body_text and ocr_text; titles only where there is one."""
    titles = metadata.filter(F.col("title").isNotNull() & (F.trim("title") != "")).groupBy("document_id").agg(F.min("title").alias("title"))
    named = documents.select(F.col("doc_id").alias("document_id"), "file_name").join(titles, "document_id", "left")
    bodies = pages.filter(F.col("body_text").isNotNull() & (F.col("body_text") != "")).select("document_id", F.lit("page_contents").alias("table_name"), F.col("id").alias("row_id"), F.col("body_text").alias("text"))
    ocr = assets.filter(F.col("ocr_text").isNotNull() & (F.col("ocr_text") != "")).select(F.lit("document_assets").alias("table_name"), F.col("id").alias("row_id"), F.col("ocr_text").alias("text"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("file_name"))
    return bodies.join(named, "document_id", "left").select("table_name", "row_id", "text", "title", "file_name").unionByName(ocr)


def corpus_texts(pages: DataFrame, assets: DataFrame, documents: DataFrame) -> DataFrame:
    """(text, clean, scanned) of all texts whose words are counted; documents' own texts are the clean ones."""
    part = lambda df, c, clean, scanned: df.filter(F.col(c).isNotNull() & (F.col(c) != "")).select(F.col(c).alias("text"), F.lit(clean).alias("clean"), F.lit(scanned).alias("scanned"))
    parts = [part(documents, "text", True, False), part(pages, "body_text", False, True), part(assets, "ocr_text", False, True), part(pages, "header_text", False, False), part(pages, "footer_text", False, False)]
    return reduce(DataFrame.unionByName, parts)


def pair_counts(texts: DataFrame, words: set[str] | None = None) -> DataFrame:
    """(a, b, n): the word pairs of the clean texts and their counts; with ``words`` those in which one of them stands second."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: Counter = Counter()
            for text in b.column(0).to_pylist():
                found = tokens(text)
                held.update((a, c) for a, c in zip(found, found[1:]) if words is None or c in words)
            rows = list(held.items())
            yield pa.RecordBatch.from_pydict({"a": [r[0][0] for r in rows], "b": [r[0][1] for r in rows], "n": [r[1] for r in rows]}, schema=pa.schema([("a", pa.string()), ("b", pa.string()), ("n", pa.int64())]))

    return texts.filter("clean").select("text").mapInArrow(run, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _page(table: str, text: str, title: str | None, file_name: str | None) -> Page:
    return Page(text, title, slug_of(file_name) if not title else None, page=table != "document_assets")


def _rows(b: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in b.columns))


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)] if rows else [pa.array([], k) for k in kinds.types], schema=kinds)


def asked(page: Page) -> set[str]:
    """Every word that reading or repairing a text may look up in the lexicon."""
    out = {w for _, words in page.words() for w in words}
    for line in page.lines:
        out.update(tokens(line), (w.lower() for w in WORD.findall(line)), (n.lower() for n in _NUMBER.findall(line)))
    for _, one, two, _ in page.breaks:
        one, two = one.lower(), two.lower()
        out.update((one + two, f"{one}-{two}"), (x for x, *_ in readings(one + two)))
    return out


class _Wanted(dict):
    """Pair counts that are all zero and keep what was asked for; Viterbi asks for the same pairs whatever their counts."""

    def get(self, pair: tuple[str, str], default: int = 0) -> int:
        self[pair] = 0
        return default


def _joined(texts: DataFrame, corpus: DataFrame, rows: DataFrame, work: Callable[[Reader, Page], list[tuple]]) -> DataFrame:
    """``texts`` with key, entries and pairs: the lexicon rows and the pair counts that ``work`` looks up in each text."""
    words, wanted_pairs = pa.schema([("key", pa.int64()), ("word", pa.string())]), pa.schema([("key", pa.int64()), ("a", pa.string()), ("b", pa.string())])
    # texts with equal keys get each other's entries too, which they do not look up
    keyed = texts.select("table_name", "row_id", "text", "title", "file_name", F.xxhash64("table_name", "row_id", "text").alias("key"))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(key, w) for table, _, text, title, file_name, key in _rows(b) for w in asked(_page(table, text, title, file_name))], words)

    def want(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for table, _, text, title, file_name, key, entries in _rows(b):
                if entries:
                    wanted = _Wanted()
                    work(Reader([tuple(e.values()) for e in entries], wanted), _page(table, text, title, file_name))
                    out.extend((key, *pair) for pair in wanted)
            yield _batch(out, wanted_pairs)

    entries = keyed.mapInArrow(ask, "key long, word string").distinct().join(rows, "word").groupBy("key").agg(F.collect_list(F.struct("word", "printed", "chance", "n", "own", "keep")).alias("entries"))  # words of one text
    with_entries = keyed.join(entries, "key", "left").select("table_name", "row_id", "text", "title", "file_name", "key", "entries")
    several = rows.filter("not keep").groupBy("word").count().filter("count > 1")
    contested = rows.filter("not keep").join(several, "word", "left_semi").select(F.col("printed").alias("b")).distinct()
    counted = pair_counts(corpus).join(contested, "b", "left_semi")
    pairs = with_entries.mapInArrow(want, "key long, a string, b string").distinct().join(counted, ["a", "b"]).groupBy("key").agg(F.collect_list(F.struct("a", "b", "n")).alias("pairs"))  # pairs of one text
    return with_entries.join(pairs, "key", "left").select("table_name", "row_id", "text", "title", "file_name", "entries", "pairs")


def _worked(texts: DataFrame, corpus: DataFrame, work: Callable[[Reader, Page], list[tuple]], kinds: pa.Schema, schema: str) -> DataFrame:
    """(table_name, row_id, ...) for each row that ``work`` gives of a text."""
    rows = cut(lexicon(corpus))
    reader: Reader | None = None
    if rows.count() <= LEXICON:  # checked, so that what goes to the readers is bounded
        reader = Reader([tuple(r) for r in rows.select("word", "printed", "chance", "n", "own", "keep").toLocalIterator()])
        contested = reader.contested()
        pairs = pair_counts(corpus, contested).limit(PAIRS + 1).collect() if contested else []
        reader.pairs = {(r["a"], r["b"]): r["n"] for r in pairs}
        if len(pairs) > PAIRS:
            reader = None
    if reader is None:
        texts = _joined(texts, corpus, rows, work)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for table, row, text, title, file_name, *own in _rows(b):
                r = reader or Reader([tuple(e.values()) for e in own[0] or ()], {(p["a"], p["b"]): p["n"] for p in own[1] or ()})
                out.extend((table, row, *x) for x in work(r, _page(table, text, title, file_name)))
            yield _batch(out, kinds)

    return texts.mapInArrow(run, schema)


def found(pages: DataFrame, assets: DataFrame, documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """(table_name, row_id, noise, item) of every piece of noise."""
    kinds = pa.schema([("table_name", pa.string()), ("row_id", pa.int64()), ("noise", pa.string()), ("item", pa.string())])
    schema = "table_name string, row_id long, noise string, item string"
    return _worked(scanned_texts(pages, assets, documents, metadata), corpus_texts(pages, assets, documents), lambda reader, page: reader.noise(page), kinds, schema).dropDuplicates()


def repaired(pages: DataFrame, assets: DataFrame, documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """(table_name, row_id, text): each text as continuous readable paragraphs."""
    kinds = pa.schema([("table_name", pa.string()), ("row_id", pa.int64()), ("text", pa.string())])
    schema = "table_name string, row_id long, text string"
    return _worked(scanned_texts(pages, assets, documents, metadata), corpus_texts(pages, assets, documents), lambda reader, page: [(reader.repair(page),)], kinds, schema)
