"""Problem 10: texts that were decoded with a wrong character encoding, and their repair.

Each line that holds other than ASCII characters, or the escapes of a 7-bit code, is a message whose sender may have
decoded it wrongly. Every chain of the list below is undone (encode as it was wrongly read, decode as it was written), up
to ``DEPTH`` times in a row, the ``BEAM`` results of least loss, then of fewest high characters, being undone further even where they are longer than the line;
each candidate line is compressed with one zstandard dictionary per language, and the candidate with the least
description length is taken: compressed bytes, plus the cost of the chain, plus a penalty for what cannot be decoded.
Otherwise the line stays. UTF-8 read as a single-byte code is undone run by run, so that a single garbled word in a line
is found.

A single-byte text read with another single-byte code keeps its length, so compressed bytes tell little of a single
word. For the chains of ``REREAD`` the description length is that of each high character given its two neighbours, by
the number of texts that have them: if one word of a line saves ``LEAST_BITS``, the chain that saves most
is undone in each word that it does not make longer. A character between blanks tells too little to begin with.

The dictionaries and these counts are made from all texts but those that are plainly garbled. Words are counted per language
where the texts are read; a dictionary of ``DICTIONARY`` bytes is trained on the words of a language, each as often as its
share of ``MODEL_UNITS`` says, so that it does not depend on the order in which texts are read. The neighbours of a high character
are counted over the texts of all labels with at least ``LEAST_TEXT`` characters, but for words that are UTF-8 read as a single-byte code
and characters after a question mark, which mostly stands for a lost one. The decision covers every line of every text.

Defined results: null, empty and ASCII texts without escapes are unchanged; a text with a replacement character (U+FFFD)
is garbled, its lost characters stay; line ends and lines that no chain shortens stay as they are; repeated rows are each
decided.
"""

from __future__ import annotations

import codecs
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.session import cut

#: Bytes of a dictionary, and words (with their repetitions) that it is trained on: the counts of all texts are scaled down to these.
DICTIONARY, MODEL_UNITS = 32_768, 150_000
#: Characters of a text from which its characters' neighbours count: what a shorter one holds may be its garbled line alone.
LEAST_TEXT = 100
#: Words of a Python worker from which its counts are passed on; words of more characters are counted in pieces.
COUNTED, LONG_WORD = 200_000, 16
LANGUAGES = ("ko", "en", "ja", "de", "fr", "es")
#: Description length of one step of a chain, and of one lost character, in bytes.
STEP_COST, LOSS_COST = 1.0, 4.0
#: Steps undone in a row at most, and the results of a step that are undone further.
DEPTH, BEAM = 3, 2
#: Wrongly read as -> written in, for codes with one byte a character; these are undone run by run.
SINGLE = ("windows", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "koi8_r", "iso8859_15", "cp866")
_EAST = ("cp949", "cp932", "euc_jp", "gb18030", "big5")
#: (wrongly read as, written in) undone over whole stretches of a line.
WIDE = (*(("windows", c) for c in _EAST), *(("mac_roman", c) for c in _EAST), *((c, "utf-8") for c in _EAST), *((a, b) for a in _EAST for b in _EAST if a != b))
_TO_WIDE = tuple(tuple(c for c in WIDE if c[0] == code) for code in ("windows", "mac_roman"))
_FROM_WIDE = tuple(c for c in WIDE if c[0] in _EAST and c[1] == "utf-8")
_BETWEEN_WIDE = tuple(c for c in WIDE if c[0] in _EAST)
#: Codes of 7 bits, read as ASCII: what a piece of them looks like, also where the escape characters were lost.
SEVEN = (
    ("iso2022_jp", re.compile(r"\x1b\$[@B][!-~]+\x1b\([BJ]")), ("iso2022_jp", re.compile(r"(?<!\x1b)\$[@B](?:[!-~]{2})+\([BJ]")),
    ("iso2022_kr", re.compile(r"\x0e[!-~]+\x0f")), ("hz", re.compile(r"~\{[!-~]+~\}")), ("utf-7", re.compile(r"\+[A-Za-z0-9/]{3,}-?")),
)
#: Texts that are read at all: others hold nothing but ASCII characters.
READ = r"[^\x00-\x7F]|[\x0E\x1B]|\$[@B][!-~]+\([BJ]|~\{|\+[A-Za-z0-9/]{3}"
#: (wrongly read as, written in) of single-byte texts read with another single-byte code; undone word by word.
REREAD = tuple((read_as, written) for read_as in SINGLE for written in SINGLE[:4] if read_as != written)
#: High characters from which a line whose wide ones are all in the dictionaries is not taken for a wide code misread.
KNOWN_LINE = 8
#: Bits that undoing such a chain must save in one word of a line.
LEAST_BITS = 3.0
#: Words kept per Python worker with what can be undone in them; beyond it they are made anew, which costs time only.
MEMO = 200_000

_UTF8 = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+")
_READ = re.compile(READ)
_LINE = re.compile(r"[^\n]+")
#: Characters that any text may hold: Latin-1, general punctuation, Greek, mathematics, Han, kana, Hangul.
_USUAL = re.compile("[\x00-\u00ff\u0370-\u03ff\u2010-\u203a\u2070-\u22ff\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3\U0001f300-\U0001faff]")
_BETWEEN = re.compile(r"([^\x00-\x7f\ufffd]+)")
_WORDS = re.compile(r"[^ \t\r]+")
_EAST_CHAR = re.compile("[\u2e80-\U0010ffff]")
#: Of these an ASCII text that ``_READ`` finds has one.
_MARK = re.compile(r"[\x0E\x1B$~+]")
#: Texts that no model is made from: lost characters, C1 controls, UTF-8 read as windows-1252.
_GARBLED = re.compile("[\ufffd\x80-\x9f]|[ÃÂ][\xa0-\xbf]|â€")
#: Pieces of a long word: Han characters with what follows them up to the next ones.
_PIECE = re.compile(r"[\u4e00-\u9fff々]+[^\s\u4e00-\u9fff々]{0,16}\s*|[^\s\u4e00-\u9fff々]{1,16}\s*|\s+")


@lru_cache(maxsize=16)
def _table(code: str) -> dict[int, int]:
    """Character -> byte of a single-byte code; ``windows`` is windows-1252 with the C1 controls where it has no character."""
    out = {}
    for byte in range(256):
        raw = bytes((byte,))
        try:
            char = raw.decode("cp1252" if code == "windows" else code)
        except UnicodeDecodeError:
            char = chr(byte)
        out[ord(char)] = byte
    if code == "windows":
        for byte in range(0x80, 0xA0):
            out.setdefault(byte, byte)
    return out


@lru_cache(maxsize=16)
def _class(code: str, least: int, high: bool = True) -> re.Pattern:
    """Runs of at least ``least`` characters of a single-byte code: of its high bytes, or of all."""
    chars = "".join(re.escape(chr(c)) for c, b in _table(code).items() if b >= 0x80 or not high)
    return re.compile(f"[{chars}]{{{least},}}")


@lru_cache(maxsize=16)
def _apart(code: str) -> re.Pattern:
    """Runs of characters of a single-byte code, for a split that keeps them."""
    return re.compile(f"({_class(code, 1, False).pattern})")


@lru_cache(maxsize=16)
def _back(code: str) -> str:
    """The character of each byte of a single-byte code."""
    out = [""] * 256
    for char, byte in reversed(_table(code).items()):
        out[byte] = chr(char)
    return "".join(out)


def _bytes(text: str, code: str) -> bytes:
    return codecs.charmap_encode(text, "strict", _table(code))[0]


@lru_cache(maxsize=16)
def _utf8_chars(code: str) -> tuple[re.Pattern, re.Pattern]:
    """What ``_UTF8`` finds in the bytes of high characters of a single-byte code, in these characters; and, sooner found, what it begins with."""
    chars: dict[int, str] = {}
    for char, byte in _table(code).items():
        chars[byte] = chars.get(byte, "") + re.escape(chr(char))

    def among(least: int, most: int) -> str:
        return "[" + "".join(chars[b] for b in range(least, most + 1)) + "]"

    tail = among(0x80, 0xBF)
    whole = (
        f"{among(0xC2, 0xDF)}{tail}|{among(0xE0, 0xE0)}{among(0xA0, 0xBF)}{tail}|{among(0xE1, 0xEC)[:-1]}{among(0xEE, 0xEF)[1:]}{tail}{{2}}|{among(0xED, 0xED)}{among(0x80, 0x9F)}{tail}"
        f"|{among(0xF0, 0xF0)}{among(0x90, 0xBF)}{tail}{{2}}|{among(0xF1, 0xF3)}{tail}{{3}}|{among(0xF4, 0xF4)}{among(0x80, 0x8F)}{tail}{{2}}"
    )
    return re.compile(whole), re.compile(among(0xC2, 0xF4) + tail)


@lru_cache(maxsize=16)
def _doubles(code: str) -> re.Pattern | None:
    """Characters whose byte is read as another one, if a single-byte code has any: these change where their run is decoded."""
    chars = [re.escape(chr(c)) for c, b in _table(code).items() if b >= 0x80 and _back(code)[b] != chr(c)]
    return re.compile(f"[{''.join(chars)}]") if chars else None


@lru_cache(maxsize=50_000)
def _utf8(text: str, code: str) -> str:
    return _bytes(text, code).decode("utf-8")


def undo_single(line: str, code: str) -> str:
    """``line`` with the runs that are UTF-8 read as ``code`` decoded."""
    whole, begin = _utf8_chars(code)
    if not begin.search(line):
        return line
    doubles = _doubles(code)
    if doubles is None or not doubles.search(line):
        return whole.sub(lambda m: _utf8(m[0], code), line)

    def decode(m: re.Match) -> str:
        raw = _bytes(m[0], code)
        if not _UTF8.search(raw):
            return m[0]
        out, last, back = [], 0, _back(code)
        for u in _UTF8.finditer(raw):
            out.append(codecs.charmap_decode(raw[last : u.start()], "strict", back)[0] + u[0].decode("utf-8"))
            last = u.end()
        return "".join(out) + codecs.charmap_decode(raw[last:], "strict", back)[0]

    return _class(code, 2).sub(decode, line)


def undo_seven(line: str, code: str, pattern: re.Pattern) -> str:
    """``line`` with the pieces of a 7-bit code decoded."""

    def decode(m: re.Match) -> str:
        raw = m[0].encode("ascii")
        if code == "iso2022_jp" and raw[:1] == b"$":
            raw = b"\x1b" + raw[:-2] + b"\x1b" + raw[-2:]
        elif code == "iso2022_kr":
            raw = b"\x1b$)C" + raw
        try:
            return raw.decode(code)
        except UnicodeDecodeError:
            return m[0]

    return pattern.sub(decode, line)


def _wide_pieces(line: str, read_as: str) -> list[str | bytes]:
    """``line`` in pieces: the bytes of what ``read_as`` can have been the reading of, the rest as it is."""
    if read_as in SINGLE:
        pieces = _apart(read_as).split(line)  # those at odd places are of the code
        pieces[1::2] = [p if p.isascii() else _bytes(p, read_as) for p in pieces[1::2]]
        return pieces
    pieces = _BETWEEN.split(line) if "\ufffd" in line else ["", line]  # run by run between the lost characters
    for k in range(1, len(pieces), 2):
        try:
            pieces[k] = pieces[k].encode(read_as)
        except UnicodeEncodeError:
            pass
    return pieces


def _decoded(pieces: list[str | bytes], written: str, most: int) -> tuple[str, int] | None:
    """The pieces decoded as ``written``, and the number of characters lost; None if they are more than ``most``."""
    out, lost = pieces.copy(), 0
    for k in range(1, len(pieces), 2):
        if isinstance(p := pieces[k], bytes):
            out[k] = new = p.decode(written, "replace")
            if "\ufffd" in new and (lost := lost + new.count("\ufffd")) > most:
                return None
    return "".join(out), lost


def undo_wide(line: str, read_as: str, written: str) -> tuple[str, int]:
    """``line`` with ``read_as`` undone and decoded as ``written``, and the number of characters lost; the line itself if it can't be."""
    return _decoded(_wide_pieces(line, read_as), written, 4 * len(line)) or (line, 0)


def _plain(text: str) -> bool:
    """Whether a text is none that is read: ASCII without escapes."""
    return text.isascii() and not (_MARK.search(text) and _READ.search(text))


def _n_high(text: str) -> int:
    """Characters of a text that are not ASCII ones."""
    return len(text) - len(text.encode("ascii", "ignore"))


def _stretches(line: str, code: str) -> bool:
    """Whether high characters of a single-byte code stand in stretches, as those of a wide code do; accented letters and marks stand between ASCII ones."""
    runs = _class(code, 2).findall(line)
    return any(len(r) >= 4 and len(set(r)) >= 3 for r in runs) and sum(map(len, runs)) * 2 >= len("".join(_class(code, 1).findall(line)))


@lru_cache(maxsize=32)
def _reread_table(read_as: str, written: str) -> dict[int, str]:
    """Character read as ``read_as`` -> character written in ``written``, of each high byte."""
    back = _back(written)
    return {c: back[b] for c, b in _table(read_as).items() if b >= 0x80}


@lru_cache(maxsize=1)
def _single_chars() -> re.Pattern:
    """The characters of the high bytes of all single-byte codes."""
    return re.compile("[" + "".join(re.escape(chr(c)) for c in sorted({c for code in SINGLE for c, b in _table(code).items() if b >= 0x80})) + "]")


@lru_cache(maxsize=1)
def _single_runs() -> re.Pattern:
    """Two high characters of single-byte codes in a row."""
    return re.compile(_single_chars().pattern + "{2}")


def contexts(text: str) -> list[str]:
    """Each high character of a single-byte code with its two neighbours; digits count as 0, white space and ends as a blank."""
    out = []
    for m in _single_chars().finditer(text):
        at = m.start()
        before, after = ("0" if c.isdigit() else " " if c.isspace() else c for c in (text[at - 1] if at else " ", text[at + 1] if at + 1 < len(text) else " "))
        out.append(before + m[0] + after)
    return out


class Dictionaries(dict):
    """One zstandard dictionary per language, and of each of ``contexts`` the number of texts that have it."""

    counts: Counter | None = None


class Repairer:
    """Chooses the chain of least description length, line by line."""

    def __init__(self, dictionaries: dict[str, bytes]):
        # characters of the corpus; others that a rare code would bring are taken for lost
        self.alphabet = {c for d in dictionaries.values() for c in d.decode("utf-8", "ignore")}
        counts = getattr(dictionaries, "counts", None)
        self.counts = Counter(c for d in dictionaries.values() for c in contexts(d.decode("utf-8", "ignore"))) if counts is None else counts
        self.memo: dict[str, list[tuple[tuple[str, str], str, float]]] = {}
        self.known_wide = sum(c >= "\u3000" for c in self.alphabet) >= 200
        self.packers = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False) for d in dictionaries.values()] or [
            zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
        ]

    def length(self, line: str) -> int:
        """Bytes of the line by the dictionary that describes it best."""
        raw = line.encode("utf-8", "surrogatepass")
        return min(len(p.compress(raw)) for p in self.packers)

    def _candidates(self, line: str) -> Iterator[tuple[str, int]]:
        """(line with a chain undone, characters lost); characters that the dictionaries do not hold count as lost but for usual ones."""
        for code, pattern in SEVEN if any(x in line for x in ("\x1b", "\x0e", "$", "~{", "+")) else ():
            if pattern.search(line) and (new := undo_seven(line, code, pattern)) != line:
                yield new, 0
        if line.isascii():
            return
        if _single_runs().search(line):  # else no single-byte code has two high characters in a row
            for code in SINGLE:
                if (new := undo_single(line, code)) != line:
                    strange = set(new) - set(line) - self.alphabet if code != SINGLE[0] else ()
                    yield new, sum(not _USUAL.match(c) for c in strange)
            if (n_high := _n_high(line)) >= 4:
                for chains in _TO_WIDE:
                    if _stretches(line, chains[0][0]):
                        yield from self._wide(line, n_high, chains)
        if _EAST_CHAR.search(line):  # UTF-8 and wide codes read as a wide code give such characters
            n_high, chars = _n_high(line), set(line)
            if n_high < KNOWN_LINE or any(c >= "\u2e80" for c in chars - self.alphabet):  # a longer line of known characters only is what it is
                yield from self._wide(line, n_high, _FROM_WIDE if self._plausible(chars) else _BETWEEN_WIDE)

    def _wide(self, line: str, n_high: int, chains: Iterable[tuple[str, str]]) -> Iterator[tuple[str, int]]:
        own, encoded = set(line), {}
        for read_as, written in chains:
            if read_as not in encoded:
                encoded[read_as] = _wide_pieces(line, read_as)
            # what loses more than a quarter is no text of that code; a line of a few characters must lose none
            known = _decoded(encoded[read_as], written, n_high // 4)
            if known is None or known[0] == line:
                continue
            new, lost = known
            if self._plausible(brought := set(new) - own):
                yield new, lost + sum(not _USUAL.match(c) for c in brought - self.alphabet)

    def _plausible(self, new: set[str]) -> bool:
        """Whether most of the Han, kana and Hangul characters among ``new`` are those of the corpus."""
        wide = [c for c in new if c >= "\u3000"]
        return not self.known_wide or sum(c in self.alphabet for c in wide) * 2 >= len(wide)

    def _rereadings(self, word: str) -> list[tuple[tuple[str, str], str, float]]:
        """(chain, word with it undone, bits saved) for the chains of ``REREAD`` that do not make the word longer."""
        out = []
        old = contexts(word)
        for chain in REREAD:
            table = _reread_table(*chain)
            if any(c > "\x7f" and ord(c) not in table for c in word) or (new := word.translate(table)) == word:
                continue
            bits = sum(math.log2((self.counts.get(b, 0) + 0.5) / (self.counts.get(a, 0) + 0.5)) for a, b in zip(old, contexts(new)))
            if bits >= 0:
                out.append((chain, new, bits))
        return out

    def reread(self, line: str) -> str:
        """``line`` with the chain of ``REREAD`` undone that saves most bits, word by word; the line itself if none saves enough."""
        if not _single_chars().search(line):
            return line
        words: dict[str, list] = {}
        total: Counter = Counter()
        for word in line.replace("\t", " ").replace("\r", " ").split(" "):
            if word.isascii():
                continue
            known = self.memo.get(word)
            if known is None:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                known = self.memo[word] = self._rereadings(word)
            words[word] = known
            for chain, _, bits in known:
                if bits >= LEAST_BITS and len(word) > 1:
                    total[chain] += bits
        if not total:
            return line
        best = max(total, key=lambda chain: total[chain])
        right = {word: new for word, known in words.items() for chain, new, _ in known if chain == best}
        return _WORDS.sub(lambda m: right.get(m[0], m[0]), line)

    def _undone(self, line: str) -> tuple[str, int]:
        """The line of least description length, and the steps undone."""
        best, best_cost, steps = line, 0.0, 0
        level, seen = [(0.0, line, 0)], {line}
        for depth in range(1, DEPTH + 1):
            results = []
            for _, current, lost_before in level:
                for new, lost in self._candidates(current):
                    if new in seen:
                        continue
                    seen.add(new)
                    if not best_cost:
                        best_cost = float(self.length(line))
                    penalty = STEP_COST * depth + LOSS_COST * (lost + lost_before)
                    if penalty >= best_cost:  # no length makes up for it
                        continue
                    cost = self.length(new) + penalty
                    results.append((cost, new, lost + lost_before))
                    if cost < best_cost:
                        best, best_cost, steps = new, cost, depth
            level = sorted(results, key=lambda r: (r[2], _n_high(r[1]), *r[:2]))[:BEAM]
            if not level:
                break
        return best, steps

    def repair(self, line: str) -> tuple[str, int]:
        """The line as it was written, as far as can be told, and the steps undone."""
        best, steps = self._undone(line)
        if not best.isascii() and (new := self.reread(best)) != best:
            best, more = self._undone(new)
            steps += 1 + more
        return best, steps

    def text(self, text: str) -> tuple[str, int]:
        """The repaired text and the number of lines changed or with lost characters."""
        if _plain(text):
            return text, 0
        changed = 0

        def fix(m: re.Match) -> str:
            nonlocal changed
            line = m[0]
            if _plain(line):
                return line
            new, steps = self.repair(line)
            changed += steps > 0 or "�" in line
            return new

        return _LINE.sub(fix, text), changed


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of (lang, text): the words of each language; under no language the texts that have each of ``contexts``."""
    names = ["lang", "word", "n"]
    words: dict[str, Counter] = {}
    texts: Counter = Counter()
    memo: dict[str, tuple[str, ...]] = {}

    def misread(word: str) -> bool:
        return bool(_single_runs().search(word)) and any(undo_single(word, code) != word for code in SINGLE)

    def flush() -> pa.RecordBatch:
        langs, keys, counts = [], [], []
        for lang, held in words.items():
            short: Counter = Counter()
            for word, n in held.items():
                for piece in _PIECE.findall(word + " ") if len(word) > LONG_WORD or "\n" in word else (word + " ",):
                    short[piece] += n
            langs += [lang] * len(short)
            keys += short
            counts += short.values()
        langs += [None] * len(texts)
        keys += texts
        counts += texts.values()
        words.clear()
        texts.clear()
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(counts, pa.int64())], names=names)

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            plain = text.isascii()
            if not plain and _GARBLED.search(text):
                continue
            parts = text.split(" ")
            if lang is not None:
                words.setdefault(lang, Counter()).update(parts)
            if not plain and len(text) >= LEAST_TEXT:
                held: set[str] = set()
                for word in set(parts):
                    if not word.isascii():
                        known = memo.get(word)
                        if known is None:
                            if len(memo) >= MEMO:
                                memo.clear()
                            known = memo[word] = () if misread(word) else tuple(c for c in contexts(word) if c[0] != "?")
                        held.update(known)
                texts.update(held)
            if sum(map(len, words.values())) + len(texts) >= COUNTED:
                yield flush()
    yield flush()


def _lines(counts: dict[str, int], total: int) -> list[bytes]:
    """Lines of twelve words in which each word stands as often as its share of ``MODEL_UNITS`` says, at most ``counts`` times, its places spread evenly."""
    scale = min(1.0, MODEL_UNITS / total)
    places = []
    for word, n in counts.items():
        copies = max(1, round(n * scale))
        shift = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "big") / 2**64
        places += [((k + shift) / copies, word) for k in range(copies)]
    ordered = [word for _, word in sorted(places)]
    return ["".join(ordered[k : k + 12]).encode() for k in range(0, len(ordered), 12)]


def train_dictionaries(documents: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> dict[str, bytes]:
    """One zstandard dictionary per language label, and the counts of ``contexts``, from all texts (see the module)."""
    lang = F.when(F.col("lang").isin(*languages), F.col("lang")).alias("lang")
    counted = documents.filter(F.col("text").isNotNull()).select(lang, "text").mapInArrow(_counted, "lang string, word string, n long")
    counts = cut(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))  # asked for twice
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # one row per language
    # words that get a place among ``MODEL_UNITS``, at most twice as many for each language, and all of ``contexts``
    kept = F.col("lang").isNull()
    for name in languages:
        kept = kept | ((F.col("lang") == name) & (2 * MODEL_UNITS * F.col("n") >= totals.get(name, 0)))
    words: dict[str | None, dict[str, int]] = {}
    for r in counts.filter(kept).collect():
        words.setdefault(r["lang"], {})[r["word"]] = r["n"]
    out = Dictionaries()
    out.counts = Counter(words.pop(None, {}))
    for name in languages:
        if name not in words:
            continue
        pieces = _lines(words[name], totals[name])
        try:
            out[name] = zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
        except zstandard.ZstdError:  # too few words: they are the dictionary
            out[name] = b"\n".join(pieces)[-DICTIONARY:]
    return out


def repaired(documents: DataFrame, dictionaries: dict[str, bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, text, n_lines) of the documents with garbled lines: the repaired text and the number of these lines."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(dictionaries)
        for b in batches:
            ids, texts, counts = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                new, n = repairer.text(t)
                if n:
                    ids.append(i)
                    texts.append(new)
                    counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=[id_column, "text", "n_lines"])

    kind = dict(documents.dtypes)[id_column]
    return documents.select(id_column, text_column).filter(F.col(text_column).rlike(READ)).mapInArrow(run, f"{id_column} {kind}, text string, n_lines int")
