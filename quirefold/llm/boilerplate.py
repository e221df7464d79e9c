"""Problem 7: lines repeated across the documents of one source, and the pages' texts without them.

Each line is normalised (letter case, digits, spacing and punctuation removed, and the letters that scanners confuse, so
that most misread copies meet in one hash) and hashed. Distinct documents per source and hash are counted with
two partial aggregations, so that a hot source costs no more per task than another. Hashes shared by ``HEADS`` documents
or more become heads; heads within a few edits of each other, also by way of a third one, are one line (connected
components), which counts if its heads lie in ``TOGETHER`` documents. A line with a head's hash that is the head's but for few edits belongs to it. Every other long line belongs
to the best head of its source within the allowed edits: a head is cut into two pieces more than edits are allowed, so
that two pieces stand whole in the line, and the lines that hold two pieces of a head of their source are compared in full.
Heads whose lines lie in at least ``min_documents`` documents and in at least ``min_share`` of the source's documents are
boilerplate.

No page text is moved: the readers pass on only lines whose hash or pair of pieces is in a bit filter of the heads' hashes
and pairs, and the heads' letters are read where a bit filter has their page and hash. A filter grows with what it holds, up
to a bound; it never drops a line that matches, and what it passes too much the joins drop.

Defined results: null and empty fields have no lines; lines without a letter, page numbers and asset references are
never cases; pages without document or source are left out; a page stored twice counts its document once; repeated rows
are reported once; lines shorter than ``LONG`` letters are matched by their exact letters only; a line must lie in ``TOGETHER`` documents
of its source (of at least ``min_documents``) in readings that two of them share each, or that are near such ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold.llm.filters import bit_filter, in_filter
from quirefold.operators.components import connected_components
from quirefold.session import bounded_broadcast, cut

FIELDS = ("header_text", "footer_text", "body_text")
#: Documents of a source in which a line must lie; and the least share of the source's documents (none asked here).
MIN_DOCUMENTS, MIN_SHARE = 6, 0.0
#: Documents from which a hash can gather misread copies.
HEADS = 2
#: Documents that the heads of one line must have together, so that other lines are held against them: two thirds of
#: MIN_DOCUMENTS. (Lines that two or three documents share by chance grow faster than the data; none of them is a case.)
TOGETHER = 4
#: Letters of a head from which lines are matched approximately, and from which its pieces are long ones.
LONG, LONGER = 16, 33
#: Letters of a short and of a long piece; with the allowed edits no piece of a head is shorter.
SHORT_PIECE, LONG_PIECE = 4, 8
#: Places and lengths that count as one when pieces are looked up.
WIDTH = 8
#: Letters that the hash must rest on.
SKELETON = 7
#: Edits beyond which two keys are never compared to the end.
FAR = 12
#: What the hash of a line leaves out: everything but letters, and every letter that takes part in a common misreading
#: (c for e, l or 1 for i, f for t, 5 for s, 0 for o, ii for u, cl for d, rn for m, b or 6 for h, vv for w, 9 for g, ...),
#: so that misread copies of a line have its hash; f counts as t. Fixed values.
LEFT_OUT = r"[^\p{L}]+|[bcdeéghilmnorsuvw을올를름]+"
#: Lines with nothing but a page number or an asset reference. Fixed values.
NOT_LINES = r"(?iU)^[\s\W_]*(?:p(?:age|g)?|s(?:eite)?|pág(?:ina)?|쪽|페이지|ページ|頁)?[\s.\-–—:]*(?:\d{1,5}|[ivxlc]{1,7})[\s\W_]*(?:(?:/|of|von|de|sur|중)\s*\d{1,5})?[\s\W_]*(?:쪽|페이지|ページ|頁)?[\s\W_]*$|^\W*\[(?:TABLE|FIGURE)_\d+\]\W*$"


def letters(line: Column) -> Column:
    """The letters of a line in lower case."""
    return F.lower(F.regexp_replace(line, r"[^\p{L}\p{M}]+", ""))


def with_hash(lines: DataFrame) -> DataFrame:
    """``lines`` (line, ...) with ``hash``: of what no misreading changes; of all letters where less than ``SKELETON`` of that is left."""
    folded = F.translate(F.regexp_replace(F.lower("line"), LEFT_OUT, ""), "f", "t")
    # a generator keeps the pattern from being run for each use of its result
    once = lines.withColumn("skeleton", F.explode(F.array(folded)))
    rested = F.when(F.length("skeleton") >= SKELETON, F.col("skeleton")).otherwise(letters(F.col("line")))
    return once.withColumn("hash", F.xxhash64(rested)).drop("skeleton")


def page_lines(pages: DataFrame) -> DataFrame:
    """(page_id, document_id, field_name, line_no, line) of the lines that can be boilerplate; further columns of ``pages`` named source stay."""
    keep = ["document_id", *(["source"] if "source" in pages.columns else [])]
    owned = pages.filter(F.col("document_id").isNotNull()).select(F.col("id").alias("page_id"), *keep, *FIELDS)
    parts = F.array(*[F.struct(F.lit(f).alias("field_name"), F.split(F.col(f), "\n").alias("lines")) for f in FIELDS])
    long = owned.select("page_id", *keep, F.inline(parts)).filter(F.col("lines").isNotNull())
    lines = long.select("page_id", *keep, "field_name", F.posexplode("lines").alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(r"\p{L}") & ~F.col("line").rlike(NOT_LINES))


def owners(documents: DataFrame) -> DataFrame:
    """(document_id, source) of the documents that have a source."""
    return documents.filter(F.col("source").isNotNull()).select(F.col("doc_id").alias("document_id"), "source")


def allowed_edits(n: int, share: float = 0.06) -> int:
    """Edits by which a line may differ from a head of ``n`` letters."""
    return min(max(2, int(n * share)), FAR)


_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * _MIX
    h ^= h >> np.uint64(29)
    h *= _FACTOR
    return h ^ (h >> np.uint64(32))


def piece_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the SHORT_PIECE and of the LONG_PIECE letters that begin at each place of a text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(c)
    if n < SHORT_PIECE:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        short = c[: n - SHORT_PIECE + 1].copy()
        for k in range(1, SHORT_PIECE):
            short *= _FACTOR
            short += c[k : n - SHORT_PIECE + 1 + k]
        m = max(n - LONG_PIECE + 1, 0)
        long = short[:m].copy()
        for k in range(SHORT_PIECE, LONG_PIECE):
            long *= _FACTOR
            long += c[k : m + k]
        return _mixed(short, 1), _mixed(long, 2)


def _placed(hashes: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Piece hashes with the stretch of ``WIDTH`` places and of ``WIDTH`` lengths they stand in."""
    with np.errstate(over="ignore"):
        return _mixed(hashes + (place // WIDTH).astype(np.uint64) * _MIX + (size // WIDTH).astype(np.uint64) * _FACTOR, 3).view(np.int64)


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of two placed pieces, the first of which stands before the second."""
    with np.errstate(over="ignore"):
        return _mixed(first.view(np.uint64) * _FACTOR + second.view(np.uint64), 4).view(np.int64)


def head_pieces(key: str) -> list[list[np.ndarray]]:
    """For each length that a line near a head may have, the beginnings of the head's pieces, two more than edits are
    allowed, each at the places to which so many edits can move it; none for short heads."""
    n = len(key)
    if n < LONG:
        return []
    hashes = piece_hashes(key)[n >= LONGER]
    edits = allowed_edits(n)
    out = []
    for size in range(max(0, n - edits) // WIDTH, (n + edits) // WIDTH + 1):
        pieces = []
        for at in (n * k // (edits + 2) for k in range(edits + 2)):
            places = np.arange(max(0, at - edits) // WIDTH, (at + edits) // WIDTH + 1) * WIDTH
            pieces.append(_placed(np.repeat(hashes[at], len(places)), places, np.full(len(places), size * WIDTH)))
        out.append(pieces)
    return out


def head_pairs(key: str) -> list[int]:
    """What a line near a head is looked up by: the pairs of the head's pieces in lines of one length."""
    pairs = [_paired(np.repeat(a, len(b)), np.tile(b, len(a))) for pieces in head_pieces(key) for k, b in enumerate(pieces) for a in pieces[:k]]
    return sorted(set(np.concatenate(pairs).tolist())) if pairs else []


def _survivors(lines: DataFrame, hashes: np.ndarray | None, pieces: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """``lines`` (..., hash, key) that can belong to a head, with ``pairs``: those pairs of their pieces that heads may have."""
    names = lines.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = ["" if k is None else k for k in b.column(names.index("key")).to_pylist()]
            size = np.array([len(k) for k in keys], np.int64)
            owner = np.repeat(np.arange(len(keys)), size)
            at = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
            hits = []
            # a head of LONGER letters or more has lines of LONGER - 2 or more, one of LONG or more has lines of LONG - 2 or more
            for h, width, least, most in zip(piece_hashes("".join(keys)), (SHORT_PIECE, LONG_PIECE), (LONG - 2, LONGER - 2), (LONGER + 1, None)):
                n = size[owner[: len(h)]]
                fits = (at[: len(h)] + width <= n) & (n >= least)
                if most is not None:
                    fits &= n <= most
                places = np.flatnonzero(fits)
                placed = _placed(h[places], at[places], n[places])
                known = in_filter(pieces, placed)
                hits.append((owner[places[known]], placed[known]))
            found = []
            for of, placed in hits:
                for step in range(1, int(np.bincount(of).max(initial=0))):
                    first = np.flatnonzero(of[step:] == of[:-step])
                    if not len(first):
                        break
                    pair = _paired(placed[first], placed[first + step])
                    known = in_filter(pairs, pair)
                    found.append((of[first[known]], pair[known]))
            of, pair = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
            order = np.argsort(of, kind="stable")
            count = np.bincount(of, minlength=len(keys))
            kept = count > 0
            if hashes is not None:
                kept |= in_filter(hashes, b.column(names.index("hash")).to_numpy())
            offsets = np.concatenate(([0], np.cumsum(count[kept])))
            out = b.filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pair[order]))], names=[*names, "pairs"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema)
    return lines.mapInArrow(run, f"{schema}, pairs array<bigint>")


def _close(a: Column, b: Column, share: float = 0.06, far: int = FAR) -> Column:
    """Whether two keys differ by a few edits only: two, or ``share`` of the letters up to ``far``."""
    allowed = F.least(F.greatest(F.lit(2), F.floor(F.length(b) * share)), F.lit(far)).cast("int")
    return (F.abs(F.length(a) - F.length(b)) <= allowed) & F.levenshtein(a, b, far).between(0, allowed)


def hashed_lines(pages: DataFrame) -> DataFrame:
    """(page_id, document_id, field_name, line_no, hash) of the lines that can be boilerplate."""
    return with_hash(page_lines(pages)).select("page_id", "document_id", "field_name", "line_no", "hash")


def shared_lines(lines: DataFrame, documents: DataFrame, least: int = HEADS) -> DataFrame:
    """(source, hash, n, page_id): the hashes of ``lines`` that ``least`` or more documents of a source have, and a page that has it.

    The texts stay where they are: only distinct (document, hash) rows meet the documents' sources.
    """
    seen = lines.groupBy("document_id", "hash").agg(F.min("page_id").alias("page_id"))
    return seen.join(owners(documents), "document_id").groupBy("source", "hash").agg(F.count("*").alias("n"), F.min("page_id").alias("page_id")).filter(F.col("n") >= least)


def _in(bits: np.ndarray, hashes: Column) -> Column:
    """Whether each hash may be among those of the filter; only the hashes go to Python."""
    return F.arrow_udf(lambda h: pa.array(in_filter(bits, h.to_numpy())), "boolean")(hashes)


def head_keys(pages: DataFrame, shared: DataFrame) -> DataFrame:
    """(source, head, n, head_key): the hashes of ``shared`` with their letters, read from one page each."""
    n = shared.count()
    on_page, there = F.xxhash64("page_id"), F.xxhash64("page_id", "hash")
    told = pages.filter(_in(bit_filter(shared.select(on_page.alias("h")), "h", n), F.xxhash64("id")))
    lines = with_hash(page_lines(told)).filter(_in(bit_filter(shared.select(there.alias("h")), "h", n), there))
    keys = lines.select("page_id", "hash", letters(F.col("line")).alias("key")).groupBy("page_id", "hash").agg(F.min("key").alias("head_key"))
    return shared.join(keys, ["page_id", "hash"]).select("source", F.col("hash").alias("head"), "n", "head_key")


def _pairs_of(heads: DataFrame) -> DataFrame:
    """(source, head, pair) of ``heads`` (source, head, head_key); the letters stay behind, as long heads have many pairs."""
    cutter = F.udf(head_pairs, "array<bigint>", useArrow=True)  # once per head
    return heads.select("source", "head", F.explode(cutter("head_key")).alias("pair"))


def _filters(heads: DataFrame, pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The filters of the heads' pieces, which are fewer than their pairs, and of the ``pairs``."""
    n = pairs.count()
    cutter = F.udf(lambda key: [x for pieces in head_pieces(key) for piece in pieces for x in piece.tolist()], "array<bigint>", useArrow=True)
    return bit_filter(heads.select(F.explode(cutter("head_key")).alias("piece")), "piece", n), bit_filter(pairs, "pair", n)


def _met(lines: DataFrame, pairs: DataFrame, *ids: str) -> DataFrame:
    """(ids, source, head) of the ``lines`` (ids, source, pairs) that hold a pair of a head of their source, each once; not a head (a) with itself."""
    looked = lines.select(*ids, "source", F.explode(F.array_distinct("pairs")).alias("pair"))
    met = looked.join(pairs, ["source", "pair"])
    return (met.filter(F.col("a") != F.col("head")) if "a" in ids else met).select(*ids, "source", "head").distinct()


def near_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """(page_id, segment_no) of the ``lines`` (page_id, segment_no, source, key) that are within the allowed edits of one of the ``heads`` (source, head, head_key) of their source."""
    ids = ["page_id", "segment_no"]
    heads = cut(heads.select("source", "head", "head_key"))
    pairs = cut(_pairs_of(heads))
    kept = cut(_survivors(lines.select(*ids, "source", "key"), None, *_filters(heads, pairs)))
    met = _met(kept, pairs, *ids).join(heads, ["source", "head"]).join(kept.select(*ids, "key"), ids)
    return met.filter(_close(F.col("key"), F.col("head_key"))).select(*ids).distinct()


def _roots(heads: DataFrame) -> DataFrame:
    """``heads`` with ``root``: heads within a few edits of each other, or joined by such steps, have the same."""
    vertex = lambda h: F.concat_ws("\t", "source", F.col(h).cast("string"))
    pairs = cut(_pairs_of(heads))
    lines = heads.select("source", F.col("head").alias("a"), F.col("head_key").alias("key"))
    met = _met(_survivors(lines, None, *_filters(heads, pairs)), pairs, "a")
    both = met.join(heads.select("source", "head", "head_key"), ["source", "head"]).join(lines, ["source", "a"])
    edges = both.filter(_close(F.col("key"), F.col("head_key"))).select(vertex("a").alias("a"), vertex("head").alias("b"))
    roots = connected_components(edges).select(F.col("node").alias("vertex"), F.col("component").alias("root"))
    rooted = heads.withColumn("vertex", vertex("head")).join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex")).drop("vertex")
    enough = rooted.groupBy("root").agg(F.sum("n").alias("together")).filter(F.col("together") >= TOGETHER).select("root")
    return rooted.join(enough, "root", "left_semi")


def matched_lines(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, document_id, source, field_name, line_no, root) of every line that is, exactly or nearly, that of a head of its source."""
    heads = cut(_roots(cut(head_keys(pages, cut(shared_lines(hashed_lines(pages), documents))))))
    longest = heads.agg(F.max(F.length("head_key"))).first()[0] or 0  # no line with more letters is near a head
    pairs = cut(_pairs_of(heads))
    key = F.when(F.length("line") <= longest * 2 + 40, letters(F.col("line")))
    lines = with_hash(page_lines(pages)).select("page_id", "document_id", "field_name", "line_no", "hash", key.alias("key"))
    kept = _survivors(lines, bit_filter(heads, "head", heads.count()), *_filters(heads, pairs)).join(owners(documents), "document_id")
    # a line that has a head's hash, and in full not much else than the head, is that head's; only the rest looks for pieces
    exact = heads.select("source", F.col("head").alias("hash"), F.col("root").alias("own_root"), F.col("head_key").alias("own_key"))
    own = F.when(F.col("own_root").isNotNull() & _close(F.col("key"), F.col("own_key"), 0.12, 2 * FAR), F.col("own_root"))
    marked = kept.join(exact, ["source", "hash"], "left").withColumn("root", own)
    line = ["page_id", "field_name", "line_no"]
    placed = ["page_id", "document_id", "source", "field_name", "line_no"]
    marked = cut(marked.select(*placed, "root", F.when(F.col("root").isNull(), F.col("key")).alias("key"), F.when(F.col("root").isNull(), F.col("pairs")).alias("pairs")))
    rest = marked.filter("root IS NULL")
    near = _met(rest, pairs, *line).join(heads.select("source", "head", "head_key", "n", "root"), ["source", "head"]).join(rest.select(*line, "document_id", "key"), line).filter(_close(F.col("key"), F.col("head_key")))
    best = near.groupBy(*placed).agg(F.max_by("root", F.struct("n", "root")).alias("root"))
    return marked.filter("root IS NOT NULL").select(*placed, "root").unionByName(best.select(*placed, "root"))


def same_lines(lines: DataFrame, documents: DataFrame, shared: DataFrame) -> DataFrame:
    """(page_id, field_name, line_no) of the hashed ``lines`` whose hash is one of their source in ``shared``."""
    owned = lines.join(bounded_broadcast(shared.select("hash").distinct()), "hash").join(owners(documents), "document_id")
    return owned.join(bounded_broadcast(shared.select("source", "hash")), ["source", "hash"]).select("page_id", "field_name", "line_no").distinct()


def found(pages: DataFrame, documents: DataFrame, min_documents: int = MIN_DOCUMENTS, min_share: float = MIN_SHARE, approximate: bool = True) -> DataFrame:
    """(page_id, field_name, line_no) of every boilerplate line; without ``approximate`` of those with equal hashes only."""
    if not approximate:
        lines = cut(hashed_lines(pages))
        return same_lines(lines, documents, cut(shared_lines(lines, documents, min_documents)))
    matched = cut(matched_lines(pages, documents))
    total = matched.select("source", "root", "document_id").distinct().groupBy("source", "root").agg(F.count("*").alias("n"))
    if min_share > 0:
        size = documents.filter(F.col("source").isNotNull()).groupBy("source").agg(F.countDistinct("doc_id").alias("of"))
        total = total.join(size, "source").filter(F.col("n") >= F.col("of") * min_share)
    kept = total.filter(F.col("n") >= min_documents).select("source", "root")
    return matched.join(bounded_broadcast(kept), ["source", "root"]).select("page_id", "field_name", "line_no").distinct()


def cleaned(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(id, document_id, page_num, header_text, footer_text, body_text) of every page, without its boilerplate lines."""
    drop = found(pages, documents).groupBy("page_id").agg(*[F.collect_set(F.when(F.col("field_name") == f, F.col("line_no"))).alias(f"_{f}") for f in FIELDS])
    joined = pages.select("id", "document_id", "page_num", *FIELDS).join(drop, F.col("id") == F.col("page_id"), "left").drop("page_id")

    def kept(f: str) -> Column:
        lines = F.filter(F.split(F.col(f), "\n"), lambda line, i: ~F.coalesce(F.array_contains(F.col(f"_{f}"), i), F.lit(False)))
        return F.when(F.col(f"_{f}").isNull(), F.col(f)).otherwise(F.array_join(lines, "\n")).alias(f)

    return joined.select("id", "document_id", "page_num", *[kept(f) for f in FIELDS])
