"""Problem 5: spellings that name the same person or organisation.

A spelling is cut into folded tokens (case, accents, titles, particles and small words removed); whole words and initials
are told apart. Spellings with the same sorted tokens meet at once. The rest are blocked by phonetic codes (Soundex) of
their sorted tokens: two whole words of a person, all words of an organisation. Against a typo that changes a code, a
word is also blocked by its beginning, its end and (short words) its first and last letter, and a short given name by the
codes of the full names it stands for. Spellings with initials, abbreviations or an acronym are short ones: they are
blocked by one word's code with the first letters of the others, where short ones meet all, but whole ones do not meet
each other, so that no block of a common surname becomes quadratic. Candidates of a block are compared token by token by
Jaro-Winkler similarity, with a bound that follows the words' length and an exact check in doubt, with a nickname table, with initials and
abbreviations, and, for organisations, acronyms. Accepted pairs are clustered by connected components. A short spelling
is given to one cluster of whole ones: the best of the matching ones, so that two persons never meet through an initial
both could have.

Defined results: null and empty names are not spellings; a spelling without a whole word matches only itself; ties go to
the more frequent and then the smaller spelling; exact repeats are one spelling; each pair is given once, a < b.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.operators.components import connected_components
from quirefold.session import cut

#: Two words of L letters (the longer one) may be one with a typo from a Jaro-Winkler similarity of 1 - TYPO / L: one changed
#: letter costs at most 0.67 / L, two cost at least 0.8 / L. Repeated letters can cost more, so between that and DOUBTFUL
#: it is checked whether they are one edit apart.
TYPO, DOUBTFUL = 0.75, 0.78
#: Letters up to which a word is also blocked by its first and last letter.
BRIEF = 5
#: Common short forms of given names, by the full names they can stand for. Fixed values.
NICKNAMES = {
    "alexander": "alex sascha sasha sandro xander", "alexandra": "alex sandra sascha", "andreas": "andi", "andrew": "andy drew",
    "anthony": "tony", "antonio": "toni tonio", "barbara": "babs barb", "benjamin": "ben benny", "catherine": "cathy kate katie",
    "charles": "chuck charlie carl", "christopher": "chris kit", "daniel": "dan danny", "david": "dave", "dorothea": "dora doro thea dorle",
    "dorothy": "dot dottie dolly", "edward": "ed eddie ted ned", "eleanor": "nell nora ella", "elizabeth": "beth liz lizzie betty eliza lisa elsie libby bess",
    "emanuel": "manu manny", "ferdinand": "ferdi", "francesca": "franca cesca fran", "francisco": "paco pancho", "franziska": "franzi sissi", "frederick": "fred freddy fritz",
    "friedrich": "fritz", "giovanni": "gianni nino", "giuseppe": "beppe peppe pino", "gregory": "greg", "hans": "hansi", "heinrich": "heinz heiner",
    "henrik": "henke rik henk", "henry": "harry hank hal", "ignacio": "nacho", "isabella": "bella isa izzy ella", "jacob": "jake", "james": "jim jimmy jamie",
    "johannes": "hannes jo", "john": "jack johnny", "jonathan": "jon", "josef": "sepp pepi", "josefina": "pepa fina josie", "joseph": "joe joey", "joshua": "josh",
    "katharina": "kathe kathi kati katja rina kaethe", "katherine": "kate kathy katie kit", "konstantin": "kostja", "lawrence": "larry", "leonard": "leo len lenny",
    "ludwig": "lutz luggi wiggerl", "manuel": "manolo", "margaret": "maggie meg peggy marge greta daisy", "maria": "mia mitzi", "martha": "patty", "matthew": "matt",
    "michael": "mike mick mickey", "mikhail": "misha", "nathaniel": "nat nate", "nicholas": "nick", "nikolai": "kolya nik", "nikolaus": "klaus nik", "oliver": "ollie oli noll",
    "patricia": "pat trish patty tricia", "patrick": "paddy pat", "peter": "pete", "philip": "phil", "rebecca": "becky", "richard": "rick dick rich richie", "robert": "rob bob bert bobby robbie",
    "roland": "rolli", "samuel": "sam", "sebastian": "basti seb bastian", "stephen": "steve", "susan": "sue susie", "theodore": "ted theo teddy", "theresa": "terry tess", "thomas": "tom tommy",
    "timothy": "tim", "ursula": "uschi ulla ursel", "valentina": "valya", "victoria": "vicky", "vincent": "vince vinny vin", "vladimir": "vova volodya", "walter": "walt", "wilhelm": "willi",
    "william": "will bill billy willy liam", "yevgenia": "zhenya genya", "yevgeny": "zhenya", "zacharias": "zach zack zac",
}
_FULL: dict[str, set[str]] = {}
for _full, _short in NICKNAMES.items():
    for _s in _short.split():
        _FULL.setdefault(_s, set()).add(_full)
#: Words without weight in names. Fixed values.
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "sir", "phd", "md"}
PARTICLES = {"van", "von", "de", "der", "den", "da", "di", "del", "la", "le", "du", "ter", "zu"}
SMALL = {"of", "for", "the", "and", "in", "at", "on", "de", "der", "des", "fur", "la", "le", "et", "und", "y"}

_WORD = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+)*\.?")


def fold(text: str) -> str:
    """Lower case without accents."""
    plain = unicodedata.normalize("NFKD", text.casefold())
    return "".join(c for c in plain if not unicodedata.combining(c))


def person_tokens(name: str) -> tuple[list[str], list[str]]:
    """(whole words, initials) of a person's name, titles and particles left out; initials in written order."""
    whole, initials = [], []
    words = _WORD.findall(re.sub(r"(?<=\b[^\W\d_])\.(?=[^\W\d_])", ". ", name))
    for k, raw in enumerate(words):
        bare = raw.rstrip(".")
        low = fold(bare)
        if (low in TITLES and not bare.isupper()) or low in TITLES and raw.endswith("."):
            continue
        # in capitals, two letters before a mixed-case name are initials
        if low in PARTICLES and not (len(low) == 2 and bare.isupper() and not any(w.isupper() and len(w.rstrip(".")) > 2 for w in words[k + 1 :])):
            continue
        if len(low) == 1:
            initials.append(low)
        elif len(low) <= 3 and bare.isupper() and low not in _FULL:
            initials += list(low)
        else:
            whole.append(low)
    if not whole and len(initials) > 1:  # a short name in capitals
        whole, initials = ["".join(initials)], []
    return whole, initials


def organisation_tokens(name: str) -> tuple[list[str], list[str], str]:
    """(whole words, abbreviated words, acronym) of an organisation's name, small words left out."""
    whole, short, acronym = [], [], ""
    words = _WORD.findall(name)
    capitals = name.isupper()
    for raw in words:
        bare = raw.rstrip(".")
        low = fold(bare)
        if low in SMALL:
            continue
        if raw.endswith(".") and len(words) > 1:
            short.append(low)
        elif bare.isupper() and not capitals and 2 <= len(low) <= 6:
            acronym = low
        else:
            whole.append(low)
    return whole, short, acronym


def soundex(word: str) -> str:
    """The phonetic code of a folded word."""
    groups = {c: d for d, cs in enumerate(("bfpv", "cgjkqsxz", "dt", "l", "mn", "r"), 1) for c in cs}
    code, last = word[:1], groups.get(word[:1])
    for c in word[1:]:
        now = groups.get(c)
        if now and now != last:
            code += str(now)
        if c not in "hw":
            last = now
    return code[:4].ljust(4, "0")


def jaro_winkler(a: str, b: str) -> float:
    """Similarity of two words from 0 to 1, with a bonus for a common beginning."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, in_a = [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                in_a.append((c, j))
                break
    m = len(in_a)
    if not m:
        return 0.0
    in_b = [b[j] for j in sorted(j for _, j in in_a)]
    swaps = sum(x != y for (x, _), y in zip(in_a, in_b)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by at most one insertion, deletion, replacement or swap of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :] or a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :]
    if len(a) > len(b):
        a, b = b, a
    return a[k:] == b[k + 1 :]


def similar(a: str, b: str) -> bool:
    """Whether two words are as similar, by Jaro-Winkler, as one word with and without a typo; words of fewer than four letters never are."""
    if min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 1:
        return False
    same = jaro_winkler(a, b)
    return same >= 1 - TYPO / max(len(a), len(b)) or same >= DOUBTFUL and one_edit(a, b)


def same_word(a: str, b: str) -> int | None:
    """Typos between two words: 0 or 1; None if they are different words."""
    if a == b:
        return 0
    if similar(a, b):
        return 1
    if _FULL.get(a, set()) & (_FULL.get(b, set()) | {b}) or a in _FULL.get(b, set()):
        return 0
    for x, y in ((a, b), (b, a)):  # a short form of a name with a typo
        if any(similar(x, f) for f in _FULL.get(y, ())):
            return 1
    return None


def _matched(a: list[str], b: list[str]) -> tuple[list[str], list[str], int] | None:
    """Pair the words of two names greedily, equal ones first: what is left of each, and the typos; None if no word pairs."""
    left, right, typos, found = list(a), list(b), 0, False
    for limit in (0, 1):
        for x in list(left):
            for y in right:
                t = same_word(x, y)
                if t is not None and t <= limit:
                    left.remove(x)
                    right.remove(y)
                    typos += t
                    found = True
                    break
    return (left, right, typos) if found else None


def _first_letters(word: str) -> set[str]:
    """The initials under which a given name is written: those of the full names that a short form stands for."""
    full = {f[0] for f in _FULL.get(word, ())}
    return full if full and word not in NICKNAMES else full | {word[0]}


def same_person(a: str, b: str) -> int | None:
    """Typos between two spellings of one person; None if they name different persons."""
    (wa, ia), (wb, ib) = person_tokens(a), person_tokens(b)
    met = _matched(wa, wb)
    if met is None or met[2] > 2:
        return None
    left, right, typos = met
    if left and right:
        return None
    rest_a, rest_b = list(ia), list(ib)
    if (not left and not right) and len(wa) == 1 and len(wb) == 1 and (not ia or not ib):
        return None if ia != ib else typos
    # a whole given name on one side stands against the first initial of the other
    for words, initials in ((left, rest_b), (right, rest_a)):
        for w in words:
            if not initials or initials[0] not in _first_letters(w):
                return None
            initials.pop(0)
    if rest_a and rest_b:
        n = min(len(rest_a), len(rest_b))
        if rest_a[:n] != rest_b[:n]:
            return None
    return typos


def _abbreviates(short: str, word: str) -> bool:
    """Whether ``short`` is a beginning of ``word``, perhaps with a typo, or leaves letters out after the first."""
    if word.startswith(short) or word[:1] == short[:1] and len(short) > 2 and one_edit(word[: len(short)], short):
        return True
    letters = iter(word)
    return len(short) > 1 and word[:1] == short[:1] and all(c in letters for c in short)


def same_organisation(a: str, b: str) -> int | None:
    """Typos between two spellings of one organisation; None if they name different ones."""
    (wa, sa, ca), (wb, sb, cb) = organisation_tokens(a), organisation_tokens(b)
    met = _matched(wa, wb)
    if met is None or met[2] > 2:
        return None
    left, right, typos = met
    for short, words in ((sa, right), (sb, left)):  # abbreviated words stand for whole ones
        for abbreviation in short:
            hit = next((w for w in words if _abbreviates(abbreviation, w)), None)
            if hit:
                words.remove(hit)
    spare_a = [s for s in sa if not any(_abbreviates(s, w) for w in wb)]
    spare_b = [s for s in sb if not any(_abbreviates(s, w) for w in wa)]
    if not (ca or cb):  # an abbreviation without its word must stand against an abbreviation
        if len(spare_a) != len(spare_b) or any(not any(_abbreviates(s, t) or _abbreviates(t, s) for t in spare_b) for s in spare_a):
            return None
    if ca and cb:
        return typos if ca == cb and not left and not right else None
    if ca or cb:
        acronym, words, shorts, other = (ca, right, sb, wb) if ca else (cb, left, sa, wa)
        rest = left if ca else right
        return typos if not rest and sorted(acronym) == sorted(w[0] for w in [*words, *shorts]) else None
    return typos if not left and not right else None


def _codes(word: str) -> set[str]:
    """The codes of a word: phonetic, by its beginning and its end, and for a brief word by its first and last letter."""
    return {f"s{soundex(word)}", f"b{word[:3]}", f"e{word[-3:]}"} | ({f"o{word[0]}{word[-1]}"} if len(word) <= BRIEF else set())


def blocks(kind: str, name: str) -> list[tuple[str, str]]:
    """(block, role) of the blocks in which a spelling is compared. In a block of role ``both`` all meet; ``short`` ones meet all, ``whole`` ones only these."""
    out: set[tuple[str, str]] = set()
    if kind == "author":
        words, initials = person_tokens(name)
        codes = [{c for x in (w, *_FULL.get(w, ())) for c in _codes(x)} for w in words]
        for i in range(len(words)):
            for j in range(i):
                out |= {("2" + "|".join(sorted((a, b))), "both") for a in codes[i] for b in codes[j]}
        role = "short" if len(words) == 1 else "whole"
        for i, w in enumerate(words):
            others = {c for j, x in enumerate(words) if j != i for c in _first_letters(x)} or set(initials[:1]) or {""}
            out |= {(f"1{a}|{o}", role) for a in _codes(w) for o in others}
        return sorted(out)
    words, short, acronym = organisation_tokens(name)
    role = "short" if short or acronym else "whole"
    for i, w in enumerate(words):
        if len(w) < 4:
            continue
        rest = [x for j, x in enumerate(words) if j != i]
        if role == "whole":
            out |= {(f"2{a}|{'|'.join(sorted(map(soundex, rest)))}", "both") for a in _codes(w)}
        letters = "".join(sorted([x[0] for x in rest] + [x[0] for x in short] + list(acronym)))
        out |= {(f"1{a}|{letters}", role) for a in _codes(w)}
    return sorted(out)


def key_of(kind: str, name: str) -> str:
    """Spellings with equal keys are one name: sorted folded tokens."""
    if kind == "author":
        words, initials = person_tokens(name)
        return " ".join(sorted(words)) + "|" + " ".join(initials)
    words, short, acronym = organisation_tokens(name)
    return " ".join(sorted(words)) + "|" + " ".join(sorted(short)) + "|" + acronym


def link(spellings: DataFrame) -> DataFrame:
    """(kind, name, cluster) of ``spellings`` (kind, name, n); kind is ``author`` or ``affiliation``, n the rows that have it."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(key=[key_of(k, n) for k, n in zip(b.kind, b.name)])

    named = cut(spellings.filter(F.col("name").isNotNull() & (F.trim("name") != "")).groupBy("kind", "name").agg(F.sum("n").alias("n")).mapInPandas(keyed, "kind string, name string, n long, key string"))
    # one representative spelling for each key; the rest of its spellings belong to it
    reps = named.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.min("name").alias("name"))

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, x, role, key, name, n) for k, key, name, n in zip(b.kind, b.key, b.name, b.n) for x, role in blocks(k, name)]
            yield pd.DataFrame(rows, columns=["kind", "block", "role", "key", "name", "n"])

    spread = cut(reps.select("kind", "key", "name", "n").mapInPandas(blocked, "kind string, block string, role string, key string, name string, n long"))
    left = spread.filter("role <> 'whole'").select("kind", "block", "role", F.struct("key", "name", "n").alias("x"))
    right = spread.select("kind", "block", F.col("role").alias("role2"), F.struct("key", "name", "n").alias("y"))
    met = left.join(right, ["kind", "block"]).filter("x.key < y.key OR x.key > y.key AND role2 = 'whole'")
    one, two = F.least("x", "y"), F.greatest("x", "y")
    pairs = met.select("kind", one.key.alias("key"), two.key.alias("key2"), one["name"].alias("name"), two["name"].alias("name2"), one.n.alias("n"), two.n.alias("n2")).dropDuplicates(["kind", "key", "key2"])

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for kind, key, key2, name, name2, n, n2 in zip(b.kind, b.key, b.key2, b.name, b.name2, b.n, b.n2):
                typos = (same_person if kind == "author" else same_organisation)(name, name2)
                if typos is not None:
                    out.append((kind, key, key2, n, n2, typos, *(kind == "author" and len(person_tokens(x)[0]) < 2 or kind != "author" and bool(organisation_tokens(x)[2]) for x in (name, name2))))
            yield pd.DataFrame(out, columns=["kind", "key", "key2", "n", "n2", "typos", "short", "short2"])

    edges = cut(pairs.select("kind", "key", "key2", "name", "name2", "n", "n2").mapInPandas(compared, "kind string, key string, key2 string, n long, n2 long, typos int, short boolean, short2 boolean"))
    whole = edges.filter("not short and not short2").select("kind", "key", "key2")
    prefix = lambda c: F.concat("kind", F.lit("\t"), c)
    clusters = connected_components(whole.select(prefix(F.col("key")).alias("a"), prefix(F.col("key2")).alias("b")))
    # a short spelling goes to one cluster of whole ones: fewest typos, then the more frequent cluster
    size = cut(reps.select(prefix(F.col("key")).alias("node"), "n").join(clusters, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component")))
    total = size.groupBy("component").agg(F.sum("n").alias("total"))
    mixed = edges.filter("short and not short2").select("kind", F.col("key").alias("s"), F.col("key2").alias("w"), "typos").union(edges.filter("short2 and not short").select("kind", F.col("key2").alias("s"), F.col("key").alias("w"), "typos"))
    chosen = (
        mixed.withColumn("node", prefix(F.col("w"))).join(size.select("node", "component"), "node").join(total, "component")
        .groupBy("kind", "s").agg(F.max_by("w", F.struct(-F.col("typos"), "total", F.col("w"))).alias("w"))
    )
    alone = edges.filter("short and short2").select("kind", "key", "key2")
    free = alone.join(chosen.select("kind", F.col("s").alias("key")), ["kind", "key"], "left_anti").join(chosen.select("kind", F.col("s").alias("key2")), ["kind", "key2"], "left_anti").select("kind", "key", "key2")
    final = whole.union(chosen.select("kind", "s", "w")).union(free)
    nodes = connected_components(final.select(prefix(F.col("key")).alias("a"), prefix(F.col("key2")).alias("b")))
    return named.withColumn("node", prefix(F.col("key"))).join(nodes, "node", "left").select("kind", "name", F.coalesce("component", "node").alias("cluster"))


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """(kind, name_a, name_b) of every two spellings of one cluster, name_a < name_b in code point order."""
    a = linked.select("kind", "cluster", F.col("name").alias("name_a"))
    b = linked.select("kind", "cluster", F.col("name").alias("name_b"))
    return a.join(b, ["kind", "cluster"]).filter("name_a < name_b").select("kind", "name_a", "name_b")
