from collections import defaultdict

import pytest
from quirefold.llm import names

PERSONS = [["Zacharias Liralil", "Zacharias A. Liralil", "Liralil, Z.A.", "Zach Liralil", "Zacharias LIRALIL", "Liralil Zacharias", "Dr. Zacharias Liralil", "Zacharias Liralel"], ["Isabella Liralil", "Liralil, Isabella", "Liralil I.", "Bella Liralil"], ["Vincent Liralil", "VG Liralil", "Liralil, V.G.", "Vnicent Liralil"], ["Josefina van Monedand", "van Monedand, J.C.", "Pepa van Monedand"], ["Ursula Kusipon"], ["Elizabeth Vonesant"]]
ORGS = [
    ["Laboratory of Urban Statistics, Vobavirmoor", "LUS Vobavirmoor", "Lab. of Urban Statistics, Vobavirmoor", "Urban Statistics Laboratory, Vobavirmoor", "The Vobavirmoor Urban Statistics Laboratory", "LABORATORY OF URBAN STATISTICS, VOBAVIRMOOR", "Laboratory of Urban Statistics (Vobavirmoor)", "Laboratory of Urban Sttatistics, Vobavirmoor", "Lab. Urban Stat., Vobavirmoor", "Laboratory for Urban Statistics, Vobavirmoor"],
    ["Laboratory of Urban Archives, Vobavirmoor", "LUA Vobavirmoor"], ["Laboratory of Urban Statistics, Docivandal"], ["Centre of Rural Agronomy, Docivandal", "Ctr. of Rural Agronomy, Docivandal"],
]


@pytest.mark.parametrize("kind,groups,same", [("author", PERSONS, names.same_person), ("affiliation", ORGS, names.same_organisation)])
def test_pairs_and_clusters(spark, kind, groups, same):
    for g in groups:
        for h in groups:
            if g is not h:
                whole = [x for x in g if len(names.person_tokens(x)[0]) > 1] if kind == "author" else g
                assert all(same(a, b) is None for a in whole for b in h if kind != "author" or len(names.person_tokens(b)[0]) > 1)
    rows = [(kind, n, 5 if k == 0 else 1) for g in groups for k, n in enumerate(g)]
    linked = names.link(spark.createDataFrame(rows, "kind string, name string, n long"))
    got = defaultdict(set)
    for r in linked.collect():
        got[r.cluster].add(r.name)
    assert {frozenset(x) for x in got.values()} == {frozenset(g) for g in groups}
    pairs = names.spelling_pairs(linked).collect()
    assert len(pairs) == sum(len(g) * (len(g) - 1) // 2 for g in groups) and all(p.name_a < p.name_b for p in pairs)


def test_measures():
    assert names.soundex("robert") == names.soundex("rupert") == "r163" and names.soundex("tymczak") == "t522"
    assert round(names.jaro_winkler("martha", "marhta"), 3) == 0.961 and names.jaro_winkler("", "a") == 0.0
    assert names.one_edit("abcd", "abdc") and names.one_edit("abcd", "abd") and not names.one_edit("abcd", "badc")
    assert names.same_word("maggie", "margaret") == 0 and names.same_word("metrology", "metallurgy") is None


def test_one_edit_against_brute_force():
    import itertools
    import random

    random.seed(1)

    def near(a):
        out = {a}
        for i in range(len(a) + 1):
            out |= {a[:i] + c + a[i:] for c in "ab"} | {a[:i] + a[i + 1 :]} | {a[:i] + c + a[i + 1 :] for c in "ab" if i < len(a)}
            if i + 1 < len(a):
                out.add(a[:i] + a[i + 1] + a[i] + a[i + 2 :])
        return out

    words = ["".join(w) for n in range(5) for w in itertools.product("ab", repeat=n)]
    for a in words:
        close = near(a)
        for b in words:
            assert names.one_edit(a, b) == (b in close), (a, b)


def test_a_common_surname_gives_no_quadratic_block():
    """Whole names of one surname and one initial meet only where both words sound alike."""
    from collections import Counter

    given = ["martin", "mabel", "moritz", "mildred", "magnus", "mercedes", "mustafa", "melchior", "monique", "maxim"]
    met = Counter(b for g in given for b, role in names.blocks("author", f"{g.capitalize()} Liralil") if role == "both")
    assert max(met.values()) <= 2
    assert {r for _, r in names.blocks("author", "M. Liralil")} == {"short"}


def test_blocks_meet_for_every_typo():
    """Two spellings of which one has a typo in one word share a block."""
    import random

    random.seed(4)
    for _ in range(3000):
        words = ["".join(random.choice("abdeiklmnorstuv") for _ in range(random.randint(4, 9))) for _ in range(random.choice([2, 3]))]
        k = random.randrange(len(words))
        w = list(words[k])
        at = random.randrange(len(w))
        w[at : at + 1] = random.choice([[random.choice("aeiouklm")], [w[at], random.choice("aeiouklm")], []])
        if len(w) < 4:
            continue
        other = [*words[:k], "".join(w), *words[k + 1 :]]
        for kind in ("author", "affiliation"):
            a, b = ({x for x, role in names.blocks(kind, " ".join(x.capitalize() for x in n)) if role == "both"} for n in (words, other))
            assert a & b, (kind, words, other)
