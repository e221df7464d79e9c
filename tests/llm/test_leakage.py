import random

import numpy as np
from helpers import plain, write_tables
from quirefold.llm.filters import FILTER_BITS
from quirefold.llm.leakage import GRAM, RUN, SPARE, WINDOW, Numbers, find_leaks, item_prints, leaks, text_prints, winnow, words_of
from quirefold.llm.queries import QUERIES


def brute(text, passage):
    """All places, word by word."""
    t, p = words_of(text), words_of(passage)
    for shift in range(-len(p) + 1, len(t)):
        same = [0 <= k + shift < len(t) and t[k + shift] == w for k, w in enumerate(p)]
        run = best = 0
        for s in same:
            run = run + 1 if s else 0
            best = max(best, run)
        if best >= RUN or shift >= 0 and shift + len(p) <= len(t) and len(p) - sum(same) <= len(p) // SPARE:
            return True
    return False


def met(items, text):
    """The items that leak into a text, by fingerprints, with a filter that passes everything."""
    numbers = Numbers()
    ids = numbers.of(text)
    known = {i: (p, *item_prints(p)) for i, p in ((i, numbers.of(p)) for i, p in items)}
    hashes, places = text_prints(ids, {k[1] for k in known.values()}, np.full(2**FILTER_BITS // 8, 255, np.uint8))
    out = set()
    for i, (passage, _, prints) in known.items():
        shifts = {int(p) - q for h, p in zip(hashes, places) for x, q in prints if x == h}
        if shifts and leaks(ids, passage, np.array(sorted(shifts))):
            out.add(i)
    return out


def test_against_brute_force():
    random.seed(7)
    words = [f"w{k}" for k in range(200)]
    items = [(k, " ".join(random.choice(words) for _ in range(random.choice([1, 3, 5, 7, 8, 10, 15, 16, 17, 18, 24, 31, 32, 40, 64])))) for k in range(40)]
    hits = 0
    for _ in range(400):
        passage = random.choice(items)[1].split()
        kind = random.random()
        if kind < 0.4:
            for at in random.sample(range(len(passage)), random.randint(0, len(passage) // 6)):
                passage[at] = random.choice(words)
        else:
            a = random.randrange(len(passage))
            passage = passage[a : a + random.choice([8, 12, 13, 14, 15, 20])]
        text = " ".join([random.choice(words) for _ in range(30)] + passage + [random.choice(words) for _ in range(30)])
        want = {i for i, p in items if brute(text, p)}
        assert met(items, text) == want
        hits += len(want)
    assert hits > 50


def test_winnowing_keeps_one_of_every_window():
    random.seed(2)
    for n in (1, 2, 3, 50):
        hashes = np.array([random.randrange(9) for _ in range(n)], np.uint64)
        kept = set(winnow(hashes).tolist())
        for a in range(max(1, n - WINDOW + 1)):
            assert kept & set(range(a, min(a + WINDOW, n)))
    assert GRAM + WINDOW - 1 == 6


def test_case_punctuation_spacing(spark, tmp_path):
    passage = "Each vessel from Larolis carries a coarse low-cost gauge, so the signal rarely precedes the seasonal corridor beside us."
    texts = ["x " + passage.upper().replace(" ", "\n  ").replace(",", " ;") + " y", " ".join(passage.split()[:13]), " ".join(passage.split()[2:16]), None, passage.replace("vessel", "kiln").replace("rarely", "often"), passage.replace("vessel", "kiln").replace("rarely", "often").replace("coarse", "new")]
    folder = write_tables(spark, tmp_path, documents=[{"doc_id": k, "text": t} for k, t in enumerate(texts)], eval_items=[{"item_id": 9, "passage": passage}, {"item_id": 8, "passage": None}])
    assert plain(QUERIES["p9_found"](spark, folder).collect()) == [(0, 9), (2, 9), (4, 9)]


def test_tables_against_brute_force(spark):
    """Items and documents of all lengths through the joins; one passage of 500 words; a phrase that most documents share."""
    random.seed(8)
    words = [f"w{k}" for k in range(150)]
    some = lambda n: " ".join(random.choice(words) for _ in range(n))
    phrase = some(9)
    items = [(k, some(n)) for k, n in enumerate((1, 3, 8, 13, 14, 16, 18, 20, 45, 500))] + [(20, f"{some(8)} {phrase} {some(8)}"), (21, None), (22, " "), (23, some(30))]
    items.append((24, items[-1][1]))
    docs = [(k, f"{some(5)} {phrase} {some(20)}") for k in range(60)]
    for k, (_, p) in enumerate(items):
        held = (p or "").split()
        docs += [(100 + k, f"{some(9)} {' '.join(held[len(held) // 3 :][:16])} {some(4)}"), (200 + k, f"{some(3)} {p} {some(3)}"), (200 + k, "")]
    docs += [(None, items[8][1]), (300, None)]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string"))
    want = {(d, i) for d, t in docs for i, p in items if t and p and words_of(p) and brute(t, p)}
    assert {tuple(r) for r in got.collect()} == want and len(want) > 20 and got.count() == len(want)
