from collections import defaultdict

from helpers import plain, write_tables
from quirefold.llm.queries import QUERIES


def test_repeated_lines(spark, tmp_path):
    docs = [{"doc_id": k, "source": "s" if k < 12 else None, "text": "x"} for k in range(20)]
    noise = "Tell a colleague about Northford Gazette {} | Save for later"
    pages = []
    for k in range(20):
        line = noise.format(k)
        line = line.upper() if k == 1 else line.replace("colleague", "co1league") if k == 2 else line.replace("later", "lafer") if k == 3 else "  *" + line if k == 4 else line
        pages.append({"id": 100 + k, "document_id": k, "page_num": 0, "header_text": f"Own header of document {chr(97 + k) * 5}", "footer_text": line if k % 2 else None, "body_text": f"[FIGURE_000]\nThe body of {chr(97 + k) * 9} goes on\n" + ("" if k % 2 else line) + f"\np. {k}\nrare five times here now" * (k < 5)})
    pages.append({"id": 999, "document_id": 77, "page_num": 0, "body_text": noise.format(1)})
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, page_contents=pages * 2)
    want = sorted((100 + k, "footer_text", 0) if k % 2 else (100 + k, "body_text", 2) for k in range(12))
    got = plain(QUERIES["p7_found"](spark, folder).collect())
    assert [g for g in got if g in want] == want
    assert [g for g in got if g not in want] == []
    cleaned = {r.id: r for r in QUERIES["p7_cleaned"](spark, folder).collect()}
    assert "colleague" not in (cleaned[106].body_text or "") and "Own header" in cleaned[106].header_text and cleaned[112].body_text == pages[12]["body_text"]


def test_counts_against_brute_force(spark, tmp_path):
    import random
    import re

    random.seed(3)
    lines = ["".join(random.choice("abcdefghij klmnop") for _ in range(40)) for _ in range(12)]
    docs = [{"doc_id": k, "source": f"s{k % 3}"} for k in range(60)]
    pages = [{"id": k, "document_id": random.randrange(70), "page_num": 0, "body_text": "\n".join(random.sample(lines, 4)), "header_text": random.choice(lines), "footer_text": ""} for k in range(90)]
    seen = defaultdict(set)
    key = lambda x: re.sub(r"\s", "", x)
    for p in pages:
        if p["document_id"] < 60:
            for x in p["body_text"].split("\n") + [p["header_text"]]:
                seen[p["document_id"] % 3, key(x)].add(p["document_id"])
    want = [(p["id"], f, n) for p in pages if p["document_id"] < 60 for f in ("body_text", "header_text") for n, x in enumerate(p[f].split("\n")) if len(seen[p["document_id"] % 3, key(x)]) >= 6]
    got = plain(QUERIES["p7_found"](spark, write_tables(spark, tmp_path, documents=docs, page_contents=pages)).collect())
    assert got == sorted(want) and want


def _pages(lines):
    """A document of one source for each line."""
    return [{"doc_id": k, "source": "s"} for k in range(len(lines))], [{"id": k, "document_id": k, "page_num": 0, "body_text": f"{chr(97 + k) * 30}\n{x}"} for k, x in enumerate(lines)]


def test_two_edits_in_a_short_line(spark, tmp_path):
    docs, pages = _pages(["printat tablekpwz"] * 6 + ["prinxat tabxekpwz"])
    got = plain(QUERIES["p7_found"](spark, write_tables(spark, tmp_path, documents=docs, page_contents=pages)).collect())
    assert got == [(k, "body_text", 1) for k in range(7)]


def test_heads_in_a_chain_are_one_line(spark, tmp_path):
    docs, pages = _pages(["printat tablekpwq"] * 4 + ["prinkat tajlekpwq"] * 5 + ["prinkat tajzekqwq"] * 6)
    got = plain(QUERIES["p7_found"](spark, write_tables(spark, tmp_path, documents=docs, page_contents=pages)).collect())
    assert got == [(k, "body_text", 1) for k in range(15)]


def test_every_line_within_the_allowed_edits_is_found(spark, tmp_path):
    import random

    from quirefold.llm import boilerplate

    random.seed(11)
    letters = "abcdefghijklmnopqrstuvwxyz가나다라"
    lines, of = [], []
    for size in (14, 16, 17, 20, 32, 33, 34, 49, 50, 67, 84, 100, 150, 210):
        head = "".join(random.choice(letters) for _ in range(size))
        copies = [head] * 6
        for _ in range(8):
            x = list(head)
            for _ in range(boilerplate.allowed_edits(size)):
                at, kind = random.randrange(len(x)), random.randrange(3)
                x[at : at + 1] = [[random.choice(letters)], [x[at], random.choice(letters)], []][kind]
            copies.append("".join(x))
        lines += copies
        of += [(size, k) for k in range(len(copies))]
    docs = [{"doc_id": k, "source": "s"} for k in range(len(lines))]
    pages = [{"id": k, "document_id": k, "page_num": 0, "body_text": x} for k, x in enumerate(lines)]
    got = {r.page_id for r in QUERIES["p7_found"](spark, write_tables(spark, tmp_path, documents=docs, page_contents=pages)).collect()}
    assert [of[k] for k in range(len(lines)) if k not in got and of[k][0] >= boilerplate.LONG] == []


def test_filter_holds_all_and_little_else(spark):
    import numpy as np
    from quirefold.llm import filters

    rng = np.random.default_rng(1)
    held = rng.integers(-(2**63), 2**63 - 1, 3000, dtype=np.int64)
    bits = filters.bit_filter(spark.createDataFrame([(int(x),) for x in [*held, 0, -1]], "v long"), "v")
    assert filters.in_filter(bits, np.array([*held, 0, -1])).all()
    assert filters.in_filter(bits, rng.integers(-(2**63), 2**63 - 1, 100_000, dtype=np.int64)).mean() < 0.001


def test_scattered_readings_that_two_documents_share_each(spark, tmp_path):
    docs, pages = _pages(["printat tablekpwq"] * 2 + ["prinkat tajlekpwq"] * 2 + ["printaj tablekpzq"] * 2)
    got = plain(QUERIES["p7_found"](spark, write_tables(spark, tmp_path, documents=docs, page_contents=pages)).collect())
    assert got == [(k, "body_text", 1) for k in range(6)]


def test_filters_stay_sparse(spark):
    """A filter for many values lets few others pass: with the fixed size it had, one in five."""
    import numpy as np
    from pyspark.sql import functions as F
    from quirefold.llm import filters

    n = 4_000_000
    bits = filters.bit_filter(spark.range(n).select(F.xxhash64("id").alias("h")), "h", n)
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 100_000, dtype=np.int64)
    held = np.array([r.h for r in spark.range(1000).select(F.xxhash64("id").alias("h")).collect()])
    assert filters.in_filter(bits, held).all() and filters.in_filter(bits, others).mean() < 0.05


def test_heads_are_read_without_moving_pages(spark, tmp_path):
    from quirefold.llm import boilerplate
    from quirefold.plans.catalog import docs, pages
    from quirefold.session import cut

    line = "Tell a colleague about Northford Gazette"
    d = write_tables(spark, tmp_path, documents=[{"doc_id": k, "source": "s"} for k in range(4)], page_contents=[{"id": k, "document_id": k, "page_num": 0, "body_text": f"{line}\nown line {'xyzk'[k] * 9}"} for k in range(4)])
    shared = cut(boilerplate.shared_lines(boilerplate.hashed_lines(pages(spark, d)), docs(spark, d)))
    keys = boilerplate.head_keys(pages(spark, d), shared)
    assert [(r.source, r.n, r.head_key) for r in keys.collect()] == [("s", 4, "tellacolleagueaboutnorthfordgazette")]
    assert "LeftSemi" not in keys._jdf.queryExecution().executedPlan().toString()
