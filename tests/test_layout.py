"""Layout operators against brute force, and that words stay in the partition of their document."""

import random

import pytest
from helpers import write_tables

from quirefold.operators import layout
from quirefold.plans import boxes

SCHEMA = "doc_id long, page_num int, word_no int, text string, x0 double, x1 double, top double, bottom double"


def _gap(page, width):
    lines = {}
    for x0, x1, top in page:
        held = lines.setdefault(None if top is None else round(top / 3) * 3, set())
        if x0 is not None and x1 is not None:
            a, b = (max(0, min(199, int(x / width * 200))) for x in sorted((x0, x1)))
            held.update(range(a, b + 1))
    cover = [sum(b in held for held in lines.values()) for b in range(200)]
    side = (sum(cover[:70]) + sum(cover[130:])) / (len(lines) * 140)
    thin = [b for b in range(70, 130) if side > 0.10 and cover[b] / len(lines) < min(0.25, side * 0.30)]
    runs = []
    for b in thin:
        if runs and runs[-1][0] + runs[-1][1] == b:
            runs[-1][1] += 1
        else:
            runs.append([b, 1])
    best = max(runs, key=lambda r: (r[1], -r[0]), default=[0, 0])
    return tuple(best) if best[1] >= 3 else None


def test_column_gap_against_brute_force(spark):
    rng, rows = random.Random(5), []
    for doc in range(60):
        for page in range(rng.choice((1, 3))):
            split = rng.choice((250.0, 300.0, 340.0))
            for k in range(rng.randint(1, 60)):
                x0 = rng.choice((rng.uniform(-20, split - 60), rng.uniform(split, 600), rng.uniform(0, 600) if doc % 3 else 20.0))
                rows.append((doc, page, k, "w", x0, x0 + rng.uniform(-5, 60), rng.uniform(0, 90), 0.0))
    rows += [(70, 0, 0, "w", None, 10.0, 3.0, 4.0), (71, 0, 0, "w", 10.0, 600.0, None, 4.0), (None, 0, 0, "w", 10.0, 20.0, 3.0, 4.0)]
    rng.shuffle(rows)
    pages = {}
    for r in rows:
        if r[0] is not None:
            pages.setdefault(r[:2], []).append((r[4], r[5], r[6]))
    want = {k: g for k, p in pages.items() if (g := _gap(p, 612.0))}
    got = {(r.doc_id, r.page_num): (r.run_start, r.run_len) for r in layout.column_gap(spark.createDataFrame(rows, SCHEMA), 612.0).collect()}
    assert got == want and len(want) > 10


@pytest.mark.parametrize("name", ["column_gap", "longest_gap_run"])
def test_no_box_is_shuffled(spark, tmp_path, name):
    """The texts go to their documents' partitions; the boxes made from them are grouped there."""
    text = " ".join(f"w{k}" for k in range(900))
    d = write_tables(spark, tmp_path, documents=[{"doc_id": k % 7, "text": text} for k in range(20)] + [{"doc_id": None, "text": text}, {"doc_id": 9}])
    df = boxes.QUERIES[name](spark, d)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {(r.doc_id, r.page_num) for r in df.collect()} == {(k, p) for k in range(7) for p in range(3)}


def test_composed_pages_are_made_many_at_a_time(spark, tmp_path):
    """Pages with and without words, assets, documents or numbers, each once; no group of a page starts Python anew."""
    text = " ".join(f"w{k}" for k in range(900))
    asset = {"asset_type": "TABLE", "bbox_x0": 40.0, "bbox_x1": 300.0, "bbox_y0": 300.0, "bbox_y1": 350.0}
    held = [asset | {"id": k, "document_id": doc, "page_num": page, "ref_tag": f"[TABLE_00{k}]"} for k, (doc, page) in enumerate([(1, 0), (1, 1), (5, 0), (None, 0), (None, None)])]
    d = write_tables(spark, tmp_path, documents=[{"doc_id": 1, "text": text}, {"doc_id": 2, "text": "one two"}, {"doc_id": None, "text": "lost words"}], document_assets=held)
    df = boxes.QUERIES["page_text_with_assets"](spark, d)
    rows = {(r.doc_id, r.page_num): r.text for r in df.collect()}
    assert set(rows) == {(1, 0), (1, 1), (1, 2), (2, 0), (5, 0), (None, 0), (None, None)} and df.count() == 7
    assert rows[5, 0] == "[TABLE_002]" and rows[None, None] == "[TABLE_004]" and rows[2, 0] == "one two" and "lost words" in rows[None, 0] and "[TABLE_003]" in rows[None, 0]
    assert "[TABLE_000]" in rows[1, 0] and "[TABLE_001]" in rows[1, 1]
    assert "FlatMap" not in df._jdf.queryExecution().executedPlan().toString()


def test_zones_of_assets_move_no_box(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(900))
    held = [{"id": k, "document_id": 1, "page_num": 0, "bbox_y0": y, "bbox_y1": y + 50} for k, y in enumerate((200.0, 400.0))]
    df = boxes.QUERIES["asset_to_zone"](spark, write_tables(spark, tmp_path, documents=[{"doc_id": 1, "text": text}], document_assets=held))
    assert {(r.zone_no, r.n_words) for r in df.collect()} == {(0, 80), (1, 88), (2, 176)}
    assert "hashpartitioning(doc_id" in df._jdf.queryExecution().executedPlan().toString() and "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
