import json
from datetime import datetime

import pytest
from helpers import frame, plain, write_tables
from pyspark.sql import functions as F
from quirefold.operators import classify, metrics, state
from quirefold.operators.components import connected_components
from quirefold.plans import reference
from quirefold.session import ensure_checkpoint_dir
from quirefold.sources import files, office
from quirefold.streaming.logs import run_once, windowed_counts


def test_scan_actions(spark):
    known = spark.createDataFrame([("a", "h1"), ("b", "h2")], "path string, hash string")
    scanned = spark.createDataFrame([("a", "h1"), ("b", "h9"), ("c", "h1"), ("d", "h3"), ("e", "h3"), ("f", None)], "path string, hash string")
    got = {r.path: r.action for r in state.scan_classify(scanned, known).collect()}
    assert got == {"a": "skip", "b": "requeue", "c": "skip", "d": "register", "e": "skip", "f": "error"}


def test_routing_matrix(spark):
    rows = [
        ("DIGITAL", "SINGLE_COLUMN", ["kor", "eng"], False, "DIGITAL_EXTRACT"), ("DIGITAL", "MULTI_COLUMN", ["eng"], True, "DIGITAL_EXTRACT_MULTI"),
        ("SCANNED", "SINGLE_COLUMN", ["eng"], False, "OCR_ENG"), ("SCANNED", "SINGLE_COLUMN", ["kor", "eng"], False, "OCR_KOR_ENG"), ("SCANNED", "SINGLE_COLUMN", ["kor", "eng", "jpn"], False, "OCR_JPN"),
        ("SCANNED", "MULTI_COLUMN", ["kor", "eng"], False, "OCR_MULTI_COL"), ("SCANNED", "SINGLE_COLUMN", ["eng"], True, "OCR_FORMULA"), ("SCANNED", "MULTI_COLUMN", ["eng"], True, "OCR_MULTI_FORMULA"),
        ("SCANNED", "MULTI_COLUMN", ["kor", "eng"], True, "OCR_MULTI_COL"), ("DOCX", "SINGLE_COLUMN", ["eng"], False, "DOCX_EXTRACT"), ("PPTX", "MULTI_COLUMN", ["eng"], True, "PPTX_EXTRACT"),
    ]
    df = spark.createDataFrame(rows, "s string, l string, g array<string>, f boolean, want string")
    got = df.select("want", classify.select_strategy(F.col("s"), F.col("l"), F.col("g"), F.col("f")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    params = classify.strategy_params(spark.createDataFrame([("OCR_ENG",), ("?",), (None,)], "k string"), "k").collect()
    assert sorted((r.k or "", r.lang, r.psm) for r in params) == [("", "kor+eng", 6), ("?", "kor+eng", 6), ("OCR_ENG", "eng", 6)]


def test_gate(spark):
    df = spark.createDataFrame([("ab", 1.0), ("abcde " * 20, 0.49), ("abcde " * 20, 0.5), ("abcde\n\n" * 20, 1.0)], "t string, s double")
    got = [tuple(r[0]) for r in df.select(classify.gate(F.col("t"), F.col("s"))).collect()]
    assert [(g[0], g[1], g[2]) for g in got] == [("REVIEW_REQUIRED", "length", 2), ("REVIEW_REQUIRED", "quality", 100), ("TEXT_READY", None, 100), ("TEXT_READY", None, 100)]
    assert got[3][3] == 20


def test_resets_and_events(spark):
    docs = frame(spark, "documents", [{"doc_id": 1, "status": "FAILED", "error_message": "x"}, {"doc_id": 2, "status": "NEW", "error_message": "y"}, {"doc_id": 3, "status": None, "error_message": "z"}])
    assert plain(state.reset_for_retry(docs).select("doc_id", F.coalesce("status", F.lit("-")), F.coalesce("error_message", F.lit("-"))).collect()) == [(1, "NEW", "-"), (2, "NEW", "y"), (3, "-", "z")]
    events = spark.createDataFrame([(1, 7, "SCAN", "SUCCESS", None), (2, 7, "OCR", "FAILURE", "bad"), (3, 7, "INDEXING", "SUCCESS", None), (3, 7, "INDEXING", "SUCCESS", None), (4, None, "OCR", "FAILURE", "q")], "id long, document_id long, step string, result string, message string")
    assert [tuple(r) for r in state.fold_events(events).collect()] == [(7, "INDEXED", "INDEXING", "bad", 1, 3)]


def test_elapsed_is_clamped_and_needs_both(spark):
    rows = [(1, "ANALYZE", "SUCCESS", 100), (1, "INDEXING", "SUCCESS", 400), (2, "ANALYZE", "SUCCESS", 500), (2, "INDEXING", "SUCCESS", 100), (3, "ANALYZE", "SUCCESS", 5), (4, "INDEXING", "FAILURE", 9), (None, "ANALYZE", "SUCCESS", 1)]
    out = metrics.elapsed(spark.createDataFrame(rows, "document_id long, step string, result string, at_us long"))
    assert plain(out.collect()) == [(1, 300), (2, 0)]


def test_components_against_union_find(spark):
    import random

    random.seed(4)
    edges = [(str(random.randrange(300)), str(random.randrange(300))) for _ in range(220)] + [(str(1000 + k), str(1001 + k)) for k in range(40)] + [("5", "5")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {n: find(n) for n in parent}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    groups = lambda m: {frozenset(n for n in m if m[n] == c) for c in set(m.values())}
    assert groups(got) == groups(want)
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
    path = spark.createDataFrame([(f"{k:03d}", f"{k + 1:03d}") for k in range(60)], "a string, b string")
    with pytest.raises(RuntimeError, match="after 1 rounds"):
        connected_components(path, rounds=1)


def test_office_round_trip(spark, tmp_path):
    made = office.make_docx(["  One ", "", "Two"], [["a", " b "], ["", ""]], {"p.png": b"x"})
    assert office.docx_parts(made) == ["One", "Two", "a | b"] and office.docx_pages(made) == 1
    assert office.office_images(made) == [("p.png", b"x")]
    assert office.pptx_slides(office.make_pptx([["A", "B"], []])) == ["A\nB", ""]
    html = "<html><style>p{}</style><p class='mso-x'>A&nbsp;&lt;b&gt;</p></html>".encode()
    rows = office.read_office(spark.createDataFrame([("a.docx", made), ("b.docx", html), ("c.docx", b"PK\x03\x04junk"), ("d.docx", None), ("e.pptx", office.make_pptx([["S1"], ["S2"]]))], "path string, content binary")).collect()
    by = {(r.path, r.page_num): (r.text, r.error is None) for r in rows}
    assert by["a.docx", 0] == ("One\n\nTwo\n\na | b", True) and by["b.docx", 0] == ("A <b>", True) and not by["d.docx", 0][1] and by["e.pptx", 1] == ("S2", True)


def test_files_batch_and_stream(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    for name in ("a.pdf", "b.PDF", "c.txt", "d.docx"):
        (folder / name).write_bytes(name.encode())
    assert sorted(r.path.rsplit("/", 1)[-1] for r in files.scan_files(spark, str(tmp_path / "in")).collect()) == ["a.pdf", "b.PDF", "d.docx"]
    assert files.scan_files(spark, str(tmp_path / "none")).count() == 0
    seen = []
    run_once(files.stream_files(spark, str(tmp_path / "in")), lambda df, _: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination(60)
    assert sum(seen) == 3


def test_windows_on_a_stream(spark, tmp_path):
    rows = [(1, "OCR", "SUCCESS", datetime(2024, 1, 1, 10, 5)), (1, "OCR", "SUCCESS", datetime(2024, 1, 1, 10, 5)), (2, "OCR", "SUCCESS", datetime(2024, 1, 1, 10, 50)), (3, "OCR", "FAILURE", datetime(2024, 1, 1, 11, 1))]
    spark.createDataFrame(rows, "id long, step string, result string, at timestamp").write.parquet(str(tmp_path / "e"))
    batch = windowed_counts(spark.read.parquet(str(tmp_path / "e")))
    assert sorted((r.step, r.result, r.n) for r in batch.collect()) == [("OCR", "FAILURE", 1), ("OCR", "SUCCESS", 2)]
    stream = windowed_counts(spark.readStream.schema("id long, step string, result string, at timestamp").parquet(str(tmp_path / "e")))
    query = stream.writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert query.exception() is None


def test_service_answers_and_retries(spark):
    good = {"success": True, "documents": [{"id": "1", "location": "l", "title": "t", "wordCount": 3}]}
    assert files.check_upload(200, good).location == "l"
    for code, body in ((403, {}), (500, {}), (200, {"success": False}), (200, {"success": True, "documents": []})):
        with pytest.raises(files.ServiceError):
            files.check_upload(code, body)
    files.check_embed(200, {"workspace": [{"documents": [{"docpath": "l"}]}]}, "l")
    with pytest.raises(files.ServiceError):
        files.check_embed(200, {"workspace": {"documents": []}}, "l")
    assert files.find_in_listing(json.dumps({"localFiles": {"items": [{"items": [{"id": "x"}]}]}}), "x") and not files.find_in_listing("junk", "x")
    waits, fails = [], []

    def broken():
        raise OSError("down")

    with pytest.raises(files.ServiceError, match="gave up"):
        files.retry(broken, "UPLOAD", waits.append, lambda: fails.append(1))
    assert waits == [60, 120] and len(fails) == 2
    df = spark.createDataFrame([(1, "text"), (2, "bad")], "doc_id long, text string")
    rows = files.upload_all(df, lambda: lambda i, t: (200, {"success": True, "documents": [{"location": i}]}) if t != "bad" else (500, {}), lambda _: None).collect()
    assert {r.doc_id: (r.location, r.error is None) for r in rows} == {1: ("1", True), 2: (None, False)}
    fixed = files.correct_texts(spark.createDataFrame([(1, "x" * 90), (2, "short"), (3, None)], "doc_id long, text string"), lambda: str.upper).collect()
    assert {r.doc_id: r.text for r in fixed} == {1: "X" * 90, 2: "short", 3: None}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1)], "k string, n int")
    files.sink_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().k == "a|b"
    assert files.sink_markdown(df) == "| k | n |\n| --- | --- |\n| a\\|b | 1 |"
    with pytest.raises(ValueError):
        files.sink_markdown(spark.range(5), 3)


@pytest.mark.parametrize("name", sorted(n for n in reference.QUERIES if n != "event_windows"))
def test_no_query_fails_on_empty_tables(spark, tmp_path_factory, name, request):
    folder = getattr(request.session, "_empty", None) or write_tables(spark, tmp_path_factory.mktemp("empty"))
    request.session._empty = folder
    reference.QUERIES[name](spark, folder).collect()


def test_plans_push_filters_and_prune_columns(spark, tmp_path):
    folder = write_tables(spark, tmp_path)
    plan = reference.QUERIES["failed_list"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,FAILED)" in plan and "text:string" not in plan
    assert "image_data" not in reference.QUERIES["assets_for_doc"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert ensure_checkpoint_dir(spark)
