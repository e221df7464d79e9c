from datetime import datetime

from helpers import frame, plain, write_tables
from quirefold.operators import orphans
from quirefold.plans.preparation import QUERIES

DAY = orphans.DAY_US


def test_absent_and_late(spark):
    children = spark.createDataFrame(
        [
            ("a", 1, 10, 5 * DAY), ("a", 2, 99, 5 * DAY), ("a", 3, None, 5 * DAY), ("b", 4, 10, 2 * DAY), ("b", 5, 10, None), ("b", 6, 99, None),
            ("b", 4, 10, 2 * DAY), ("b", 7, 11, 0), ("b", 8, 10, 4 * DAY - 1), ("b", 9, 10, 4 * DAY),
        ],
        "table_name string, row_id long, document_id long, row_us long",
    )
    parents = spark.createDataFrame([(10, 5 * DAY), (11, None), (12, 0)], "document_id long, created_us long")
    got = orphans.orphan_rows(children, parents).select("table_name", "row_id", "reason")
    assert plain(got.collect()) == [("a", 2, "absent"), ("b", 4, "late"), ("b", 6, "absent"), ("b", 8, "late")]


def test_hot_key_against_brute_force(spark):
    import random

    random.seed(1)
    parents = [(k, random.choice([None, random.randrange(10) * DAY])) for k in range(40)]
    rows = [("t", k, 7 if k % 3 == 0 else random.randrange(60), random.choice([None, random.randrange(10) * DAY])) for k in range(3000)]
    known = dict(parents)
    want = []
    for t, i, d, at in rows:
        if d not in known:
            want.append((t, i, "absent"))
        elif at is not None and known[d] is not None and known[d] - at > DAY:
            want.append((t, i, "late"))
    got = orphans.orphan_rows(spark.createDataFrame(rows, "table_name string, row_id long, document_id long, row_us long"), spark.createDataFrame(parents, "document_id long, created_us long"))
    assert plain(got.select("table_name", "row_id", "reason").collect()) == sorted(want)


def test_query_reads_log_times(spark, tmp_path):
    docs = [{"doc_id": 1, "created_at": "2021-06-24 12:00:00", "worker": "w"}]
    logs = [{"id": 1, "document_id": 1, "logged_at": "2021-06-22 12:00:00", "worker": "w"}, {"id": 2, "document_id": 1, "logged_at": "N/A"}, {"id": 3, "document_id": 5, "logged_at": None}]
    pages = [{"id": 4, "document_id": 1, "created_at": datetime(2021, 6, 23, 13)}, {"id": 5, "document_id": 1, "created_at": datetime(2021, 6, 1)}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, process_logs=logs, page_contents=pages, workers=[{"worker": "w", "time_zone": "UTC", "date_order": "YMD"}])
    assert plain(QUERIES["p2_found"](spark, folder).collect()) == [("page_contents", 5, "late"), ("process_logs", 1, "late"), ("process_logs", 3, "absent")]
    counts = {(r["table_name"], r["month"], r["reason"]): r["n_rows"] for r in QUERIES["p2_orphan_counts"](spark, folder).collect()}
    assert counts == {("page_contents", "2021-06", "late"): 1, ("process_logs", "2021-06", "late"): 1, ("process_logs", None, "absent"): 1}
    assert frame(spark, "documents", []).count() == 0


def test_months_are_those_of_utc(spark):
    rows = spark.createDataFrame([("process_logs", 1, 1_704_067_200_000_000, "absent"), ("process_logs", 2, None, "absent"), ("process_logs", 3, -1, "late")], "table_name string, row_id long, row_us long, reason string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r["month"] for r in orphans.orphan_counts(rows).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {"2024-01", None, "1969-12"}
