import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from helpers import frame, null_rows, plain, write_tables
from quirefold.operators import timestamps
from quirefold.plans.preparation import QUERIES

WORKERS = [
    {"worker": "se", "time_zone": "Asia/Seoul", "date_order": "YMD"},
    {"worker": "be", "time_zone": "Europe/Berlin", "date_order": "DMY"},
    {"worker": "ny", "time_zone": "America/New_York", "date_order": "MDY"},
    {"worker": "ut", "time_zone": None, "date_order": "YMD"},
]


def us(*a, zone="UTC", fold=0):
    return int(datetime(*a, tzinfo=ZoneInfo(zone), fold=fold).timestamp() * 1_000_000)


CASES = [
    ("2021-06-24 15:08:57", "se", us(2021, 6, 24, 15, 8, 57, zone="Asia/Seoul")),
    ("2021-06-24T15:08:57Z", "se", us(2021, 6, 24, 15, 8, 57)),
    ("2021-06-24T15:08:57.5+09:00", "ut", us(2021, 6, 24, 6, 8, 57, 500000)),
    ("2021-06-24 15:08:57,123 -0400", "ut", us(2021, 6, 24, 19, 8, 57, 123000)),
    ("20210624T150857Z", "ny", us(2021, 6, 24, 15, 8, 57)),
    ("20210624150857", "ny", us(2021, 6, 24, 15, 8, 57, zone="America/New_York")),
    ("1619786028678", "ny", 1619786028678000),
    ("1623344632", "ny", 1623344632000000),
    ("28/03/2021 01:19", "be", us(2021, 3, 28, 1, 19, zone="Europe/Berlin")),
    ("7/27/2021 5:45:03 AM", "ny", us(2021, 7, 27, 5, 45, 3, zone="America/New_York")),
    ("7/27/2021 12:45:03 PM", "ny", us(2021, 7, 27, 12, 45, 3, zone="America/New_York")),
    ("2022/12/04 02:15:34", "ut", us(2022, 12, 4, 2, 15, 34)),
    ("23.04.23 20:11", "ny", us(2023, 4, 23, 20, 11, zone="America/New_York")),
    ("30.01.2020 12:23:16", "se", us(2020, 1, 30, 12, 23, 16, zone="Asia/Seoul")),
    ("2021. 8. 21. 오전 6:28:21", "se", us(2021, 8, 21, 6, 28, 21, zone="Asia/Seoul")),
    ("2021년 8월 26일 오후 3시 37분", "se", us(2021, 8, 26, 15, 37, zone="Asia/Seoul")),
    ("2021년 8월 26일 오후 12시 7분", "se", us(2021, 8, 26, 12, 7, zone="Asia/Seoul")),
    ("September 15, 2020 6:10 PM", "be", us(2020, 9, 15, 18, 10, zone="Europe/Berlin")),
    ("13. Februar 2020, 09:29 Uhr", "be", us(2020, 2, 13, 9, 29, zone="Europe/Berlin")),
    ("28. März 2020, 00:52 Uhr", "ut", us(2020, 3, 28, 0, 52)),
    ("Tue, 24 Aug 2021 22:29:15 +0100", "ut", us(2021, 8, 24, 21, 29, 15)),
    ("2021-01-10T05:23:33[Europe/Berlin]", "ut", us(2021, 1, 10, 5, 23, 33, zone="Europe/Berlin")),
    ("2019-08-21 09:17:50 Australia/Sydney", "ut", us(2019, 8, 21, 9, 17, 50, zone="Australia/Sydney")),
    ("2021-10-31 02:30:00", "be", us(2021, 10, 31, 2, 30, zone="Europe/Berlin")),  # twice: the first
    ("2021-10-31 02:30:00 CET", "be", us(2021, 10, 31, 2, 30, zone="Europe/Berlin", fold=1)),
    ("2021-10-31 02:30:00 CEST", "be", us(2021, 10, 31, 2, 30, zone="Europe/Berlin")),
    ("2021-03-28 02:30:00", "be", us(2021, 3, 28, 1, 30)),  # in no interval: the offset before the gap
    ("2021-11-07 01:30:00 EST", "ny", us(2021, 11, 7, 6, 30)),
    (None, "se", None), ("", "se", None), ("N/A", "se", None), ("-", "se", None), ("0000-00-00 00:00:00", "se", None), ("2021-02-30 10:00:00", "se", None), ("2021-02-03 25:00:00", "se", None),
    ("2021-06-24 15:08:57", "nobody", us(2021, 6, 24, 15, 8, 57)), ("2021-06-24 15:08:57", None, us(2021, 6, 24, 15, 8, 57)),
    ("1890-07-01 12:00:00", "ny", us(1890, 7, 1, 12, zone="America/New_York")), ("1890-07-01 12:00:00", "ut", us(1890, 7, 1, 12)),
    ("1850-07-01 12:00:00", "be", us(1850, 7, 1, 12, zone="Europe/Berlin")), ("1965-07-01 12:00:00", "ny", us(1965, 7, 1, 12, zone="America/New_York")),
    ("1945-06-01 12:00:00", "be", us(1945, 6, 1, 12, zone="Europe/Berlin")), ("2045-07-01 12:00:00", "ny", us(2045, 7, 1, 12, zone="America/New_York")),
    ("2045-01-01 12:00:00", "ny", us(2045, 1, 1, 12, zone="America/New_York")), ("2400-07-01 12:00:00", "be", us(2400, 7, 1, 12, zone="Europe/Berlin")),
    ("9998-12-31 12:00:00", "be", us(9998, 12, 31, 12, zone="Europe/Berlin")), ("1965-07-01 12:00:00", None, us(1965, 7, 1, 12)),
    ("2021-06-24 15:08:57 Nowhere/Place", "se", None), ("2021-06-24 15:08:57 XYZ", "se", None),
]


def test_formats(spark):
    logs = frame(spark, "process_logs", [{"id": k, "logged_at": t, "worker": w} for k, (t, w, _) in enumerate(CASES)])
    out = timestamps.with_instants(logs, {"logged_at": "us"}, frame(spark, "workers", WORKERS))
    got = {r["id"]: r["us"] for r in out.collect()}
    assert {CASES[k][:2]: got[k] for k in got} == {c[:2]: c[2] for c in CASES}
    assert out.columns == [*logs.columns, "us"]


def test_random_local_times_against_zoneinfo(spark):
    random.seed(5)
    zones = ["Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Kolkata", "Africa/Casablanca", "America/St_Johns"]
    workers = [{"worker": z, "time_zone": z, "date_order": "YMD"} for z in zones]
    cases = []
    for k in range(1500):
        begin, years = [(1990, 40), (1850, 400), (1900, 8000)][k % 3]
        t = datetime(begin, 1, 1) + timedelta(seconds=random.randrange(years * 365 * 86400))
        zone = random.choice(zones)
        utc = t.replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc)
        back = utc.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
        cases.append((k, t.isoformat(" "), zone, int(utc.timestamp()) * 1_000_000 if back == t else None))
    logs = frame(spark, "process_logs", [{"id": k, "logged_at": s, "worker": z} for k, s, z, _ in cases])
    got = {r["id"]: r["us"] for r in timestamps.with_instants(logs, {"logged_at": "us"}, frame(spark, "workers", workers)).select("id", "us").collect()}
    assert [k for k, _, _, want in cases if want is not None and got[k] != want] == []


def test_found_leaves_out_the_canonical_form_and_repeats(spark, tmp_path):
    logs = [{"id": 1, "logged_at": "2021-06-24T15:08:57Z", "worker": "se"}, {"id": 2, "logged_at": "2021-06-24 00:00:00", "worker": "se"}] * 2
    docs = [{"doc_id": 7, "created_at": "1623344632", "updated_at": None, "worker": "be"}]
    folder = write_tables(spark, tmp_path, clash=True, process_logs=logs, documents=docs, workers=WORKERS)
    assert plain(QUERIES["p4_found"](spark, folder).collect()) == [("documents", 7, "created_at", 1623344632000000), ("process_logs", 2, "logged_at", us(2021, 6, 24, zone="Asia/Seoul"))]


@pytest.mark.parametrize("rows", [{}, null_rows()], ids=["empty", "nulls"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_and_null_tables(spark, tmp_path, name, rows):
    folder = write_tables(spark, tmp_path, clash=True, **rows)
    assert QUERIES[name](spark, folder).collect() == []


def test_times_sort_by_their_instants(spark, tmp_path):
    from quirefold.plans.catalog import QUERIES as known

    docs = [{"doc_id": 1, "created_at": "2021-06-24 00:00:00", "worker": "se"}, {"doc_id": 2, "created_at": "1. Januar 2020, 00:10 Uhr", "worker": "be"}, {"doc_id": 3, "created_at": "1623344632"}, {"doc_id": 4}]
    folder = write_tables(spark, tmp_path, documents=docs, workers=WORKERS)
    assert [r[0] for r in known["all_docs"](spark, folder).collect()] == [1, 3, 2, 4]
