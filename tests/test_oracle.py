"""Every query that has SQL gives the SQL's rows on the smallest data folder."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no data folder")


@pytest.fixture(scope="module")
def connection():
    import oracle

    return oracle.connect(FOLDER)


def _names():
    from quirefold.plans import preparation, reference

    return sorted({**reference.SQL, **preparation.SQL})


@pytest.mark.parametrize("name", _names())
def test_same_rows(spark, connection, name):
    import oracle

    from quirefold.plans import preparation, reference

    said = oracle.compare(spark, connection, {**reference.QUERIES, **preparation.QUERIES}[name], {**reference.SQL, **preparation.SQL}[name], FOLDER)
    assert said.startswith("ok"), said


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
