"""Every registered query beside its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from plaudit.catalog.queries import QUERIES  # noqa: E402
from compare import differences, oracle_connection  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "frequency"]
    assert entry.entry(spark).count() == 10


def test_sql_is_given_for_known_queries_only():
    assert set(ORACLE) <= set(entry.queries()) and set(QUERIES) <= set(ORACLE)
