"""Every registered query with an oracle matches DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from daybook import registry
from tests.compare import compare, duck

BASE = "/root/testdata/sf0.001"
#: replay_3_days takes minutes (three daily jobs); tests/test_partitioned.py runs the job.
NAMES = [n for n in registry.QUERIES if n in E.oracle_sql() and n != "replay_3_days"]


@pytest.fixture(scope="module")
def con():
    return duck(BASE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], BASE, con)
    assert r["match"], r
    assert not r["type_mismatch"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rating" in df.columns


def test_every_query_has_oracle_or_is_listed():
    rows_only = {"context_json"}
    missing = set(registry.QUERIES) - set(E.oracle_sql()) - rows_only
    assert not missing, missing
