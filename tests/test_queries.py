"""Every registered query beside its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import EMPTY, connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, TWINS = entry.queries(), entry.oracle_sql()
MODELS = {n for n in QUERIES if n not in TWINS} - {"fixed_sample", "schema_profile"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, name, QUERIES[name], TWINS.get(name), FOLDER) in (None, EMPTY)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
