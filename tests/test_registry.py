"""Every registered query gives what its SQL gives."""

import pytest

import __spark_entry__ as entry_point
from helpers import SF_DIR, canonical, duck
from streamrank.registry import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck().execute(ORACLES[name]).fetch_df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert canonical(found) == canonical(expected)


def test_entry(spark):
    result = entry_point.entry(spark)
    assert set(result.columns) == {"industry", "window_start", "pages"}
    assert result.count() > 0
