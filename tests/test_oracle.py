"""Every registered query against its DuckDB text."""

import pytest

from checks.compare import differences
from checks.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, sf_dir, name):
    assert differences(spark, sf_dir, name) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
