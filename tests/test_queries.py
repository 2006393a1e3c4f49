"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, oracle_connection
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", queries())
def test_query(spark, connection, name):
    outcome, rows = compare(spark, connection, SF_DIR, name)
    assert outcome == ("equal" if name in oracle_sql() else "rows only")
    assert rows > 0


def test_entry(spark):
    rows = {row["split"]: row["rows"] for row in entry(spark).collect()}
    assert rows == {"train": 151, "validation": 19, "test": 19}


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
