"""Every registered query against DuckDB on the smallest tables."""

from pathlib import Path

import pytest
from oracle import database, differences

from tarnworks.plans import registered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, db, name):
    query, sql = registered()[name]
    if sql is None:
        assert query(spark, FOLDER).count() > 0
    else:
        assert differences(query(spark, FOLDER), db, sql) == []
