"""The registered queries against DuckDB where they have SQL, and the whole results of the rest."""

import re
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest
from oracle import database, differences

from tarnworks.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql_twin(spark, name):
    query, sql = QUERIES[name]
    assert differences(query(spark, FOLDER), database(FOLDER), sql) == []


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql and n != "op1_nearest"])
def test_every_document_has_its_row(spark, name):
    ids = [r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{FOLDER}/documents.parquet' ORDER BY 1").fetchall()]
    assert sorted(r.doc_id for r in QUERIES[name][0](spark, FOLDER).select("doc_id").collect()) == ids
