"""Queries against their SQL on the test tables."""

from pathlib import Path

import pytest

import oracle
from jobloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert not oracle.compare(found, oracle.connect(SF_DIR), queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_one_row_for_each(spark, name):
    table = "pages" if name == "op8_main_text" else "documents"
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert queries.QUERIES[name](spark, SF_DIR).count() == rows
