"""Every query against its SQL, and the contract of the entry file."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


# Text operators have tests of their own.
OWN = sorted(name for m in entry.MODULES for name in m.QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert not oracle.compare(entry.queries()[name](spark, SF_DIR), con,
                              entry.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())
