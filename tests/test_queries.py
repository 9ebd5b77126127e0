"""Every registered query against its SQL form on the smallest tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tests import oracle  # noqa: E402

SF_DIR = os.environ.get("TIDEWATT_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.base.QUERIES, contract.base.SQL
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(spark, con, SF_DIR, name, QUERIES[name], SQL[name]) is None
