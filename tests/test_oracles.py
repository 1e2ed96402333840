"""Every panel query against independent SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import oracles
from panelkit.plans import catalog
from tests.support import connect, difference

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = catalog.queries(), oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, db):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    assert difference(got, db.sql(SQL[name]).df()) is None
