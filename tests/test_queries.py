"""Every registered query against its SQL equivalent over whole tables."""

from __future__ import annotations

import pytest

from shopstar.oracle import ORACLE
from shopstar.queries import QUERIES
from tests.compare import both, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, key):
    ours, theirs = both(spark, con, sf_dir, key)
    assert ours[0] == theirs[0]
    assert len(ours[1]) > 0
    assert ours[1] == theirs[1]
