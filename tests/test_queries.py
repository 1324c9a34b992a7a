"""Every registered query against its SQL, and the entry file."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_file
from check import compare, connect
from prepframe.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    if key in ORACLES:
        assert compare(df, con, ORACLES[key]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_file.entry(spark).count() == 2
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())
