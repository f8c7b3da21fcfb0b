"""Every registered query gives what its SQL gives."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from parley.plans.oracles import ORACLES
from parley.plans.queries import QUERIES
from tests.comparing import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert {r["split"] for r in df.collect()} <= {"train", "validation", "test"}
