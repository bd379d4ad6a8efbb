"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import difference

import __spark_entry__ as contract
from touchline.plans.catalog import QUERIES
from touchline.plans.oracle import ORACLE


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == ""


def test_entry_has_rows(spark, sf_dir):
    card = contract.entry(spark)
    assert card.count() > 0
    total = card.selectExpr("possession_a + possession_b AS total").distinct().collect()
    assert all(abs(r.total - 100) < 1e-9 for r in total)
