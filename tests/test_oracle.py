"""Every registered query against DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from heightline.plans import catalog

from . import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = oracle.spark_rows(entry.queries()[name](spark, SF))
    assert got == oracle.duck_rows(duck, entry.oracle_sql()[name])


def test_every_query_has_rows(duck):
    empty = [n for n, sql in catalog.ORACLE.items() if not oracle.duck_rows(duck, sql)[1]]
    assert empty == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
