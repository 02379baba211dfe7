"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry_module
from chartdex.catalog import load
from tests.compare import problem

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    assert name in ORACLES
    assert problem(spark, duck, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "id"
    assert df.count() == 256


def test_index_ids_are_unique(spark, sf_dir):
    docs = QUERIES["patient_list_index"](spark, sf_dir)
    assert docs.count() == docs.select("id").distinct().count()
