"""Every registered query against its SQL on DuckDB, whole results."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", entry.queries())
def test_query_equals_its_sql(spark, name):
    _, problem = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_one_row_per_experiment(spark):
    assert entry.entry(spark).count() == spark.read.parquet(f"{SF}/supplier.parquet").count()
