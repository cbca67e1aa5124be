import pytest
from oracle import SF, rows, sql_rows

import __spark_entry__ as entry
from ledgerloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert rows(catalogue.queries()[name](spark, SF).toPandas()) == sql_rows(catalogue.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
