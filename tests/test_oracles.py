"""Every registered query against its SQL, over the whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import assert_same, duck


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    sql = duck(sf_dir).execute(oracle_sql()[name]).df()
    assert len(sql) > 0
    assert_same(queries()[name](spark, sf_dir).toPandas(), sql)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
