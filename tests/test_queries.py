"""Every registered query against its check SQL on the smallest tables."""

import pytest
from checking import connect, spark_rows, sql_rows

from amihan.catalog.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"

# Known to be empty as specified: the net amount is never below in + out.
EMPTY = {"signal_layering"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", list(REGISTRY))
def test_query_equals_check_sql(spark, con, key):
    query = REGISTRY[key]
    names, rows = spark_rows(query.run(spark, SF_DIR))
    sql_names, expected = sql_rows(con, query.check_sql())
    assert names == sql_names
    assert rows == expected


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 36
    assert set(REGISTRY) <= entry.oracle_sql().keys() <= entry.queries().keys()
