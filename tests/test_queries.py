"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from tests.oracle import differences


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, con, name):
    df = queries()[name](spark, SMOKE_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert differences(df, con, sql) is None


def test_entry(spark):
    assert {r.intent for r in entry(spark).collect()} == {"work_related", "personal", "other"}
