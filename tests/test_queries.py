"""Every registered query against its check SQL, or at least for rows, on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, oracle

SF = "/root/testdata/sf0.001"
MODELS = [name for name in queries() if name not in oracle_sql()]


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", MODELS)
def test_has_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_one_row_per_key(spark):
    df = entry(spark)
    assert df.count() == df.select("Customer_ID", "snapshot_date").distinct().count() == 2639
    assert len(df.columns) == 45
