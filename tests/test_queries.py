"""Every registered query against its SQL, on the given tables."""

import pytest

import __spark_entry__ as spark_entry
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from tests.compare import connect, differences

NO_SQL = {"changepoint_forecast"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_entry_gives_forecast_rows(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["product_id", "age_sales_category", "age_category", "sales_category",
                          "style", "forecast_method", "date", "forecast"]
    assert df.count() > 0


def test_changepoint_forecast_keeps_the_contract(spark, sf_dir):
    bent = QUERIES["changepoint_forecast"](spark, sf_dir).toPandas()
    plain = QUERIES["forecast_direct"](spark, sf_dir).toPandas()
    assert (bent.forecast >= 0).all()
    assert (bent.groupby("product_id").size() == 14).all()
    assert set(bent.product_id) == set(plain.product_id)
    # Both choose the intermittent method for the same products and give them the same values.
    keys = ["product_id", "date"]
    ours = bent[bent.forecast_method == "croston"].sort_values(keys).reset_index(drop=True)
    theirs = plain[plain.forecast_method == "croston"].sort_values(keys).reset_index(drop=True)
    assert ours.equals(theirs)
