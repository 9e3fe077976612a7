"""Every registered query with SQL gives the rows the SQL gives."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import differences, oracle

FOLDER = "/root/testdata/sf0.001"
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_module.queries())
    assert len(SQL) > 90


def test_entry(spark):
    got = entry_module.entry(spark)
    assert got.columns == [
        "event_type", "event_count", "avg_speed", "avg_battery", "avg_fuel_efficiency"
    ]
    assert got.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    got = entry_module.queries()[name](spark, FOLDER).toPandas()
    assert differences(got, duck.execute(SQL[name]).df()) == ""
