"""Every registered query against its SQL."""

import pytest
from compare import database, differences
from conftest import SMALL

import __spark_entry__ as driver
from nameharbor.plans.oracles import ORACLES
from nameharbor.plans.queries import registered


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) == []


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLES)
    assert set(registered()) <= set(driver.queries())


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["zone", "domain", "event_type", "snapshot_date", "tld", "public_suffix", "apex", "fqdn"]
    assert frame.count() > 0
