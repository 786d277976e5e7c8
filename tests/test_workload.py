"""Every registered query against its SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
import workload
from tools.check_oracles import differences, tables

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(spark, connection, name, SF_DIR) == ""


def test_every_query_of_the_library_has_an_oracle():
    assert set(workload.oracles()) == set(workload.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
