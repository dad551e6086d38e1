"""Every registered query against its SQL, on the small tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import differences, duck
from tillroll import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    sql = contract.oracle_sql()[name]
    assert differences(contract.queries()[name](spark, SF_DIR), con, sql) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["shopping_mall", "total_revenue"]
