"""Every registered query against its DuckDB oracle (the driver's gate), on
the small driver tables."""

import pytest

import __spark_entry__ as E
from gridlake.plans.oracle import ORACLE
from gridlake.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.parity import compare, duck_connect

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], con)
    assert res["status"] == "match", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["meter_id", "date_key", "tariff_code", "kwh", "cost", "avg_voltage"]
    assert df.count() > 0
