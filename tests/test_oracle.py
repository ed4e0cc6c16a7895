"""A few registered queries checked against their DuckDB oracle inside pytest
(the full set runs with ``python tests/compare.py <sf_dir>``)."""

import pytest

import __spark_entry__ as E
from tests.compare import connect, frame_hash

SF = "/root/testdata/sf0.001"
KEYS = ["offshore_risk_summary", "operational_risk", "rig_monthly_change", "price_summary",
        "executive_snapshot", "dq_checks", "asset_map", "reload_dim_asset"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert frame_hash(sp) == frame_hash(dk)
