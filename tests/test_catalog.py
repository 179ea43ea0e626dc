"""Every SQL-checked query equals DuckDB's answer."""

import pytest

import __spark_entry__ as entry
from panelwright.catalog import CASES
from tests.compare import connect, mismatch


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


# Empty by construction at the smallest scale: no client is that large there.
EMPTY_AT_SMALL_SCALE = {"per_group_auc", "abstain_gate", "group_size_filter"}


@pytest.mark.parametrize("key", [k for k, c in CASES.items() if c.sql])
def test_query_matches_sql(spark, sf, con, key):
    case = CASES[key]
    problem = mismatch(case.query(spark, sf), con, case.sql)
    if key in EMPTY_AT_SMALL_SCALE and problem == "no rows":
        assert con.sql(case.sql).fetchall() == []
        return
    assert problem is None, problem


def test_entry_is_a_complete_ranking(spark):
    rows = entry.entry(spark).select("rank").collect()
    assert rows and sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1))


def test_contract_functions_agree():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and set(CASES) <= set(queries) and len(CASES) == 203
