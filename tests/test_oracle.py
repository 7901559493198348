"""Every registered check against its DuckDB oracle (the driver's gate)."""

from __future__ import annotations

import pytest
from sf_paths import SF001
from oracle_compare import compare, duck

import __spark_entry__ as E
from vigil.plans.checks import REGISTRY

QUERIES = {k: v for k, v in E.queries().items() if k in REGISTRY}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_check_has_a_docstring():
    assert all(fn.__doc__ for fn in QUERIES.values())


def test_oracle_keys_are_registered():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_check_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE.get(name), SF001, con)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == [
        "query_name", "batch_id", "timestamp", "input_rows_per_second", "processed_rows_per_second",
        "backpressure_ratio", "sustained_count", "backpressure_status",
    ]
