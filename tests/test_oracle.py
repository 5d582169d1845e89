"""Every registered query equals its DuckDB SQL on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from newsflow.checks.compare import compare
from newsflow.checks.oracle import ORACLE
from newsflow.checks.queries import QUERIES

from .conftest import SF_SMALL


def test_every_query_has_a_name_match():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], duck_small)
    assert r["schema_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["value_match"], r["first_mismatch"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["subject", "prediction_label", "count"]
    assert df.count() > 0
