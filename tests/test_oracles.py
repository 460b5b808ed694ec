"""Every registered query equals its DuckDB oracle at sf0.001 (columns, row
count, order-insensitive values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tools.oracle_check import _rows

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    rel = duck.sql(ORACLES[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_every_query_without_oracle_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, SF_SMALL).count() >= 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["from_province", "to_province", "total"]
    assert 0 < df.count() <= 5


def test_registration_inputs_reach_every_branch(spark):
    def kinds(name):
        rows = QUERIES[name](spark, "/root/testdata/sf0.01").selectExpr("explode(violations) AS v").distinct().collect()
        return {r["v"] for r in rows}

    contacts = {f"{k}_{how}" for k in ("email", "phone", "identity_card") for how in ("exists", "duplicate_in_batch")}
    assert kinds("dup_contacts") == kinds("profile_conflicts") == contacts
    assert kinds("row_quality") == {"account_number", "identity_card", "phone", "email", "full_name", "province", "district"}
