"""Every registered query against its DuckDB twin (sf0.001 by default;
set CAUCE_ORACLE_SF to run another scale)."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare

SF = os.environ.get("CAUCE_ORACLE_SF", "/root/testdata/sf0.001")
ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF, QUERIES, ORACLE, verbose=True)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "cliente_id" and df.columns[-2:] == ["target", "fecha_pedido_dt"]
    assert len(df.columns) == 1 + 29 + 2
