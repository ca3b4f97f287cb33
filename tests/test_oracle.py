"""Every registered query against its DuckDB SQL on the same Parquet (small scale)."""

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from oracle_harness import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    r = compare(spark, E.queries()[name], SQL[name], SF_SMALL, con)
    assert r["ok"], r


@pytest.mark.parametrize("name", ["wave_fold", "wave_stack"])
def test_waves_keep_rows_without_a_date(spark, name, tmp_path):
    path = f"{tmp_path}/orders.parquet"
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate)
                    FROM read_parquet('{SF_SMALL}/orders.parquet')) TO '{path}' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{path}')")
    r = compare(spark, E.queries()[name], SQL[name], str(tmp_path), con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["question", "word1", "word2", "n"]
    assert df.count() > 0
