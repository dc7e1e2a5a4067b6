"""Every registered query equals its DuckDB oracle on the sf0.01 tables
(row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from mercato.registry import QUERIES
from tests.conftest import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF01)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(df.columns, s_rows) == rows_of(o_cols, o_rows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:3] == ["order_id", "customer_id", "order_status"]
    assert df.count() == 1500


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE"}


def test_column_types_match_oracle(spark, con):
    mismatches = {}
    for name, sql in oracle_sql().items():
        df = queries()[name](spark, SF01)
        spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in df.schema.fields}
        oracle_types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
        if spark_types != oracle_types:
            mismatches[name] = (spark_types, oracle_types)
    assert not mismatches
