"""Every registered query against its DuckDB oracle on the smallest scale,
plus the driver's smoke entry."""

import os
import sys

import pytest

import __spark_entry__ as entry
from sf_paths import SF_SMALL
from paysignal.plans.oracle import all_sql
from paysignal.plans.queries import all_queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracle import canon, duck  # noqa: E402

# The library's own queries; those of the corpus operators have tests of their own.
QUERIES = all_queries()
SQL = all_sql()

# Spark / DuckDB type names mapped to one vocabulary for the schema check.
SPARK_TYPES = {"string": "str", "int": "int", "bigint": "long", "double": "double", "boolean": "bool", "date": "date",
               "timestamp_ntz": "ts", "timestamp": "ts"}
DUCK_TYPES = {"VARCHAR": "str", "INTEGER": "int", "BIGINT": "long", "DOUBLE": "double", "BOOLEAN": "bool", "DATE": "date",
              "TIMESTAMP": "ts"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and df.columns == ["user_id", "fraud_txn_count", "fraud_amount", "max_risk_score"]


def test_every_sql_key_is_a_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = con.sql(SQL[name])
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())
    spark_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
