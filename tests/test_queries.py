"""Every named query against its SQL oracle, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from respfeat.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
# Spark type names and the oracle's names for them.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    cur = oracle.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in cur.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    cols = sorted(types)
    at = [list(types).index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    assert got == want


def test_entry_runs(spark):
    assert spark_entry.entry(spark).count() > 0
