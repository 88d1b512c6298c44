"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, compare

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, db, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), db.execute(ORACLES[name])).startswith("ok")


def test_every_operator_has_a_query():
    counts = dict(A=11, B=27, C=10, D=5, E=14, F=9, G=28, H=16, I=2)
    ids = {name.split("_")[0] for name in QUERIES}
    assert {f"{k}{i}" for k, n in counts.items() for i in range(1, n + 1)} <= ids
    assert set(ORACLES) <= set(QUERIES) and not {q for q in QUERIES if q not in ORACLES and not q.startswith(("op", "pipeline"))}


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["main_business", "category", "price_range", "product_count"] and df.count() > 0
