"""Every registered query with an oracle, run in Spark and in DuckDB on the smallest tables."""

import duckdb
import pytest

from geoloom.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(float(r[k]) if isinstance(r[k], (int, float)) and not isinstance(r[k], bool) else r[k] for k in order) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    answer = duck.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, answer.fetchall())
