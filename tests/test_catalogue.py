import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from variantry.plans.catalogue import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None or isinstance(value, bool) else str(value)


def normalised(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([canonical(row[i]) for i in order] for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    df = QUERIES[name](spark, SMALL)
    cursor = database.execute(oracle_sql()[name])
    columns = [part[0] for part in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normalised(df.collect(), df.columns) == normalised(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_no_query_pairs_all_rows(spark, plan_of):
    for name, run in QUERIES.items():
        if "round_trip" in name or "stored" in name:
            continue
        plan = plan_of(run(spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan, name
