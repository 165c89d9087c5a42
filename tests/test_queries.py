from __future__ import annotations

import glob
import os

import duckdb
import pytest

from pleiad.queries import ORACLES, QUERIES

TOP = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{TOP}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def rows(columns: list[str], values: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = lambda v: v + 0.0 if isinstance(v, float) else v  # noqa: E731  no negative zero
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=str)


@pytest.mark.skipif(not glob.glob(f"{TOP}/*.parquet"), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, TOP)
    got = rows(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, cursor.fetchall())


def test_scans_read_what_is_asked(spark):
    plan = QUERIES["project_flat"](spark, TOP)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "l_comment" not in plan and "GreaterThanOrEqual(l_quantity,10.0)" in plan
    plan = QUERIES["pricing_summary"](spark, TOP)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(l_shipdate" in plan and "l_partkey" not in plan


def test_nested_pruning_reaches_the_scan(spark, tmp_path):
    from pleiad.sources.events import order_events, read_events

    order_events(spark, TOP).write.parquet(str(tmp_path / "e"))
    df = read_events(spark, str(tmp_path / "e"), columns=["muons.pt_"])
    assert "ReadSchema: struct<muons:array<struct<pt_:double>>>" in df._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_list_their_folders_alone(spark):
    plan = QUERIES["partition_columns"](spark, TOP)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [o_orderstatus" in plan and "o_orderkey" not in plan.split("ReadSchema")[1]
