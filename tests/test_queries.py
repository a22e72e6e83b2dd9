"""Every registered query with SQL gives the rows that DuckDB gives for it, at one and at four partitions."""

import datetime

import duckdb
import pandas as pd
import pytest

from lodestack.plans import registry


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(pd.Timestamp(v)) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in registry.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    if name not in registry.ORACLE_SQL:
        assert got
        return
    found = oracle.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(([plain(r[names.index(c)]) for c in columns] for r in found.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", ["search_topk", "round_robin_rank", "dependency_prune", "interval_merge"])
def test_result_does_not_depend_on_partitions(spark, sf_dir, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, registry.QUERIES[name](spark, sf_dir).collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
