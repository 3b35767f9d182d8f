"""Every registered engine query against its SQL on the smallest supplied tables."""

import os

import pytest

from tessera.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}" if v != int(v) else str(int(v))
    return str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name not in SQL:
        return
    rel = duck.sql(SQL[name])
    order = sorted(range(len(rel.columns)), key=lambda k: rel.columns[k])
    assert sorted(df.columns) == [rel.columns[k] for k in order]
    assert got == sorted(tuple(norm(r[k]) for k in order) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_documents_are_written_whole_from_spread_source_rows(spark):
    from tessera import queries as q
    from tessera.sources import store

    was = spark.conf.get("spark.sql.variant.writeShredding.enabled")
    docs = q.engine(spark, SF).databases["shop"]["sales"].documents()
    assert len(docs.inputFiles()) == spark.sparkContext.defaultParallelism
    import pyarrow.parquet as pq

    assert "typed_value" not in str(pq.ParquetFile(docs.inputFiles()[0].removeprefix("file:").replace("///", "/")).schema)
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") == was and store._stored


@pytest.mark.parametrize("name", ["window_rank", "window_running_sum", "window_distribution"])
def test_windows_over_large_tables_get_parts_of_one_size(spark, duck, monkeypatch, name):
    from functools import partial

    from tessera import queries

    monkeypatch.setattr(queries, "dealt", partial(queries.dealt, most=10_000))
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    parts = df.rdd.getNumPartitions()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and parts > 4
    got = sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    rel = duck.sql(SQL[name])
    order = sorted(range(len(rel.columns)), key=lambda k: rel.columns[k])
    assert got == sorted(tuple(norm(r[k]) for k in order) for r in rel.fetchall())
