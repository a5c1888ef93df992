"""Keyed tables: merges bucket by bucket, whole versions for readers, crashes, nulls, compound keys."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.sources.keyed_table import KeyedTable

from .test_plans import plan

COLUMNS = "k BIGINT, name STRING, version INT"


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable.create(spark, "kt_" + tmp_path.name.replace("-", "_"), COLUMNS, ["k"], buckets=4, location=str(tmp_path))
    yield t
    t.drop()


def rows(t):
    return sorted(map(tuple, t.rows().collect()), key=str)


def test_replaces_rows(spark, table):
    batch = lambda *r: spark.createDataFrame(r, "k long, name string, version int")
    table.upsert(batch((1, "a", 1), (2, "b", 1)), "version")
    table.upsert(batch((2, "older", 0), (1, "equal", 1), (3, "c", 5), (3, "c6", 6), (3, "c5", 5)), "version")
    assert rows(table) == [(1, "equal", 1), (2, "b", 1), (3, "c6", 6)]
    table.upsert(batch((2, None, None)), "version")  # a null version is the least
    assert rows(table) == [(1, "equal", 1), (2, "b", 1), (3, "c6", 6)]
    table.upsert(batch((2, None, None)))  # without a version the change counts
    assert rows(table) == [(1, "equal", 1), (2, None, None), (3, "c6", 6)]
    table.upsert(spark.createDataFrame([], "k long, name string, version int"))
    assert len(rows(table)) == 3


def test_against_a_dictionary(spark, table):
    rng, want = random.Random(1), {}
    for _ in range(4):
        batch = [(7 if rng.random() < 0.4 else rng.randrange(60), rng.choice("xyz"), rng.randrange(9)) for _ in range(80)]
        for k, name, version in sorted(batch, key=lambda r: (r[2], r[1])):
            if k not in want or version >= want[k][1]:
                want[k] = (name, version)
        table.upsert(spark.createDataFrame(batch, "k long, name string, version int").repartition(3), "version")
    assert {r[0]: r[1:] for r in rows(table)} == want


def test_merge_has_no_exchange(spark, table):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("name"), F.lit(1).alias("version"))
    table.upsert(base, "version")
    delta = table._define("delta")
    base.limit(10).repartition(4, "k").write.insertInto(delta)
    text = plan(table.merged(table.current(), delta, "version"))
    assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
    files = table.rows().select(F.input_file_name().alias("f")).distinct().count()
    assert files == 4  # one file a bucket


def test_crash_before_the_switch(spark, table, monkeypatch):
    one = spark.createDataFrame([(1, "a", 1)], "k long, name string, version int")
    table.upsert(one)

    def crash(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(KeyedTable, "_switch", crash)
    with pytest.raises(RuntimeError, match="lost driver"):
        table.upsert(one.withColumn("name", F.lit("b")))
    monkeypatch.undo()
    again = KeyedTable(spark, table.name)  # opened anew from the catalog
    assert rows(again) == [(1, "a", 1)] and (again.keys, again.buckets) == (["k"], 4)
    again.upsert(one.withColumn("name", F.lit("c")))
    assert rows(table) == [(1, "c", 1)]
    names = lambda: [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{table.name}__*'").collect()]
    assert len(names()) > 1
    table.vacuum()
    assert names() == [table.current()] and rows(table) == [(1, "c", 1)]


def test_null_key_leaves_the_table(spark, table):
    table.upsert(spark.createDataFrame([(1, "a", 1)], "k long, name string, version int"))
    with pytest.raises(Exception, match="null in key column k"):
        table.upsert(spark.createDataFrame([(2, "b", 1), (None, "c", 1)], "k long, name string, version int"))
    assert rows(table) == [(1, "a", 1)]


def test_second_writer_is_refused(spark, table):
    table.upsert(spark.createDataFrame([(1, "a", 1)], "k long, name string, version int"))
    before = table.current()
    table.upsert(spark.createDataFrame([(1, "b", 1)], "k long, name string, version int"))
    with pytest.raises(RuntimeError, match="another writer"):
        table._switch(before, before)
    assert rows(table) == [(1, "b", 1)]


def test_compound_key_and_key_only(spark, tmp_path):
    name = "kc_" + tmp_path.name.replace("-", "_")
    t = KeyedTable.create(spark, name, "host STRING, id STRING, bytes BIGINT", ["host", "id"], buckets=3, location=str(tmp_path / "a"))
    t.upsert(spark.createDataFrame([("h", "1", 5), ("h", "2", 6), ("g", "1", 7)], "host string, id string, bytes long"))
    t.upsert(spark.createDataFrame([("h", "2", 0), ("g", "2", 8)], "host string, id string, bytes long"))
    assert rows(t) == [("g", "1", 7), ("g", "2", 8), ("h", "1", 5), ("h", "2", 0)]
    t.drop()
    assert not spark.catalog.tableExists(name)
    k = KeyedTable.create(spark, name, "a INT, b INT", ["a", "b"], buckets=2, location=str(tmp_path / "b"))
    k.upsert(spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int"))
    k.upsert(spark.createDataFrame([(1, 2), (2, 2)], "a int, b int"))
    assert rows(k) == [(1, 1), (1, 2), (2, 2)]
    k.drop()
