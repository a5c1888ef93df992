"""Sources and sinks: batched writes, filters inside a CSV scan, corrupt JSON lines, named views."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.functions.json import corrupt_count, decode_json_lines
from tessera.plans.warehouse import register_prefix_view
from tessera.sources.batched import BatchedRows, BatchedWriter, committed, in_batches
from tessera.sources.files import read_csv

from .conftest import SF_SMALL
from .test_plans import plan

Q = entry.queries()


@pytest.fixture
def batched(spark):
    spark.dataSource.register(BatchedRows)
    return spark


def load(spark, path, schema="id long, t string"):
    return spark.read.format("batched_rows").schema(schema).load(path)


def rows_of(n, at=0):
    return pa.RecordBatch.from_pydict({"id": list(range(at, at + n)), "t": [f"r{i}" for i in range(at, at + n)]})


def test_batches_of_rows():
    for sizes in ([250], [1] * 250, [99, 2, 149], [0, 100, 0, 150], []):
        at, batches = 0, []
        for n in sizes:
            batches.append(rows_of(n, at))
            at += n
        got = list(in_batches(batches, 100))
        assert [b.num_rows for b in got] == ([100, 100, 50] if at else [])
        assert [i for b in got for i in b.column("id").to_pylist()] == list(range(at))


def test_append_and_overwrite(batched, tmp_path):
    path = str(tmp_path / "t")
    df = batched.range(1234).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("ü"), F.col("id"))).alias("t")).repartition(3)
    write = lambda d, mode: d.write.format("batched_rows").option("batch_rows", 100).mode(mode).save(path)
    write(df, "append")
    first = committed(path)
    assert first["commits"] == 1 and first["rows"] == 1234 and 13 <= first["batches"] <= 15  # a last one for each task
    assert sorted(map(tuple, load(batched, path).collect())) == sorted(map(tuple, df.collect()))
    write(df.limit(5), "append")
    assert load(batched, path).count() == 1239 and committed(path)["commits"] == 2
    write(df.limit(0), "append")
    assert load(batched, path).count() == 1239
    write(df.limit(3), "overwrite")
    assert load(batched, path).count() == 3 and committed(path)["rows"] == 3
    assert load(batched, str(tmp_path / "nothing")).count() == 0


def test_retried_and_failed_tasks(batched, tmp_path):
    path = str(tmp_path / "t")
    job = BatchedWriter(path, 100, overwrite=False)
    job.write(iter([rows_of(150)]))                      # an attempt whose message never arrives

    def dies():
        yield rows_of(120)
        raise RuntimeError("lost executor")

    with pytest.raises(RuntimeError):
        job.write(dies())                                # one that leaves a part of its file
    again = job.write(iter([rows_of(150)]))
    other = job.write(iter([rows_of(30, 150)]))
    assert (again.rows, again.batches, other.batches) == (150, 2, 1)
    assert load(batched, path).count() == 0              # nothing shows before the commit
    job.commit([again, other, job.write(iter([]))])
    assert sorted(r.id for r in load(batched, path).collect()) == list(range(180))
    lost = BatchedWriter(path, 100, overwrite=False)
    message = lost.write(iter([rows_of(10)]))
    lost.abort([message, None])
    assert load(batched, path).count() == 180 and not (tmp_path / "t" / message.file).exists()


def test_csv_scan_evaluates_filters(spark, tmp_path):
    text = plan(Q["src_csv_pushdown"](spark, SF_SMALL))
    scan = text[text.index(") Scan csv"):]
    assert "PushedFilters: [IsNotNull(l_returnflag)" in scan and "LessThan(l_quantity,10.0)" in scan
    path = str(tmp_path / "c")
    spark.createDataFrame([("R,1,x",), ("A,bad,x",), ("R,3,x",)], "value string").coalesce(1).write.option("compression", "gzip").text(path)
    read = lambda: read_csv(spark, path, "flag string, n int, t string", mode="FAILFAST")
    assert sorted(r.n for r in read().where("flag = 'R'").select("n").collect()) == [1, 3]
    with pytest.raises(Exception, match="MALFORMED|BadRecord|Malformed"):
        read().select("n").collect()


def test_corrupt_lines(spark):
    lines = ['{"k": "a", "score": 1}', '{"k": "b", "score": "2"}', '{"k": "c", "score": {"x": 1}}', "not json", "[1, 2]", "5", '"s"',
             "", "null", None, '{"k": "d"', "{}", '{"k": 7, "score": true}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = decode_json_lines(df, "k string, score string")
    assert got.columns == ["k", "score", "_corrupt"]
    good = {r.k: r.score for r in got.where("NOT _corrupt").collect()}
    assert good == {"a": "1", "b": "2", "c": '{"x":1}', None: None, "7": "true"}
    assert corrupt_count(got).first().asDict() == {"corrupt_lines": 8, "lines": 13}
    # a value of another type is no corrupt line
    typed = decode_json_lines(df.limit(2), "k string, score int")
    assert typed.where("_corrupt").count() == 0
    assert plan(got).count("from_json") <= plan(decode_json_lines(df, "k string")).count("from_json") + 4


def test_views_under_callers_names(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    people = "c_custkey long, c_mktsegment string, c_nationkey long"
    spark.createDataFrame([(1, "BUILDING", 0), (2, "AUTO", 9)], people).write.parquet(str(one / "customer.parquet"))
    spark.createDataFrame([(1, "BUILDING", 9), (2, "AUTO", 0), (3, None, 0)], people).write.parquet(str(two / "customer.parquet"))
    try:
        register_prefix_view(spark, str(one), "flags_one")
        register_prefix_view(spark, str(two), "flags_two")
        flags = lambda name: {r.custid: r.known_prefix for r in spark.table(name).collect()}
        assert flags("flags_one") == {1: 1, 2: 0} and flags("flags_two") == {1: 0, 2: 1, 3: None}
        assert {v.name for v in spark.catalog.listTables() if v.tableType == "VIEW"} >= {"flags_one", "flags_two"}
        assert "flags_one" in {v.name for v in spark.newSession().catalog.listTables()}  # not of one session alone
        spark.createDataFrame([(4, "AUTO", 0)], people).write.mode("append").parquet(str(one / "customer.parquet"))
        spark.catalog.refreshTable("flags_one")
        assert flags("flags_one") == {1: 1, 2: 1, 4: 1}
    finally:
        for name in ("flags_one", "flags_two"):
            spark.sql(f"DROP VIEW IF EXISTS {name}")
