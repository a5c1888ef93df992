"""The native operators run without Python workers."""

import pytest

from tessera.llm import queries

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "InPandas", "InArrow")


@pytest.mark.parametrize("name", ["op4_sharding", "op5_mixing", "op7_line_dedup", "op9_exact_dedup"])
def test_no_python_workers(spark, name, monkeypatch):
    from pyspark.sql import DataFrame, DataFrameWriter

    def refused(*_, **__):
        raise AssertionError("a Python worker or an RDD")

    for method in ("mapInPandas", "mapInArrow", "toPandas", "toArrow"):
        monkeypatch.setattr(DataFrame, method, refused, raising=False)
    seen = []
    parquet = DataFrameWriter.parquet

    def write(self, *args, **kwargs):  # what the operators stage
        seen.append(spark._jvm.PythonSQLUtils.explainString(self._df._jdf.queryExecution(), "formatted"))
        return parquet(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    out = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    seen.append(spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted"))
    assert not any(node in text for text in seen for node in PYTHON_NODES)
