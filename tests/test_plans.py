"""Physical-plan properties: pushdown, pruning, no Python evaluation, chosen joins."""

import re

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

# the training-data queries (opN_, pipeline) have their own tests
QUERIES = {n: q for n, q in entry.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
                "FlatMapGroupsInArrow")
#: Read through a source written in Python, on the public data source API.
PYTHON_SOURCES = {"sink_batched"}


def plan(df) -> str:
    """Full formatted physical plan text (as ``explain("formatted")`` prints it)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("ml_") and n not in PYTHON_SOURCES))
def test_no_python_evaluation(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES), name


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["src_pushdown_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_returnflag)" in text or "EqualTo(l_returnflag,R)" in text
    assert "LessThan(l_quantity,10.0)" in text
    assert "l_extendedprice" not in text      # pruned


def test_point_lookup_pushes_in_list(spark):
    text = plan(QUERIES["point_lookup"](spark, SF_SMALL))
    assert "In(o_orderkey" in text


def test_keyed_average_reads_two_columns(spark):
    text = plan(QUERIES["keyed_average"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert "partial_avg" in text               # map-side partial aggregation


def test_having_on_key_reaches_dimension_scan(spark):
    text = plan(QUERIES["avg_having"](spark, SF_SMALL))
    assert "EqualTo(n_name,NATION_1)" in text


@pytest.mark.parametrize("name", ["popular_per_hour_broadcast", "relative_score_broadcast"])
def test_checked_broadcast_variants_broadcast(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text


def test_semi_join_form(spark, monkeypatch):
    """The semi join lies in the dimension that the query materialises."""
    from tessera.plans import warehouse

    seen = []
    whole = warehouse.materialize
    monkeypatch.setattr(warehouse, "materialize", lambda df: seen.append(plan(df)) or whole(df))
    text = plan(QUERIES["semi_join_in"](spark, SF_SMALL))
    assert len(seen) == 1 and "LeftSemi" in seen[0]
    assert "LeftSemi" not in text and text.count(") Scan parquet") == 1   # only the fact table is scanned


def test_no_window_over_group_in_extremes(spark):
    for name in ("temp_range", "temp_range_window", "temp_range_pivot", "popular_per_hour", "argmax_single"):
        assert "Window" not in plan(QUERIES[name](spark, SF_SMALL)), name
