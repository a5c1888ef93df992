"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import re

import pytest

import __spark_entry__ as entry
from tools.check import duck, frame_digest

from .conftest import SF_MID, SF_SMALL

# the training-data queries (opN_, pipeline) have their own tests
OWN_TESTS = re.compile(r"op\d+_|pipeline$")
QUERIES = {n: q for n, q in entry.queries().items() if not OWN_TESTS.match(n)}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if not OWN_TESTS.match(n)}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    exp = con.execute(ORACLE[name]).fetchdf()
    assert frame_digest(got) == frame_digest(exp)


# fitted-model queries with their own invariant tests in test_ml.py
CHECKED_ELSEWHERE = {"ml_feature_importance", "ml_save_load", "ml_regressor_choice", "ml_ablation", "ml_next_day"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - CHECKED_ELSEWHERE))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "count", "rn"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["spend_by_region", "bfs_levels", "temp_range", "popular_per_hour"])
def test_mid_scale_oracle(spark, name):
    got = QUERIES[name](spark, SF_MID).toPandas()
    exp = duck(SF_MID).execute(ORACLE[name]).fetchdf()
    assert frame_digest(got) == frame_digest(exp)
