"""Invariants of the fitted-model queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.ml.features import hashed_split, regression_metrics, stable_split
from tessera.ml.labels import LabelDictionary, confusion, weighted_f1
from tessera.ml.linear import fit_linear

from .conftest import SF_SMALL

pytestmark = pytest.mark.slow

Q = entry.queries()


def test_importances_sum_to_one(spark):
    rows = Q["ml_feature_importance"](spark, SF_SMALL).collect()
    assert len(rows) == 5
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert all(r["importance"] >= 0 for r in rows)


def test_reloaded_model_predicts_the_same(spark):
    r = Q["ml_save_load"](spark, SF_SMALL).first()
    assert r["max_abs_diff"] == 0.0 and r["n"] > 0


def test_regressor_and_ablation_tables(spark):
    assert sorted(r["model"] for r in Q["ml_regressor_choice"](spark, SF_SMALL).collect()) == ["gbt", "glm", "tree"]
    ab = {r["variant"]: r for r in Q["ml_ablation"](spark, SF_SMALL).collect()}
    assert set(ab) == {"with_yesterday", "without_yesterday"}


def test_next_day_one_prediction_per_station(spark):
    out = Q["ml_next_day"](spark, SF_SMALL)
    assert out.count() == out.select("station").distinct().count() > 0


def test_stable_split_is_reproducible_and_complete(spark):
    df = spark.range(1000).withColumn("k", F.col("id") * 7)
    a1, b1 = stable_split(df, F.col("k"))
    a2, b2 = stable_split(df, F.col("k"))
    assert a1.count() + b1.count() == 1000
    assert sorted(r.id for r in b1.collect()) == sorted(r.id for r in b2.collect())


def test_metric_aggregates_match_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    pred = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 0.0)],
                                 "label double, prediction double")
    f1 = weighted_f1(confusion(pred)).first()["f1"]
    assert f1 == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(pred))
    m = regression_metrics(pred, "label").first()
    assert m["rmse"] == pytest.approx(RegressionEvaluator(labelCol="label", metricName="rmse").evaluate(pred))
    assert m["r2"] == pytest.approx(RegressionEvaluator(labelCol="label", metricName="r2").evaluate(pred))


def test_label_dictionary_round_trip(spark):
    words = ["b"] * 5 + ["a"] * 5 + ["hot"] * 300 + ["", "É", None, "x"]
    df = spark.createDataFrame([(i, w, "mine") for i, w in enumerate(words)], "id long, word string, _label string").repartition(4)
    labels = LabelDictionary.of(df, "word")
    got = {r.word: (r.label, r.n) for r in labels.table.collect()}
    assert got == {"hot": (0.0, 300), "a": (1.0, 5), "b": (2.0, 5), "": (3.0, 1), "x": (4.0, 1), "É": (5.0, 1)}
    plain = df.drop("_label")
    there = labels.encode(plain, "word", "ix")
    assert there.count() == len(words) and there.where("ix IS NULL").select("word").collect() == [(None,)]
    back = labels.decode(there, "ix", "again")
    assert back.where("NOT (word <=> again)").count() == 0
    other = spark.createDataFrame([("new",), ("a",)], "word string")
    assert {r.word: r.ix for r in labels.encode(other, "word", "ix", unseen=-1.0).collect()} == {"new": -1.0, "a": 1.0}
    assert LabelDictionary.of(df.limit(0), "word").table.count() == 0


def test_f1_of_a_confusion_table(spark):
    import random

    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rng = random.Random(2)
    rows = [(float(rng.randrange(4)), float(rng.choice([0, 0, 1, 2, 5]))) for _ in range(300)]
    pred = spark.createDataFrame(rows, "label double, prediction double")
    assert confusion(pred).agg(F.sum("n")).first()[0] == 300
    assert weighted_f1(confusion(pred)).first()["f1"] == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(pred))


def test_linear_model(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)) * [1, 1000, 0.01] + [5, 1e6, 0]
    y = 3 + x @ [2.0, -0.5, 40.0] + rng.normal(size=400)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)] + [(None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(5)
    model = fit_linear(df, ["a", "b", "c"], "y")
    want, rest, *_ = np.linalg.lstsq(np.column_stack([np.ones(400), x]), y, rcond=None)
    assert model.n == 400
    assert np.allclose([model.intercept, *model.coefficients], want, rtol=1e-6)
    fit = want[0] + x @ want[1:]
    assert model.r2 == pytest.approx(1 - ((y - fit) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert model.rmse == pytest.approx(float(np.sqrt(((y - fit) ** 2).mean())))
    scored = regression_metrics(model.transform(df).dropna(), "y").first()
    assert (scored["r2"], scored["rmse"]) == (pytest.approx(model.r2), pytest.approx(model.rmse))
    assert model.transform(df).where("a IS NULL").first()["prediction"] is None
    # a constant and a doubled feature: the least-norm solution still predicts as well
    twice = df.withColumn("k", F.lit(7.0)).withColumn("a2", F.col("a") * 2)
    assert fit_linear(twice, ["a", "b", "c", "k", "a2"], "y").r2 == pytest.approx(model.r2)
    flat = fit_linear(df.withColumn("y", F.lit(1.0)), ["a"], "y")
    assert flat.r2 is None and flat.coefficients == [0.0] and flat.intercept == 1.0
    with pytest.raises(ValueError):
        fit_linear(df.limit(0), ["a"], "y")


def test_hashed_split_ignores_partitioning(spark):
    df = spark.range(4000).withColumn("g", F.col("id") % 1000)
    train, valid = hashed_split(df, ["g"])
    again, _ = hashed_split(df.repartition(7), ["g"])
    assert train.count() + valid.count() == 4000 and 2600 < train.count() < 3400
    assert sorted(r.id for r in train.collect()) == sorted(r.id for r in again.collect())
    assert train.join(valid, "g").count() == 0


def test_scope_ends_what_it_keeps(spark, tmp_path):
    import os

    from tessera.session import Scope
    with Scope(spark) as scope:
        kept = scope.keep(spark.range(10))
        staged = scope.stage(kept.where("id > 3"), "t")
        folder = scope._paths[0]
        assert staged.count() == 6 and kept.is_cached and os.path.isdir(folder)
        out = scope.result(staged)
        with pytest.raises(ValueError):
            scope.result(kept, max_rows=9)
    assert not kept.is_cached and not os.path.exists(folder)
    assert sorted(r.id for r in out.collect()) == [4, 5, 6, 7, 8, 9]
