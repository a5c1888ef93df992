"""ML jobs on tables: prior-day features, splits, regressors, model persistence,
label indexing, colour classifiers and evaluation metrics."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import functions as F

from ..ml.features import RgbToLab, hashed_split, prior_day_stage, regression_metrics, stable_split
from ..ml.labels import LabelDictionary, confusion, weighted_f1
from ..session import Scope, table
from .colour import part_colours
from .registry import register

SEED = 42
P = 6

WITH_YESTERDAY = ["latitude", "longitude", "elevation", "day_of_year", "yesterday_tmax"]
WITHOUT_YESTERDAY = ["latitude", "longitude", "elevation", "day_of_year"]


def daily_weather(spark, sf_dir):
    """events → one row per (station, day): station attributes derived from the
    user id, tmax = the day's largest value."""
    ev = table(spark, sf_dir, "events")
    d = ev.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.max("value").alias("tmax"))
    return d.select(
        F.col("user_id").cast("string").alias("station"), "date",
        (30.0 + F.col("user_id") % 30).alias("latitude"),
        (-120.0 + F.col("user_id") % 40).alias("longitude"),
        ((F.col("user_id") % 25) * 40.0).alias("elevation"),
        "tmax",
        (F.col("user_id") + F.datediff("date", F.lit("1970-01-01"))).alias("split_key"),
    )


DAILY_SQL = """
d AS (SELECT CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS date, max(value) AS tmax,
             user_id + datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS split_key
      FROM events GROUP BY user_id, CAST(ts AS DATE))"""


@register("prior_day_join", f"""
WITH {DAILY_SQL}
SELECT t.station, strftime(t.date, '%Y-%m-%d') AS date, CAST(dayofyear(t.date) AS INTEGER) AS day_of_year,
       t.tmax, y.tmax AS yesterday_tmax
FROM d t JOIN d y ON y.date = t.date - 1 AND t.station = y.station
""")
def prior_day_join(spark, sf_dir):
    """Self-join on (station, date - 1) written as a pipeline SQL stage over __THIS__."""
    feats = prior_day_stage().transform(daily_weather(spark, sf_dir))
    return feats.select("station", F.date_format("date", "yyyy-MM-dd").alias("date"), "day_of_year",
                        "tmax", "yesterday_tmax")


@register("ml_split", f"""
WITH {DAILY_SQL}
SELECT CASE WHEN split_key % 4 < 1 THEN 'validation' ELSE 'train' END AS split, count(*) AS n
FROM d GROUP BY 1
""")
def ml_split(spark, sf_dir):
    """Stable 3:1 split on a key (reproducible); ``hashed_split`` splits by a hash."""
    train, valid = stable_split(daily_weather(spark, sf_dir), F.col("split_key"))
    return train.select(F.lit("train").alias("split")).unionByName(
        valid.select(F.lit("validation").alias("split"))).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def _features(spark, sf_dir, scope: Scope):
    """(train, validation) feature rows, computed once for all fits of a query. Join-then-split keeps every
    prior-day pair; the reference order (split, then join inside the pipeline) loses
    pairs whose two days fall in different splits."""
    feats = prior_day_stage().transform(daily_weather(spark, sf_dir)).withColumn(
        "split_key", F.col("station").cast("long") + F.datediff("date", F.lit("1970-01-01")))
    return stable_split(scope.keep(feats), F.col("split_key"))


def _regressor(kind: str, label: str = "tmax"):
    if kind == "gbt":
        return GBTRegressor(featuresCol="features", labelCol=label, seed=SEED, maxIter=20)
    if kind == "tree":
        return DecisionTreeRegressor(featuresCol="features", labelCol=label, seed=SEED)
    if kind == "glm":
        return GeneralizedLinearRegression(featuresCol="features", labelCol=label, family="gaussian",
                                           link="identity")
    raise ValueError(kind)


def _fit_eval(train, valid, cols, kind):
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), _regressor(kind)])
    model = pipe.fit(train)
    pred = model.transform(valid)
    return model, pred


def _metrics_row(pred, **tags):
    m = regression_metrics(pred, "tmax")
    return m.select(*[F.lit(v).alias(k) for k, v in tags.items()], "n",
                    F.round("r2", P).alias("r2"), F.round("rmse", P).alias("rmse"))


@register("ml_temperature")
def ml_temperature(spark, sf_dir):
    """GBT on prior-day features; r2 / rmse on the validation split."""
    with Scope(spark) as scope:
        train, valid = _features(spark, sf_dir, scope)
        _, pred = _fit_eval(train, valid, WITH_YESTERDAY, "gbt")
        return scope.result(_metrics_row(pred, model="gbt"))


@register("ml_regressor_choice")
def ml_regressor_choice(spark, sf_dir):
    """Decision tree, GBT and Gaussian GLM on the features without yesterday's value."""
    rows = None
    with Scope(spark) as scope:
        train, valid = _features(spark, sf_dir, scope)
        for kind in ("tree", "gbt", "glm"):
            _, pred = _fit_eval(train, valid, WITHOUT_YESTERDAY, kind)
            r = _metrics_row(pred, model=kind)
            rows = r if rows is None else rows.unionByName(r)
        return scope.result(rows)


@register("ml_ablation")
def ml_ablation(spark, sf_dir):
    """The same GBT with and without yesterday's value as a feature."""
    out = None
    with Scope(spark) as scope:
        train, valid = _features(spark, sf_dir, scope)
        for name, cols in (("with_yesterday", WITH_YESTERDAY), ("without_yesterday", WITHOUT_YESTERDAY)):
            _, pred = _fit_eval(train, valid, cols, "gbt")
            r = _metrics_row(pred, variant=name)
            out = r if out is None else out.unionByName(r)
        return scope.result(out)


@register("ml_feature_importance")
def ml_feature_importance(spark, sf_dir):
    """(feature, importance) of the fitted GBT; the weights sum to 1."""
    with Scope(spark) as scope:
        train, valid = _features(spark, sf_dir, scope)
        model, _ = _fit_eval(train, valid, WITH_YESTERDAY, "gbt")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(WITH_YESTERDAY, [float(x) for x in imp])),
                                 "feature string, importance double")


def _reference_pipeline(kind="gbt"):
    """The SQL stage inside the pipeline, as a saved model carries it."""
    return Pipeline(stages=[prior_day_stage(),
                            VectorAssembler(inputCols=WITH_YESTERDAY, outputCol="features"),
                            _regressor(kind)])


@register("ml_save_load")
def ml_save_load(spark, sf_dir):
    """Fit the pipeline (SQL stage included) on the training split, save, load,
    and score the whole daily table like a separate test file; report metrics
    and the largest difference between the in-memory and reloaded predictions."""
    with Scope(spark) as scope:
        daily = scope.keep(daily_weather(spark, sf_dir))
        train, _ = stable_split(daily, F.col("split_key"))
        model = _reference_pipeline().fit(train)
        path = scope.path("tmax-model")
        model.write().overwrite().save(path)
        loaded = PipelineModel.load(path)
        a = model.transform(daily).select("station", "date", "tmax", "prediction")
        b = loaded.transform(daily).select("station", "date", F.col("prediction").alias("reloaded"))
        both = a.join(b, ["station", "date"])
        m = regression_metrics(both, "tmax")
        diff = both.agg(F.max(F.abs(F.col("prediction") - F.col("reloaded")))).first()[0]
        return scope.result(m.select("n", F.round("r2", P).alias("r2"), F.round("rmse", P).alias("rmse"),
                                     F.lit(float(diff)).alias("max_abs_diff")))


@register("ml_next_day")
def ml_next_day(spark, sf_dir):
    """Tomorrow's tmax per station: a placeholder row for the day after each
    station's last day is scored with the saved pipeline, whose SQL stage joins
    it to the last observed day."""
    daily = daily_weather(spark, sf_dir)
    train, _ = stable_split(daily, F.col("split_key"))
    model = _reference_pipeline().fit(train)
    last = daily.groupBy("station").agg(F.max("date").alias("date"))
    latest = daily.join(last, ["station", "date"], "left_semi")
    tomorrow = latest.select(
        "station", F.date_add("date", 1).alias("date"), "latitude", "longitude", "elevation",
        F.lit(0.0).alias("tmax"), F.lit(0).cast("long").alias("split_key"))
    # only each station's latest day and its placeholder are scored, not the history
    scored = model.transform(latest.unionByName(tomorrow))
    return scored.join(tomorrow.select("station", "date"), ["station", "date"], "left_semi").select(
        "station", F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.round("prediction", 4).alias("predicted_tmax"))


@register("ml_label_index", """
SELECT p_type AS word, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS label,
       count(*) AS n
FROM part GROUP BY p_type
""")
def ml_label_index(spark, sf_dir):
    """Labels indexed by descending frequency (ties alphabetical), 0 = most frequent; the words shown are
    those that the indices stand for, so the result also says that the way back is right."""
    part = table(spark, sf_dir, "part").select(F.col("p_type").alias("type"))
    labels = LabelDictionary.of(part, "type")
    back = labels.decode(labels.encode(part, "type"), "label", "word")
    return back.groupBy("word", "label").agg(F.count(F.lit(1)).alias("n"))


@register("ml_colour")
def ml_colour(spark, sf_dir):
    """Multilayer perceptron from colour to label, on RGB and on LAB features;
    weighted F1 on the validation split. The output layer has one unit per label."""
    data = part_colours(spark, sf_dir).withColumnRenamed("p_type", "word")
    out = []
    with Scope(spark) as scope:
        labels = LabelDictionary.of(data, "word")  # of all rows: a label may be missing in the training split
        n_labels = labels.table.count()
        train, valid = hashed_split(scope.keep(labels.encode(data, "word")), ["p_partkey"], seed=SEED)
        for name, pre, cols in (("rgb", [], ["R", "G", "B"]),
                                ("lab", [RgbToLab()], ["labL", "labA", "labB"])):
            mlp = MultilayerPerceptronClassifier(layers=[3, 30, n_labels], seed=SEED, maxIter=100)
            pipe = Pipeline(stages=[*pre, VectorAssembler(inputCols=cols, outputCol="features"), mlp])
            table_ = confusion(pipe.fit(train).transform(valid))
            out.append((name, float(weighted_f1(table_).first()["f1"])))
    return spark.createDataFrame(out, "features string, f1 double")


SIZE_RULE = ("CASE WHEN p_size < 10 THEN 'SMALL' WHEN p_size > 40 THEN 'LARGE' ELSE 'MEDIUM' END")


@register("classification_f1", f"""
WITH pr AS (SELECT p_type AS label, {SIZE_RULE} AS prediction FROM part),
t AS (SELECT label AS c, count(*) AS n_true, sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS tp
      FROM pr GROUP BY label),
p AS (SELECT prediction AS c, count(*) AS n_pred FROM pr GROUP BY prediction),
f AS (SELECT t.n_true, CASE WHEN coalesce(p.n_pred, 0) = 0 THEN 0.0 ELSE t.tp / p.n_pred END AS pr,
             t.tp / t.n_true AS rc
      FROM t LEFT JOIN p ON t.c = p.c)
SELECT round(sum(n_true * CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END) / sum(n_true), {P}) AS f1,
       round(sum(n_true * CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END) / sum(n_true), {P}) AS f1_evaluator
FROM f
""")
def classification_f1(spark, sf_dir):
    """Weighted F1 of a fixed size-based rule against the part type, computed
    by aggregation and by MLlib's evaluator (they must agree)."""
    part = table(spark, sf_dir, "part")
    pr = part.select(F.col("p_type").alias("word"), F.expr(SIZE_RULE).alias("guess"))
    labels = LabelDictionary.of(pr, "word")
    scored = labels.encode(labels.encode(pr, "word"), "guess", "prediction", unseen=-1.0)
    agg_f1 = weighted_f1(confusion(scored))
    ev = MulticlassClassificationEvaluator(predictionCol="prediction", labelCol="label", metricName="f1")
    f1_ev = ev.evaluate(scored)
    return agg_f1.select(F.round("f1", P).alias("f1"), F.round(F.lit(f1_ev), P).alias("f1_evaluator"))


@register("regression_metrics", f"""
WITH {DAILY_SQL},
j AS (SELECT t.tmax AS label, y.tmax AS prediction FROM d t JOIN d y ON y.date = t.date - 1 AND t.station = y.station)
SELECT count(*) AS n,
       round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), {P}) AS r2,
       round(sqrt(avg((label - prediction) * (label - prediction))), {P}) AS rmse,
       round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), {P}) AS r2_evaluator,
       round(sqrt(avg((label - prediction) * (label - prediction))), {P}) AS rmse_evaluator
FROM j
""")
def regression_metrics_q(spark, sf_dir):
    """r2 and rmse of the persistence forecast (tomorrow = today), by aggregation
    and by MLlib's RegressionEvaluator."""
    feats = prior_day_stage().transform(daily_weather(spark, sf_dir)).select(
        "tmax", F.col("yesterday_tmax").alias("prediction"))
    m = regression_metrics(feats, "tmax")
    r2 = RegressionEvaluator(labelCol="tmax", predictionCol="prediction", metricName="r2").evaluate(feats)
    rmse = RegressionEvaluator(labelCol="tmax", predictionCol="prediction", metricName="rmse").evaluate(feats)
    return m.select("n", F.round("r2", P).alias("r2"), F.round("rmse", P).alias("rmse"),
                    F.round(F.lit(r2), P).alias("r2_evaluator"), F.round(F.lit(rmse), P).alias("rmse_evaluator"))

