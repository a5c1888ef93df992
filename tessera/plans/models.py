"""Fitted models whose results SQL can state: linear models, single splits, boosted splits.

A regression tree of one split is an argmax over all thresholds, a linear model
the solution of two equations, so the oracles find them on their own. The
queries go through the same pipelines, stages and operators as the larger
models of ``ml.py``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import functions as F

from ..ml.features import prior_day_stage, regression_metrics, stable_split
from ..ml.linear import fit_linear
from ..session import Scope
from .ml import DAILY_SQL, P, daily_weather
from .registry import register

FEATURES = ["latitude", "longitude", "elevation", "day_of_year", "yesterday_band"]
BINS = 64  # more than any feature has values: every midpoint between neighbours is a candidate split

BAND_SQL = "SELECT *, least(floor(yesterday_tmax / 20), 50) AS yesterday_band FROM __THIS__"


def _pairs_sql(name: str, source: str = "d", where: str = "TRUE") -> str:
    """Rows next to their station's day before, both taken from ``source``, with the split of the later day."""
    return f"""
{name} AS (
  SELECT t.station, t.date, t.tmax, y.tmax AS yesterday_tmax, CAST(30 + uid % 30 AS DOUBLE) AS latitude,
         CAST(uid % 40 - 120 AS DOUBLE) AS longitude, CAST(uid % 25 * 40 AS DOUBLE) AS elevation,
         CAST(dayofyear(t.date) AS DOUBLE) AS day_of_year, CAST(least(floor(y.tmax / 20), 50) AS DOUBLE) AS yesterday_band
  FROM (SELECT *, CAST(station AS BIGINT) AS uid FROM {source}) t
  JOIN {source} y ON y.station = t.station AND y.date = t.date - 1
  WHERE {where})"""


def _stump_sql(name: str, source: str, target: str = "tmax", features: list[str] = FEATURES) -> str:
    """The split of ``source`` that leaves the least squared error: one row (feature, threshold, sizes and means)."""
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, {target} AS y FROM {source}" for f in features)
    return f"""
{name}_values AS (SELECT feature, x, count(*) AS n, sum(y) AS s FROM ({long}) GROUP BY feature, x),
{name}_cuts AS (
  SELECT feature, x, lead(x) OVER w AS next_x, sum(n) OVER upto AS n_left, sum(s) OVER upto AS s_left,
         sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
  FROM {name}_values WINDOW w AS (PARTITION BY feature ORDER BY x),
       upto AS (PARTITION BY feature ORDER BY x ROWS UNBOUNDED PRECEDING)),
{name} AS (
  SELECT feature, (x + next_x) / 2 AS threshold, CAST(n_left AS BIGINT) AS n_left, s_left / n_left AS mean_left,
         CAST(n - n_left AS BIGINT) AS n_right, (s - s_left) / (n - n_left) AS mean_right
  FROM {name}_cuts WHERE next_x IS NOT NULL
  ORDER BY s_left * s_left / n_left + (s - s_left) * (s - s_left) / (n - n_left) DESC LIMIT 1)"""


def _leaf_sql(stump: str, features: list[str] = FEATURES) -> str:
    """The value that the split gives to a row."""
    x = " ".join(f"WHEN '{f}' THEN {f}" for f in features)
    return f"(SELECT CASE WHEN CASE feature {x} END <= threshold THEN mean_left ELSE mean_right END FROM {stump})"


def _metrics_sql(source: str) -> str:
    return f"""count(*) AS n_valid, round(1 - sum((tmax - p) * (tmax - p)) / (var_pop(tmax) * count(*)), {P}) AS r2,
       round(sqrt(avg((tmax - p) * (tmax - p))), {P}) AS rmse FROM {source}"""


TRAIN, VALID = "(uid + datediff('day', DATE '1970-01-01', t.date)) % 4 >= 1", "(uid + datediff('day', DATE '1970-01-01', t.date)) % 4 < 1"


def _tree(depth: int = 1) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(featuresCol="features", labelCol="tmax", maxDepth=depth, maxBins=BINS)


def _stages(model, features=FEATURES, prior_day: bool = False):
    return [*([prior_day_stage()] if prior_day else []), SQLTransformer(statement=BAND_SQL),
            VectorAssembler(inputCols=features, outputCol="features"), model]


def _split_pairs(spark, sf_dir, scope: Scope):
    """(train, validation): pairs of days are made first, pruned and kept once for fitting and scoring."""
    pairs = prior_day_stage().transform(daily_weather(spark, sf_dir)).withColumn(
        "split_key", F.col("station").cast("long") + F.datediff("date", F.lit("1970-01-01")))
    return stable_split(scope.keep(pairs), F.col("split_key"))


@register("ml_glm", f"""
WITH {DAILY_SQL}, {_pairs_sql("train", where=TRAIN)},
m AS (
  SELECT count(*) AS n, regr_slope(tmax, yesterday_tmax) AS s, regr_intercept(tmax, yesterday_tmax) AS i,
         regr_r2(tmax, yesterday_tmax) AS r, var_pop(yesterday_tmax) AS c11, var_pop(elevation) AS c22,
         covar_pop(yesterday_tmax, elevation) AS c12, covar_pop(yesterday_tmax, tmax) AS c1y,
         covar_pop(elevation, tmax) AS c2y, var_pop(tmax) AS cyy, avg(tmax) AS my, avg(yesterday_tmax) AS m1, avg(elevation) AS m2
  FROM train),
two AS (
  SELECT *, (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) AS b1, (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) AS b2 FROM m)
SELECT 'yesterday' AS model, n, round(i, {P}) AS intercept, round(s, {P}) AS b_yesterday, NULL AS b_elevation,
       round(r, {P}) AS r2, 0.0 AS gap FROM m
UNION ALL
SELECT 'yesterday and elevation', n, round(my - b1 * m1 - b2 * m2, {P}), round(b1, {P}), round(b2, {P}),
       round((b1 * c1y + b2 * c2y) / cyy, {P}), 0.0 FROM two
""")
def ml_glm(spark, sf_dir):
    """Gaussian GLM on one and on two features by normal equations; ``gap`` is the largest difference to the
    coefficients of MLlib's GeneralizedLinearRegression on the same rows."""
    out = []
    with Scope(spark) as scope:
        train, _ = _split_pairs(spark, sf_dir, scope)
        for name, features in (("yesterday", ["yesterday_tmax"]), ("yesterday and elevation", ["yesterday_tmax", "elevation"])):
            model = fit_linear(train, features, "tmax")
            other = GeneralizedLinearRegression(featuresCol="features", labelCol="tmax", family="gaussian", link="identity").fit(
                VectorAssembler(inputCols=features, outputCol="features").transform(train))
            gap = max(abs(a - b) for a, b in zip([model.intercept, *model.coefficients], [other.intercept, *other.coefficients]))
            b = [*model.coefficients, None][:2]
            out.append((name, model.n, round(model.intercept, P), round(b[0], P), None if b[1] is None else round(b[1], P),
                        round(model.r2, P), round(float(gap), 4)))
    return spark.createDataFrame(out, "model string, n long, intercept double, b_yesterday double, b_elevation double, r2 double, gap double")


@register("ml_stump", f"""
WITH {DAILY_SQL}, td AS (SELECT * FROM d WHERE split_key % 4 >= 1),
{_pairs_sql("train", "td")}, {_pairs_sql("whole")}, {_stump_sql("best", "train")},
scored AS (SELECT *, {_leaf_sql("best")} AS p FROM whole)
SELECT feature, threshold, n_left, round(mean_left, {P}) AS mean_left, n_right, round(mean_right, {P}) AS mean_right,
       1.0 AS importance, m.* FROM best, (SELECT {_metrics_sql("scored")}) m
""")
def ml_stump(spark, sf_dir):
    """A pipeline (two SQL stages, assembler, regression tree of one split) fitted on the training days, saved,
    loaded again and applied to all days: the split, its leaves, its feature's importance, r2 and rmse. The SQL stage
    joins each split's own days (no two days in a row are held out, so the held-out ones alone have no pairs)."""
    with Scope(spark) as scope:
        daily = scope.keep(daily_weather(spark, sf_dir))
        train, _ = stable_split(daily, F.col("split_key"))
        path = scope.path("stump")
        Pipeline(stages=_stages(_tree(), prior_day=True)).fit(train).write().overwrite().save(path)
        model = PipelineModel.load(path)
        tree = model.stages[-1]
        split = tree._java_obj.rootNode().split()
        leaves = {r["prediction"]: r["n"] for r in model.transform(train).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).collect()}
        left, right = (tree._java_obj.rootNode().leftChild().prediction(), tree._java_obj.rootNode().rightChild().prediction())
        m = regression_metrics(model.transform(daily), "tmax").first()
        i = split.featureIndex()
        row = (FEATURES[i], float(split.threshold()), leaves[left], round(left, P), leaves[right], round(right, P),
               float(tree.featureImportances[i]), m["n"], round(m["r2"], P), round(m["rmse"], P))
    return spark.createDataFrame([row], "feature string, threshold double, n_left long, mean_left double, n_right long, "
                                        "mean_right double, importance double, n_valid long, r2 double, rmse double")


def _variant_sql(name: str, features: list[str]) -> str:
    return f"""SELECT '{name}' AS variant, {_metrics_sql(f"(SELECT *, {_leaf_sql(name, features)} AS p FROM valid)")}"""


@register("ml_stump_ablation", f"""
WITH {DAILY_SQL}, {_pairs_sql("train", where=TRAIN)}, {_pairs_sql("valid", where=VALID)},
{_stump_sql("with_yesterday", "train")}, {_stump_sql("without_yesterday", "train", features=FEATURES[:-1])}
{_variant_sql("with_yesterday", FEATURES)} UNION ALL {_variant_sql("without_yesterday", FEATURES[:-1])}
""")
def ml_stump_ablation(spark, sf_dir):
    """The same one-split tree with and without yesterday's value among its features."""
    out = []
    with Scope(spark) as scope:
        train, valid = _split_pairs(spark, sf_dir, scope)
        for name, features in (("with_yesterday", FEATURES), ("without_yesterday", FEATURES[:-1])):
            m = regression_metrics(Pipeline(stages=_stages(_tree(), features)).fit(train).transform(valid), "tmax").first()
            out.append((name, m["n"], round(m["r2"], P), round(m["rmse"], P)))
    return spark.createDataFrame(out, "variant string, n_valid long, r2 double, rmse double")


@register("ml_boosted_stumps", f"""
WITH {DAILY_SQL}, {_pairs_sql("train", where=TRAIN)}, {_pairs_sql("valid", where=VALID)},
{_stump_sql("first", "train")},
rest AS (SELECT *, 2 * (tmax - {_leaf_sql("first")}) AS residual FROM train),
{_stump_sql("second", "rest", "residual")},
scored AS (SELECT *, {_leaf_sql("first")} + 0.1 * {_leaf_sql("second")} AS p FROM valid)
SELECT 'gbt' AS model, {_metrics_sql("scored")}
""")
def ml_boosted_stumps(spark, sf_dir):
    """Gradient-boosted trees, two of one split each (the second fits twice the residual and counts a tenth)."""
    with Scope(spark) as scope:
        train, valid = _split_pairs(spark, sf_dir, scope)
        gbt = GBTRegressor(featuresCol="features", labelCol="tmax", maxDepth=1, maxIter=2, stepSize=0.1, maxBins=BINS)
        m = regression_metrics(Pipeline(stages=_stages(gbt)).fit(train).transform(valid), "tmax").first()
    return spark.createDataFrame([("gbt", m["n"], round(m["r2"], P), round(m["rmse"], P))],
                                 "model string, n_valid long, r2 double, rmse double")


@register("ml_stump_next_day", f"""
WITH {DAILY_SQL}, {_pairs_sql("train", where=TRAIN)}, {_stump_sql("best", "train")},
latest AS (SELECT station, date + 1 AS date, tmax, CAST(station AS BIGINT) AS uid FROM d QUALIFY date = max(date) OVER (PARTITION BY station)),
f AS (
  SELECT station, date, CAST(30 + uid % 30 AS DOUBLE) AS latitude, CAST(uid % 40 - 120 AS DOUBLE) AS longitude,
         CAST(uid % 25 * 40 AS DOUBLE) AS elevation, CAST(dayofyear(date) AS DOUBLE) AS day_of_year,
         CAST(least(floor(tmax / 20), 50) AS DOUBLE) AS yesterday_band FROM latest)
SELECT station, strftime(date, '%Y-%m-%d') AS date, round({_leaf_sql("best")}, 4) AS predicted_tmax FROM f
""")
def ml_stump_next_day(spark, sf_dir):
    """Tomorrow's value of every station: a placeholder row after its latest day, which the pipeline's own SQL
    stage joins with that day, scored by a one-split tree."""
    daily = daily_weather(spark, sf_dir)
    with Scope(spark) as scope:
        train, _ = _split_pairs(spark, sf_dir, scope)
        model = Pipeline(stages=_stages(_tree())).fit(train)
    last = daily.groupBy("station").agg(F.max("date").alias("date"))
    latest = daily.join(last, ["station", "date"], "left_semi")
    tomorrow = latest.withColumn("date", F.date_add("date", 1)).withColumn("tmax", F.lit(0.0))
    # every pair here is a latest day with its placeholder
    scored = model.transform(prior_day_stage().transform(latest.unionByName(tomorrow)))
    return scored.select("station", F.date_format("date", "yyyy-MM-dd").alias("date"),
                         F.round("prediction", 4).alias("predicted_tmax"))
