"""Round models on pyspark.ml: training with early stop, importances, counterfactual scoring, two stages, comparisons."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .analysis import hash_split, r, regression_metrics, top_bottom
from .core import dmean
from .ranked import exact_quantiles, joined
from .scenarios import envelope, score_scenarios
from .shared import stored

NUMERIC = ["player_rating", "hole_count", "round_total_hole_length", "round_total_par", "wind_mean", "gust_mean", "temp_mean", "precip_sum"]
CATEGORICAL = ["division"]
TARGET = "actual_round_strokes"
ROUND_KEYS = ["tourn_id", "round_number", "player_key"]


def references() -> dict[str, dict[str, Column]]:
    """Columns set to reference weather: 0 mph, 1 mph of gust, 80 F, dry."""
    wind = {"wind_mean": F.lit(0.0), "gust_mean": F.lit(1 / 2.23694)}
    temperature, precip = {"temp_mean": F.lit((80 - 32) * 5 / 9)}, {"precip_sum": F.lit(0).cast("bigint")}
    return {"wind": wind, "temperature": temperature, "precip": precip, "total": wind | temperature | precip}


def _stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in categorical]
    return [*indexers, VectorAssembler(inputCols=[*numeric, *(f"{c}__i" for c in categorical)], outputCol="features", handleInvalid="skip")]


def train_rounds(df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, target: str = TARGET, key: str = "tourn_id", trees: int = 40, depth: int = 4) -> tuple[PipelineModel, DataFrame]:
    """(model, metrics by split). Whole keys are split 64/16/20; trees stop when the middle part no longer improves."""
    d = hash_split(df.dropna(subset=[*numeric, target]), key, {"train": 64, "valid": 16, "test": 20}).withColumn("label", F.col(target).cast("double"))
    fitted = d.where("split != 'test'").withColumn("is_valid", F.col("split") == "valid")
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.1, seed=42, validationIndicatorCol="is_valid")
    model = Pipeline(stages=[*_stages(numeric, categorical), gbt]).fit(fitted)
    return model, regression_metrics(model.transform(d), ["split"], "label", "prediction")


def importances(model, spark) -> DataFrame:
    if hasattr(model, "importances"):
        return model.importances(spark)
    names = model.stages[-2].getInputCols()
    rows = [(n, float(v)) for n, v in zip(names, model.stages[-1].featureImportances.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def _without(df: DataFrame, model) -> DataFrame:
    """df without columns that the model's stages would write."""
    stages = getattr(model, "stages", [])
    made = {"features", "prediction", "rawPrediction", *(c for s in stages if (c := getattr(s, "getOutputCol", lambda: None)()))}
    return df.drop(*(c for c in made if c in df.columns))


def score_rounds(df: DataFrame, model, scenarios: dict[str, dict[str, Column]] | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """df with predicted, and predicted_<name>_reference and <name>_impact for each scenario, whose columns are replaced.

    All scenarios go through the model in one pass; keys tell rows apart (by default the keys of rounds).
    """
    return score_scenarios(_without(df, model), model, references() if scenarios is None else scenarios, ROUND_KEYS if keys is None else keys)


def thresholds(model, column: str) -> list[float]:
    """All values at which a model's trees are split by a column, ascending. Of pyspark.ml trees they are read from the
    printed trees, which have them in full."""
    if hasattr(model, "thresholds"):
        return model.thresholds(column)
    at = model.stages[-2].getInputCols().index(column)
    return sorted({float(x) for x in re.findall(rf"\(feature {at} <= ([^)]+)\)", model.stages[-1].toDebugString)})


def score_monotone(df: DataFrame, model, column: str, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """df with predictions that never fall as column grows: the largest of the model's at the value and at all its trees'
    thresholds below. Predictions change at thresholds only, so this holds for any two values. Models trained by
    boosting.train_monotone need no such step."""
    return envelope(_without(df, model), model, column, thresholds(model, column), ROUND_KEYS if keys is None else keys, name)


def effect_curve(df: DataFrame, effects: dict[float, Column]) -> DataFrame:
    """(x, n, mean, median, std, p10, p90) of effects against a reference, one column for each value x of a grid."""
    wide = stored(df.select(*(e.cast("double").alias(f"e{i}") for i, e in enumerate(effects.values()))))
    pairs = F.array(*(F.struct(F.lit(x).alias("x"), F.col(f"e{i}").alias("e")) for i, x in enumerate(effects)))
    long = wide.select(F.explode(pairs).alias("p")).select("p.x", "p.e")
    out = long.groupBy("x").agg(F.count("e").alias("n"), r(dmean("e")).alias("mean"), r(F.stddev_pop("e")).alias("std"))
    return joined(out, exact_quantiles(long, ["x"], "e", {"median": 0.5, "p10": 0.1, "p90": 0.9}, 4), ["x"])


def monotone_curve(curve: DataFrame, x: str, y: str, weight: str, name: str) -> DataFrame:
    """curve (a row for each x) with y made non-decreasing by pooling neighbours, weighted."""
    from pyspark.ml.regression import IsotonicRegression

    d = curve.withColumns({"features": F.col(x).cast("double"), "label": F.col(y).cast("double"), "__w": F.col(weight).cast("double")})
    return IsotonicRegression(weightCol="__w", predictionCol=name).fit(d).transform(d).drop("features", "label", "__w")


def course_response(df: DataFrame, course: str, effect: str, n: int = 20) -> DataFrame:
    """Mean and median effect of the n courses that respond most, and of the n that respond least."""
    df = stored(df.select(course, effect))
    per = df.groupBy(course).agg(F.count("*").alias("n"), r(dmean(effect)).alias("mean_effect"))
    return top_bottom(joined(per, exact_quantiles(df, [course], effect, {"median_effect": 0.5}, 4), [course]), "mean_effect", [course], n)


def spline_terms(df: DataFrame, weather: Sequence[str], linear: Sequence[str], knots: int) -> dict[str, Column]:
    """Cubic splines of weather, with knots at quantiles of df, and linear terms as they are."""
    at = df.agg(*(F.percentile_approx(F.col(c).cast("double"), [(i + 1) / (knots + 1) for i in range(knots)], 10_000).alias(c) for c in weather)).first()
    terms = {}
    for c in weather:
        x = F.col(c).cast("double")
        terms |= {f"__{c}_{p}": F.pow(x, p) for p in (1, 2, 3)}
        terms |= {f"__{c}_k{i}": F.pow(F.greatest(x - F.lit(k), F.lit(0.0)), 3) for i, k in enumerate(sorted(set(at[c] or [])))}
    return {**terms, **{f"__{c}": F.col(c).cast("double") for c in linear}}


def fold_of(key: str, folds: int, seed: int = 0) -> Column:
    """A fold for each whole key: the same one each time."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def cross_validated(df: DataFrame, stages: Sequence, estimator, grid: Sequence[dict], key: str, folds: int = 5, parallelism: int = 2) -> tuple[PipelineModel, DataFrame]:
    """(model fitted to all rows with the best setting, rmse by setting and fold). Folds are whole keys, so that rows of one
    event are never on both sides; df needs the columns label and what stages read. stages are fitted inside each fold."""
    ids = [r_[0] for r_ in df.select(fold_of(key, folds)).distinct().collect()]
    dense = {f: i for i, f in enumerate(sorted(ids))}  # the validator wants no empty fold
    if len(dense) < 2:
        raise ValueError(f"cross-validation needs events of at least two folds, there is {len(dense)}")
    number = F.element_at(F.create_map(*(F.lit(x) for pair in dense.items() for x in pair)), F.col("__fold_of"))
    d = df.withColumn("__fold_of", fold_of(key, folds)).withColumn("__fold", number).drop("__fold_of")
    params = [{estimator.getParam(n): v for n, v in g.items()} for g in grid]
    validator = CrossValidator(
        estimator=Pipeline(stages=[*stages, estimator]), estimatorParamMaps=params, evaluator=RegressionEvaluator(metricName="rmse"), numFolds=len(dense), foldCol="__fold", parallelism=parallelism, collectSubModels=True
    )
    fitted = validator.fit(d)
    names = [json.dumps(g, sort_keys=True) for g in grid]
    # the validator gives means over folds only, so each fold's model is measured on its own rows
    scores = [
        regression_metrics(m.transform(d.where(F.col("__fold") == f)), [], "label", "prediction").select(F.lit(names[i]).alias("setting"), F.lit(f).alias("fold"), "rows", "rmse")
        for f, models in enumerate(fitted.subModels) for i, m in enumerate(models)
    ]
    return fitted.bestModel, reduce(DataFrame.unionByName, scores)


def spline_ridge(df: DataFrame, weather: Sequence[str], linear: Sequence[str], target: str, key: str, knots: int = 4, alphas: Sequence[float] = (0.1, 1.0, 10.0), folds: int = 5) -> tuple[PipelineModel, DataFrame, float, DataFrame]:
    """(model, metrics by split, alpha, rmse by alpha and fold) of ridge regression on cubic splines of weather and scaled
    linear terms. A fifth of the keys is the test part; alpha is chosen by cross-validation over folds of whole keys of the others."""
    d = hash_split(df.dropna(subset=[*weather, *linear, target]), key, {"train": 80, "test": 20}).withColumn("label", F.col(target).cast("double"))
    train = d.where("split = 'train'")
    terms = spline_terms(train, weather, linear, knots)
    d, train = d.withColumns(terms), train.withColumns(terms)
    before = [VectorAssembler(inputCols=list(terms), outputCol="__raw"), StandardScaler(inputCol="__raw", outputCol="features", withMean=True)]
    ridge = LinearRegression(elasticNetParam=0.0)
    model, scores = cross_validated(train, before, ridge, [{"regParam": float(a)} for a in alphas], key, folds)
    alpha = model.stages[-1].getOrDefault("regParam")
    return model, regression_metrics(model.transform(d), ["split"], "label", "prediction"), alpha, scores.withColumn("alpha", F.get_json_object("setting", "$.regParam").cast("double")).drop("setting")


def ideal_conditions(df: DataFrame, model: PipelineModel, grid: dict[str, Sequence[float]]) -> DataFrame:
    """The scenario of the grid with the least mean prediction, and for each of its columns whether it lies on the edge."""
    spark = df.sparkSession
    rows = list(product(*grid.values()))
    scenarios = spark.createDataFrame([tuple(map(float, x)) for x in rows], ", ".join(f"`{c}` double" for c in grid))
    scored = model.transform(df.drop(*grid).crossJoin(F.broadcast(scenarios)))
    mean = scored.groupBy(*grid).agg(F.count("*").alias("n"), r(dmean("prediction")).alias("mean_prediction"))
    best = mean.orderBy("mean_prediction", *grid).limit(1)
    return best.withColumns({f"{c}_on_edge": F.col(c).isin(float(min(v)), float(max(v))) for c, v in grid.items()})


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """A row for each model: rmse and r2 by split, the best test rmse first."""
    long = reduce(DataFrame.unionByName, [m.withColumn("model", F.lit(name)) for name, m in metrics.items()])
    wide = long.groupBy("model").pivot("split", ["train", "valid", "test"]).agg(F.first("rmse").alias("rmse"), F.first("r2").alias("r2"))
    return wide.orderBy(F.col("test_rmse").asc_nulls_last(), "model")


def linear_benchmark(df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL, target: str = TARGET, key: str = "tourn_id") -> DataFrame:
    """Metrics by split of ridge regression on imputed, scaled and one-hot inputs."""
    d = hash_split(df.where(F.col(target).isNotNull()), key, {"train": 80, "test": 20}).withColumn("label", F.col(target).cast("double")).withColumns({c: F.col(c).cast("double") for c in numeric})
    stages = [
        Imputer(inputCols=list(numeric), outputCols=[f"{c}__f" for c in numeric], strategy="median"), VectorAssembler(inputCols=[f"{c}__f" for c in numeric], outputCol="__n"),
        StandardScaler(inputCol="__n", outputCol="__s", withMean=True), *(StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in categorical),
        OneHotEncoder(inputCols=[f"{c}__i" for c in categorical], outputCols=[f"{c}__o" for c in categorical]), VectorAssembler(inputCols=["__s", *(f"{c}__o" for c in categorical)], outputCol="features"),
        LinearRegression(elasticNetParam=0.0, regParam=1.0),
    ]
    model = Pipeline(stages=stages).fit(d.where("split = 'train'"))
    return regression_metrics(model.transform(d), ["split"], "label", "prediction")


def two_stage(df: DataFrame, weather: Sequence[str] = ("wind_mean", "gust_mean", "temp_mean", "precip_sum"), target: str = TARGET, key: str = "tourn_id") -> DataFrame:
    """df with stage1 (without weather), stage2 (weather on the residual) and their sum as predicted."""
    base = [c for c in NUMERIC if c not in weather]
    first, _ = train_rounds(df, base, CATEGORICAL, target, key)
    d = first.transform(df.dropna(subset=NUMERIC)).withColumnRenamed("prediction", "stage1").drop("features", "division__i")
    d = d.withColumn("__residual", F.col(target) - F.col("stage1"))
    second, _ = train_rounds(d, list(weather), [], "__residual", key)
    return second.transform(d).withColumnRenamed("prediction", "stage2").drop("features", "__residual").withColumn("predicted", F.col("stage1") + F.col("stage2"))


def run_experiments(df: DataFrame, feature_sets: dict[str, Sequence[str]], target: str = TARGET) -> DataFrame:
    """Metrics of models on several feature sets, the best test rmse first."""
    rows = [train_rounds(df, numeric, CATEGORICAL, target)[1].withColumn("feature_set", F.lit(name)) for name, numeric in feature_sets.items()]
    return reduce(DataFrame.unionByName, rows).where("split = 'test'").orderBy("rmse", "mae", "feature_set")


def save_bundle(spark, model: PipelineModel, manifest: dict, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def load_bundle(spark, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/manifest").first()["value"])
