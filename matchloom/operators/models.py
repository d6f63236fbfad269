"""Outcome models: logistic regression with Spark ML, a random forest and boosted trees of this package."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.operators.boosting import BoostedTrees, Fit, train_boosted
from matchloom.operators.features import FEATURES
from matchloom.operators.forest import Forest, Growth, train_forest
from matchloom.operators.metrics import CLASSES, class_report, confusion_matrix
from matchloom.storage import materialize

NAMES = ("logistic_regression", "random_forest", "boosted_trees")


@dataclass(frozen=True)
class Settings:
    """Hyper-parameters of the three models."""

    inverse_penalty: float = 0.5
    max_iter: int = 1000
    forest_trees: int = 300
    forest_depth: int = 12
    forest_min_split: int = 20
    boost_rounds: int = 300
    boost_depth: int = 5
    boost_step: float = 0.05
    boost_subsample: float = 0.8
    boost_columns: float = 0.8
    seed: int = 42


def feature_contract(df: DataFrame, features: Sequence[str] = FEATURES, label: str = "label", keep: tuple[str, ...] = ()) -> DataFrame:
    """Features as double with nulls as 0, rows without a label dropped; a missing column is an error."""
    missing = [c for c in [*features, label] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    return df.filter(F.col(label).isNotNull()).select(*keep, *values, F.col(label).cast("int").alias(label))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean, unit population deviation; a constant column becomes 0. One scalar aggregate, no join."""
    moments = df.agg(F.struct(*[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("m", F.avg), ("s", F.stddev_pop))]).alias("z")).scalar()
    scaled = {c: F.coalesce((F.col(c) - F.col(f"__z.m_{c}")) / F.nullif(F.col(f"__z.s_{c}"), F.lit(0.0)), F.lit(0.0)) for c in columns}
    return df.withColumn("__z", moments).withColumns(scaled).drop("__z")


def with_class_weight(df: DataFrame, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """Add the balanced weight of each row's class. The counts are one scalar struct, so rows are not shuffled."""
    counts = [F.count(F.when(F.col("label") == c, 1)).alias(f"n{c}") for c in classes]
    sizes = df.agg(F.struct(F.count(F.lit(1)).alias("rows"), *counts).alias("c")).scalar()
    marked = df.withColumn("__c", sizes)
    size = lambda c: F.col(f"__c.n{c}")
    present = reduce(lambda a, b: a + b, [(size(c) > 0).cast("int") for c in classes])
    own = reduce(lambda expr, c: expr.when(F.col("label") == c, size(c)), classes[1:], F.when(F.col("label") == classes[0], size(classes[0])))
    return marked.withColumn("class_weight", ratio(F.col("__c.rows"), present * own)).drop("__c")


def estimator(name: str, rows: int, settings: Settings = Settings(), features: Sequence[str] = FEATURES) -> Estimator:
    """Pipeline of one of Spark's models. ``rows`` turns the inverse penalty into Spark's per-row penalty."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    s = settings
    if name == "logistic_regression":
        # Scaled by the sample deviation, which differs from the population one by sqrt(n / (n - 1)).
        scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
        fit = LogisticRegression(family="multinomial", weightCol="class_weight", maxIter=s.max_iter, regParam=1.0 / (s.inverse_penalty * rows), standardization=False)
        return Pipeline(stages=[assemble, scale, fit])
    raise ValueError(name)


Model = PipelineModel | Forest | BoostedTrees


def train(name: str, training: DataFrame, settings: Settings = Settings(), features: Sequence[str] = FEATURES) -> Model:
    if name == "boosted_trees":
        s = settings
        fit = Fit(rounds=s.boost_rounds, depth=s.boost_depth, step=s.boost_step, subsample=s.boost_subsample, columns=s.boost_columns, seed=s.seed)
        return train_boosted(training, features, classes=CLASSES, fit=fit)
    if name == "random_forest":
        s = settings
        growth = Growth(trees=s.forest_trees, depth=s.forest_depth, least_rows=max(1, s.forest_min_split // 2), seed=s.seed)
        return train_forest(training, features, classes=CLASSES, growth=growth)
    # Written out once: a fit reads its rows very many times. The file's row count costs no scan.
    weighted = materialize(with_class_weight(training), "training")
    return estimator(name, weighted.count(), settings, features).fit(weighted)


def largest_slope(model: PipelineModel, training: DataFrame, settings: Settings = Settings()) -> float:
    """Largest absolute component of the gradient of the penalised, weighted log loss at a logistic fit's coefficients."""
    fit = model.stages[-1]
    rows = model.transform(with_class_weight(training)).select("label", "class_weight", vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"))
    each = rows.select("label", "class_weight", "p", F.posexplode("x").alias("feature", "x"))
    error = lambda k: F.sum(F.col("class_weight") * F.col("x") * (F.col("p")[k] - (F.col("label") == k).cast("int")))
    slopes = each.groupBy("feature").agg(*[error(k).alias(f"k{k}") for k in CLASSES], F.sum("class_weight").alias("weight"), F.count(F.lit(1)).alias("rows"))
    penalty = F.lit(1.0) / (F.lit(settings.inverse_penalty) * F.col("rows"))
    weights = [F.get(F.array(*[F.lit(float(w)) for w in line]), F.col("feature")) for line in fit.coefficientMatrix.toArray()]
    steepest = F.greatest(*[F.abs(F.col(f"k{k}") / F.col("weight") + penalty * weights[k]) for k in CLASSES])
    return slopes.agg(F.max(steepest).alias("s")).first()["s"]


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``pred``."""
    return model.transform(df).withColumn("pred", F.col("prediction").cast("int"))


def score_fixtures(model: Model, fixtures: DataFrame, home: str = "home_team", away: str = "away_team") -> DataFrame:
    """Probability of each outcome in percent, the predicted class and its name, for a whole fixture table."""
    scored = predict(model, fixtures)
    p = vector_to_array("probability") if isinstance(model, PipelineModel) else F.col("probability")
    percent = lambda i: round_half_up(F.element_at(p, i + 1) * F.lit(100.0), 4)
    named: Column = F.when(F.col("pred") == 2, F.concat(home, F.lit(" Win"))).when(F.col("pred") == 0, F.concat(away, F.lit(" Win"))).otherwise("Draw")
    return scored.withColumns({"away_pct": percent(0), "draw_pct": percent(1), "home_pct": percent(2), "outcome": named})


def model_metrics(name: str, predictions: DataFrame) -> DataFrame:
    """One row: accuracy, macro and weighted F1 and the confusion matrix as an array of rows."""
    # Written out because two results read it, and behind it stands the scoring of all rows.
    matrix = materialize(confusion_matrix(predictions), "confusion")
    report = class_report(matrix)
    figure = lambda row: F.max(F.when(F.col("name") == row, F.col("f1")))
    one = report.agg(*[round_half_up(figure(r), 4).alias(c) for c, r in (("accuracy", "accuracy"), ("f1_macro", "macro avg"), ("f1_weighted", "weighted avg"))])
    line = matrix.groupBy("actual").agg(F.sort_array(F.collect_list(F.struct("predicted", "n")))["n"].alias("line"))
    cells = line.agg(F.sort_array(F.collect_list(F.struct("actual", "line")))["line"].alias("m")).scalar()
    return one.select(F.lit(name).alias("model_name"), "accuracy", "f1_macro", "f1_weighted", cells.alias("confusion_matrix"))


def cross_validate(name: str, rows: DataFrame, settings: Settings = Settings(), fold: str = "fold") -> DataFrame:
    """One row: mean and population deviation of the accuracy over the folds of ``time_folds``, each fitted on all before it."""
    spark, scores = rows.sparkSession, []
    for k in range(1, rows.agg(F.max(fold)).first()[0] + 1):
        model = train(name, rows.where(F.col(fold) < k).drop(fold), settings)
        hit = predict(model, rows.where(F.col(fold) == k)).agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("a")).first()["a"]
        scores.append((name, hit))
    table = spark.createDataFrame(scores, "model_name string, a double").groupBy("model_name")
    return table.agg(F.count("a").alias("folds"), round_half_up(F.avg("a"), 4).alias("cv_accuracy_mean"), round_half_up(F.stddev_pop("a"), 4).alias("cv_accuracy_std"))


def best_model(metrics: DataFrame, names: tuple[str, ...] = NAMES) -> DataFrame:
    """The row of highest accuracy; the model named first wins a tie."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model_name"))
    return metrics.orderBy(F.col("accuracy").desc(), place).limit(1)


def importances(models: dict[str, Model], df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, model, value) of the models that have importances."""
    rows = []
    for name, model in models.items():
        values = None if isinstance(model, PipelineModel) else model.importances()
        rows += [(f, name, float(values[i])) for i, f in enumerate(features) if values is not None]
    return df.sparkSession.createDataFrame(rows, "feature string, model string, value double")


def save(model: Model, path: str) -> None:
    """A pipeline holds its feature list in the assembler, trees in their text."""
    if not isinstance(model, PipelineModel):
        SparkSession.active().createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        model.write().overwrite().save(path)


def load(path: str) -> tuple[Model, list[str]]:
    spark = SparkSession.active()
    if not spark.read.format("binaryFile").option("pathGlobFilter", "part-*.txt").load(path).isEmpty():
        text = spark.read.text(path, wholetext=True).first()["value"]
        model = (BoostedTrees if "rounds" in json.loads(text) else Forest).from_json(text)
        return model, model.features
    model = PipelineModel.load(path)
    return model, list(model.stages[0].getInputCols())
