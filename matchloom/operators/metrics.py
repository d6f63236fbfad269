"""Model-quality tables over (label, prediction) rows and importances."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.functions.rules import feature_description, feature_group
from matchloom.functions.scores import min_max
from matchloom.operators.ranks import report_ranks

CLASSES = (0, 1, 2)
CLASS_NAMES = {0: "Away Win", 1: "Draw", 2: "Home Win"}


def confusion_matrix(predictions: DataFrame, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """(actual, predicted, n) for every pair of classes, zeros kept: one conditional count per cell."""
    cells = [(a, p) for a in classes for p in classes]
    hit = lambda a, p: F.count(F.when((F.col("label") == a) & (F.col("pred") == p), 1))
    one = predictions.agg(*[hit(a, p).alias(f"c{a}_{p}") for a, p in cells])
    rows = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}_{p}").alias("n")) for a, p in cells]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def class_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted means, accuracy; 0 for a zero division."""
    both = matrix.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("r")
    ).select("r.*")
    per_class = both.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    per_class = per_class.select(
        F.col("cls").cast("string").alias("name"),
        ratio(F.col("hit"), F.col("guessed"), 0.0).alias("precision"),
        ratio(F.col("hit"), F.col("support"), 0.0).alias("recall"),
        ratio(F.lit(2) * F.col("hit"), F.col("guessed") + F.col("support"), 0.0).alias("f1"),
        "support",
        "hit",
    )
    # One row per class by construction, so the class rows travel in an array beside their means:
    # the matrix, and whatever predicts behind it, is read once.
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    line = lambda name, value: F.struct(name.alias("name"), *[value(s).alias(s) for s in scores], total.alias("support"))
    one = per_class.agg(
        F.collect_list(F.struct("name", *scores, "support")).alias("classes"),
        line(F.lit("macro avg"), lambda s: F.avg(s)).alias("macro"),
        line(F.lit("weighted avg"), lambda s: ratio(F.sum(F.col(s) * F.col("support")), total, 0.0)).alias("weighted"),
        line(F.lit("accuracy"), lambda s: ratio(F.sum("hit"), total, 0.0)).alias("overall"),
    )
    return one.select(F.explode(F.concat("classes", F.array("macro", "weighted", "overall"))).alias("r")).select("r.*")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("t")).scalar()
    return counts.withColumn("__t", totals).withColumn("weight", ratio(F.col("__t.rows"), F.col("__t.classes") * F.col("n"))).drop("__t")


def mean_importance(values: DataFrame) -> DataFrame:
    """Importance per feature: (model, feature, value) normalised per model, then averaged over models."""
    share = ratio(F.col("value"), F.sum("value").over(Window.partitionBy("model")), 0.0)
    return values.withColumn("share", share).groupBy("feature").agg(F.avg("share").alias("importance"))


def scaled_importance(table: DataFrame) -> DataFrame:
    """Add rank, percent of the total and min-max scale to (feature, importance), one row per feature."""
    figures = table.agg(F.struct(F.sum("importance").alias("total"), F.min("importance").alias("low"), F.max("importance").alias("high")).alias("f")).scalar()
    marked = table.withColumn("__f", figures)
    percent = round_half_up(ratio(F.col("importance"), F.col("__f.total"), 0.0) * F.lit(100.0), 2)
    scale = round_half_up(min_max(F.col("importance"), F.col("__f.low"), F.col("__f.high")), 4)
    return report_ranks(marked.withColumns({"importance_pct": percent, "importance_norm": scale}).drop("__f"), {"importance": "importance_rank"})


def described_importance(table: DataFrame) -> DataFrame:
    return table.withColumns({"feature_group": feature_group(F.col("feature")), "description": feature_description(F.col("feature"))})
