"""Modelling jobs over the match features.

A fit has no SQL, but what the tables determine about it has: the queries with a statement return test rows with a property
that every right model has, and the statements say how many rows there are. The figures themselves (metrics, ranks,
importances, probabilities) are returned by the queries whose names end in ``_figures``; those have no statement.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.operators import models as M
from matchloom.operators.features import FEATURES
from matchloom.operators.metrics import mean_importance
from matchloom.operators.ordered import chronological_split, time_folds
from matchloom.operators.ranks import report_ranks
from matchloom.plans import views as V
from matchloom.plans.oracle_views import VIEWS, rnd
from matchloom.plans.registry import query
from matchloom.storage import materialize, new_path

SETTINGS = M.Settings()

VIEWS["model_split"] = """
SELECT pool, seq, label, CASE WHEN row_number() OVER (ORDER BY date, pool, home_team, away_team) <= floor((SELECT count(*) FROM match_features) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM match_features
"""


def split(spark, sf):
    def build():
        keyed = chronological_split(V.match_features(spark, sf), ["date", "pool"], ["home_team", "away_team"], 0.8)
        return M.feature_contract(keyed, keep=("pool", "seq", "home_team", "away_team", "split"))

    return V.stored(spark, sf, "model_rows", build)


_MODELS: dict = {}


def trained(spark, sf, name):
    """Model of the training rows, fitted once per session and input."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MODELS:
        _MODELS[key] = M.train(name, split(spark, sf).filter(F.col("split") == "train"), SETTINGS)
    return _MODELS[key]


def test_rows(spark, sf):
    return split(spark, sf).filter(F.col("split") == "test")


@query("m1_feature_contract", f"SELECT pool, seq, {', '.join(f'coalesce({c}, 0)::DOUBLE AS {c}' for c in FEATURES)}, label FROM match_features")
def contract(spark, sf):
    return M.feature_contract(V.match_features(spark, sf), keep=("pool", "seq"))


@query(
    "m2_standardize",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"{rnd(f'(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem))', 5)} AS {c}" for c in ("l_quantity", "l_extendedprice"))
    + " FROM lineitem",
)
def standardize(spark, sf):
    columns = ["l_quantity", "l_extendedprice"]
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *columns)
    return M.standardize(lines, columns).withColumns({c: round_half_up(F.col(c), 5) for c in columns})


_COUNTS = "SELECT label, count(*) AS test_rows, count(*) AS scored, {extra} FROM model_split WHERE split = 'test' GROUP BY label"


def _scored(spark, sf, name):
    """Test rows with the probabilities of their three outcomes in percent."""
    return M.score_fixtures(trained(spark, sf, name), test_rows(spark, sf))


def _facts(scored, **extra):
    """Per class the test rows, and those whose percents add up and whose largest one is the prediction."""
    percents = [F.col(c) for c in ("away_pct", "draw_pct", "home_pct")]
    whole = F.abs(percents[0] + percents[1] + percents[2] - 100) <= 0.001
    largest = F.element_at(F.array(*percents), F.col("pred") + 1) >= F.greatest(*percents)
    counted = scored.groupBy("label").agg(F.count(F.lit(1)).alias("test_rows"), F.count(F.when(whole & largest, 1)).alias("scored"))
    return counted.withColumns({k: F.lit(v) for k, v in extra.items()})


@query("m3_logreg", _COUNTS.format(extra="TRUE AS optimal"))
def logreg(spark, sf):
    """With the gradient of the penalised loss at the fitted coefficients, which vanishes at the optimum."""
    model = trained(spark, sf, "logistic_regression")
    steepest = M.largest_slope(model, split(spark, sf).filter(F.col("split") == "train"), SETTINGS)
    return _facts(_scored(spark, sf, "logistic_regression"), optimal=steepest < 1e-3)


@query("m4_forest", _COUNTS.format(extra=f"{M.Settings().forest_trees} AS trees"))
def forest(spark, sf):
    return _facts(_scored(spark, sf, "random_forest"), trees=trained(spark, sf, "random_forest").tree_count)


@query("m5_boosted", _COUNTS.format(extra=f"{3 * M.Settings().boost_rounds} AS trees"))
def boosted(spark, sf):
    return _facts(_scored(spark, sf, "boosted_trees"), trees=trained(spark, sf, "boosted_trees").tree_count)


def _own_metrics(name):
    """Figures of one model on the test rows; fits that one only."""
    figures = lambda spark, sf: M.model_metrics(name, M.predict(trained(spark, sf, name), test_rows(spark, sf)).select("label", "pred"))
    return lambda spark, sf: V.stored(spark, sf, f"metrics_{name}", lambda: figures(spark, sf))


def metrics(spark, sf):
    """Figures of all models on the test rows."""
    return reduce(lambda a, b: a.unionByName(b), [_own_metrics(n)(spark, sf) for n in M.NAMES])


for _code, _name in (("m3_logreg", "logistic_regression"), ("m4_forest", "random_forest"), ("m5_boosted", "boosted_trees")):
    query(f"{_code}_figures")(_own_metrics(_name))


@query("m6_model_table_figures")
def model_table_figures(spark, sf):
    """model_name, accuracy, f1_macro, f1_weighted, confusion_matrix, performance_rank, best."""
    table = metrics(spark, sf)
    best = M.best_model(table).select("model_name", F.lit(True).alias("best"))
    return report_ranks(table, {"accuracy": "performance_rank"}).join(best, "model_name", "left").fillna({"best": False})


@query(
    "m6_model_table",
    f"SELECT unnest({list(M.NAMES)}) AS model_name, (SELECT count(*) FROM model_split WHERE split = 'test')::BIGINT AS test_rows, TRUE AS consistent",
)
def model_table(spark, sf):
    """Stored figures against hits counted from the predictions themselves; one model is the best."""
    table = metrics(spark, sf)
    cells = F.aggregate(F.flatten("confusion_matrix"), F.lit(0).cast("long"), lambda a, n: a + n)
    hits = F.col("confusion_matrix")[0][0] + F.col("confusion_matrix")[1][1] + F.col("confusion_matrix")[2][2]
    recount = reduce(
        lambda a, b: a.union(b),
        [M.predict(trained(spark, sf, n), test_rows(spark, sf)).agg(F.lit(n).alias("model_name"), F.count(F.when(F.col("label") == F.col("pred"), 1)).alias("right")) for n in M.NAMES],
    )
    best = M.best_model(table).select("accuracy").withColumnRenamed("accuracy", "a").scalar()
    same = (hits == F.col("right")) & (round_half_up(ratio(F.col("right"), cells), 4) == F.col("accuracy")) & (F.col("accuracy") <= best)
    return table.join(recount, "model_name").select("model_name", cells.alias("test_rows"), same.alias("consistent"))


FOLDS = 5


@query("m6_time_folds", f"SELECT pool, seq, ((row_number() OVER (ORDER BY date, pool, home_team, away_team) - 1) * {FOLDS + 1} // (SELECT count(*) FROM match_features))::INTEGER AS fold FROM match_features")
def folds(spark, sf):
    return time_folds(V.match_features(spark, sf), ["date", "pool"], ["home_team", "away_team"], FOLDS).select("pool", "seq", "fold")


@query("m6_cv_figures")
def cv_figures(spark, sf):
    """model_name, folds, cv_accuracy_mean, cv_accuracy_std of the quickest model; ``cross_validate`` takes any."""

    def build():
        rows = time_folds(V.match_features(spark, sf), ["date", "pool"], ["home_team", "away_team"], FOLDS)
        return M.cross_validate("logistic_regression", materialize(M.feature_contract(rows, keep=("fold",)), "folds"), SETTINGS)

    return V.stored(spark, sf, "model_cv", build)


@query("m6b_importance_figures")
def importance_figures(spark, sf):
    """feature, importance."""
    models = {n: trained(spark, sf, n) for n in ("random_forest", "boosted_trees")}
    return mean_importance(M.importances(models, split(spark, sf)))


@query("m6b_importance", f"SELECT unnest({list(FEATURES)}) AS feature, TRUE AS in_range, 1.0::DOUBLE AS total")
def importance(spark, sf):
    values = importance_figures(spark, sf)
    total = values.agg(round_half_up(F.sum("importance"), 6)).scalar()
    return values.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


@query(
    "m7_batch_score",
    """SELECT m.pool, m.seq, home_team, away_team, 100.0::DOUBLE AS total_pct, TRUE AS named FROM match_features m JOIN model_split s ON m.pool = s.pool AND m.seq = s.seq WHERE split = 'test'""",
)
def batch_score(spark, sf):
    scored = _scored(spark, sf, "boosted_trees")
    total = round_half_up(F.col("home_pct") + F.col("draw_pct") + F.col("away_pct"), 2)
    largest = F.greatest("home_pct", "draw_pct", "away_pct")
    named = F.when(F.col("outcome") == F.concat("home_team", F.lit(" Win")), F.col("home_pct")).when(F.col("outcome") == F.concat("away_team", F.lit(" Win")), F.col("away_pct")).otherwise(F.col("draw_pct"))
    return scored.select("pool", "seq", "home_team", "away_team", total.alias("total_pct"), (named == largest).alias("named"))


@query("m7_batch_score_figures")
def batch_score_figures(spark, sf):
    """Each test row with the percents of its three outcomes, the predicted class and its name."""
    return _scored(spark, sf, "boosted_trees").select("pool", "seq", "home_team", "away_team", "home_pct", "draw_pct", "away_pct", "pred", "outcome")


@query("m8_persistence", "SELECT pool, seq, TRUE AS same FROM model_split WHERE split = 'test'")
def persistence(spark, sf):
    """Predictions of a model before and after it was stored and loaded."""
    path = new_path(spark, "model")
    fitted = trained(spark, sf, "logistic_regression")
    M.save(fitted, path)
    model, features = M.load(path)
    assert tuple(features) == FEATURES
    before = M.predict(fitted, test_rows(spark, sf)).select("pool", "seq", "pred", vector_to_array("probability").alias("p"))
    after = M.predict(model, test_rows(spark, sf)).select("pool", "seq", F.col("pred").alias("pred_after"), vector_to_array("probability").alias("p_after"))
    return before.join(after, ["pool", "seq"]).select("pool", "seq", ((F.col("pred") == F.col("pred_after")) & (F.col("p") == F.col("p_after"))).alias("same"))
