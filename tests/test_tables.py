"""Table operators, sources and sinks on small rows, including the awkward ones."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from matchloom.functions.rounding import round_half_up
from matchloom.operators import aggregates as A
from matchloom.operators import clean, metrics, models, power, reshape
from matchloom.operators.columns import canonical_map, contains_anywhere, resolve_names
from matchloom.operators.features import FEATURES
from matchloom.plans import registry
from matchloom.sources import describe, readers, writers

registry.load()

PAIR = StructType([StructField("id", IntegerType()), StructField("name", StringType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedup_drops_nulls_first_and_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 7), ("b", 1, 5)], "k string, o int, score int")
    once = clean.first_per_key(clean.drop_nulls(df, "score"), ["k"], [F.col("o")])
    assert rows(once) == [("a", 2, 7), ("b", 1, 5)]
    assert rows(clean.first_per_key(once, ["k"], [F.col("o")])) == rows(once)


def test_latest_and_interval_rename(spark):
    df = spark.createDataFrame([("x", 1, 10), ("x", 3, None), ("y", 2, 5)], "k string, v int, a int")
    assert rows(clean.latest_per_key(df, ["k"], "v", ["a"])) == [("x", 3, None), ("y", 2, 5)]
    names = spark.createDataFrame([("New", "Old", dt.date(2000, 1, 1), dt.date(2000, 12, 31))], "current string, former string, start_date date, end_date date")
    facts = spark.createDataFrame([("Old", dt.date(2000, 12, 31)), ("Old", dt.date(2001, 1, 1)), ("Other", dt.date(2000, 5, 1))], "n string, d date")
    got = clean.rename_in_interval(facts, "n", "d", names).select("n", "d", "n_current")
    assert [r[2] for r in rows(got)] == ["New", "Old", "Other"]


def test_collapse_and_rollup_of_all_null_group(spark):
    df = spark.createDataFrame([("k", 1, None, 5), ("k", 2, "b", 9), ("k", 3, "c", 1)], "k string, o int, t string, n int")
    assert rows(A.collapse(df, "k", ["n"], ["t"], "o")) == [("k", 9, "b")]
    base = [(2000, "Final", "Final", 3, 1, 0, 0, None, 1), (2000, "Final", "Final", 2, 0, 0, 1, None, 0), (2000, "Group Stage", "Group A", 4, 0, 1, 0, 100, 2)]
    schema = "year int, stage_category string, stage string, total_goals int, home_win_flag int, away_win_flag int, draw_flag int, attendance bigint, margin_of_victory int"
    got = {(r.stage_category, r.stage): r for r in A.stage_rollup(spark.createDataFrame(base, schema)).collect()}
    assert got["Final", "Final"].avg_attendance is None and got["Final", "Final"].total_attendance == 0
    assert got["Overall", "Tournament"].matches_played == 3 and got["Overall", "Tournament"].total_goals == 9


def test_power_index_constant_column_and_missing_rank(spark):
    teams = spark.createDataFrame([("a", 1600.0, 5.0, 1, 70.0, 0.5), ("b", 1500.0, 5.0, None, 60.0, 0.4)], "team string, elo double, form double, rank int, player_strength double, win_pct double")
    odds = spark.createDataFrame([("a", 12.0)], "team string, championship_probability double")
    got = {r.team: r for r in power.power_index(teams, odds).collect()}
    assert got["a"].form_score_norm == got["b"].form_score_norm == 1.0
    assert got["b"].championship_probability == 0.0
    # The missing rank is the worst one; here all ranks become equal, so the column is constant.
    assert got["a"].rank_score_norm == got["b"].rank_score_norm == 0.0
    assert got["a"].power_index == pytest.approx(100 * (0.3 + 0.2 + 0.2 + 0.15)) and got["a"].power_rank == 1


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 0)], "label int, pred int")
    matrix = metrics.confusion_matrix(df)
    assert matrix.count() == 9
    report = {r.name: r for r in metrics.class_report(matrix).collect()}
    assert report["1"].precision == report["1"].f1 == 0.0
    assert report["accuracy"].f1 == 0.5 and report["0"].precision == 0.5
    weights = {r.label: r.weight for r in metrics.class_weights(df).collect()}
    assert weights == {0: pytest.approx(4 / (3 * 2)), 1: pytest.approx(4 / 3), 2: pytest.approx(4 / 3)}
    spread = {r.label: r.class_weight for r in models.with_class_weight(df).collect()}
    assert spread == weights


def test_head_to_head_ties_and_ranks(spark):
    p = spark.createDataFrame([("a", 1.0, 3.0), ("b", 1.0, 9.0)], "team string, elo double, rank double")
    pairs = spark.createDataFrame([("a", "b")], "a string, b string")
    got = {r.metric: r.better for r in reshape.head_to_head(p, pairs, "team", {"elo": "elo", "rank": "rank"}, ("rank",)).collect()}
    assert got == {"elo": "b", "rank": "a"}


def test_canonical_map_precedence(spark):
    first = spark.createDataFrame([("Côte d'Or",), ("Peru",)], "name string")
    second = spark.createDataFrame([("cote d’or",)], "name string")
    names = canonical_map([first, second], {"peru": "Perú"})
    asked = spark.createDataFrame([("COTE D'OR",), ("Peru.",), ("Mars",)], "n string")
    assert dict(rows(resolve_names(asked, "n", names, "c"))) == {"COTE D'OR": "cote d’or", "Peru.": "Perú", "Mars": ""}


def test_search_any_column(spark):
    df = spark.createDataFrame([(1, "Abc"), (42, None), (3, "xyz")], "id int, t string")
    assert rows(contains_anywhere(df, "B").select("id")) == [(1,)]
    assert rows(contains_anywhere(df, "42").select("id")) == [(42,)]


def test_csv_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,name\n1,a\nx,b\n")
    got = readers.read_csv(spark, str(tmp_path / "t.csv"), PAIR).collect()
    assert [(r.id, r.name, r._corrupt_record) for r in got] == [(1, "a", None), (None, "b", "x,b")]


def test_optional_and_fallback(spark, tmp_path):
    empty = readers.read_optional(spark, str(tmp_path / "none"), PAIR)
    assert empty.isEmpty() and empty.columns == ["id", "name"]
    full = spark.createDataFrame([(1, "a")], PAIR)
    got = readers.first_non_empty([(empty, {"id": "k"}), (full, {"id": "k"})])
    assert got.columns == ["k", "name"] and got.count() == 1


def test_json_report_array(spark, tmp_path):
    report = [{"model_name": "m", "confusion_matrix": [[1, 2], [3, 4]]}, {"model_name": "n", "confusion_matrix": [[5, 0], [0, 6]]}]
    (tmp_path / "r.json").write_text(json.dumps(report, indent=2))
    got = rows(readers.read_reports(spark, str(tmp_path / "r.json")))
    assert ("m", 1, 0, 3) in got and ("n", 1, 1, 6) in got and len(got) == 8


def test_summary_document(spark):
    table = spark.createDataFrame([("a", 1, 25.0), ("b", 3, 75.0)], "team string, n bigint, pct double")
    doc = writers.nested_summary(table, 4, "team", "n", "pct", top=1).first()
    assert doc.n_simulations == 4 and [r.team for r in doc.top_10] == ["b"] and [r.team for r in doc.all_results] == ["b", "a"]


def test_observed_row_count(spark):
    df, seen = describe.counted(spark.range(17), "n")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 17


def test_feature_contract(spark):
    with pytest.raises(ValueError, match="missing"):
        models.feature_contract(spark.range(1).withColumn("label", F.lit(1)))
    df = spark.range(2).select(*[F.lit(None).cast("double").alias(c) for c in FEATURES], F.when(F.col("id") == 0, 2).alias("label"))
    got = models.feature_contract(df).collect()
    assert len(got) == 1 and set(got[0][:-1]) == {0.0}


def test_model_learns_a_clear_signal(spark):
    df = spark.range(600).select((F.col("id") % 3).cast("int").alias("label"), F.lit("h").alias("home_team"), F.lit("a").alias("away_team"), *[(F.col("id") % 3 + F.lit(i) / 100).cast("double").alias(c) for i, c in enumerate(FEATURES)])
    quick = models.Settings(max_iter=30, forest_trees=5, forest_depth=4, boost_rounds=3)
    for name in models.NAMES:
        model = models.train(name, df, quick)
        scored = models.score_fixtures(model, df)
        assert scored.filter("pred = label").count() == 600
        assert scored.filter("abs(home_pct + draw_pct + away_pct - 100) > 0.001").isEmpty()
    for row in scored.limit(5).collect():
        assert sum(row.probability) == pytest.approx(1, abs=1e-12) and row.home_pct == pytest.approx(100 * row.probability[2], abs=1e-3)


def test_rounding_is_half_up(spark):
    row = spark.createDataFrame([(1.24999995, 1e17, -2.5, 0.125)], "a double, b double, c double, d double")
    got = row.select(round_half_up(F.col("a"), 1), round_half_up(F.col("b"), 4), round_half_up(F.col("c"), 0), round_half_up(F.col("d"), 2)).first()
    assert tuple(got) == (1.2, 1e17, -3.0, 0.13)


def test_key_universe_drops_null_keys(spark, tmp_path):
    for table, column in (("customer", "c_custkey"), ("orders", "o_custkey"), ("lineitem", "l_suppkey"), ("events", "user_id")):
        spark.createDataFrame([(1,), (None,)], f"{column} long").write.parquet(str(tmp_path / f"{table}.parquet"))
    assert [r.id for r in registry.QUERIES["u3_key_universe"](spark, str(tmp_path)).collect()] == [1]


def test_frequency_sums(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "t string")
    got = dict((r.t, (r.n, r.p)) for r in A.frequency_table(df, "t", "n", "p").collect())
    assert got == {"a": (3, 75.0), "b": (1, 25.0)}
