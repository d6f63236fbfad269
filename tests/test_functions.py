"""Scalar functions on rows whose results are known."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchloom.functions import dates, names, outcomes, rounding, rules, scores


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def test_rating_weight_order(spark):
    cases = {
        "FIFA World Cup": 60,
        "FIFA World Cup qualification": 30,
        "UEFA Euro qualification": 40,
        "Copa América": 40,
        "African Cup of Nations": 30,
        "Friendly": 20,
        "Other Cup": 30,
    }
    got = values(spark, [(k,) for k in cases], "c string", "c", rules.rating_weight(F.col("c")))
    assert dict(got) == cases
    assert values(spark, [(None,)], "c string", rules.rating_weight(F.col("c"))) == [(30,)]


def test_stage_category_order(spark):
    cases = {
        "Group A": "Group Stage",
        " First round ": "Group Stage",
        "Match for third place": "Other",
        "Third place": "Third Place",
        "Quarter-finals": "Knockout Stage",
        "Quarter-Finals": "Final",
        "Final": "Final",
        None: "Unknown",
    }
    got = values(spark, [(k,) for k in cases], "c string", "c", rules.stage_category(F.col("c")))
    assert dict(got) == cases


def test_feature_groups_and_tiers(spark):
    got = values(spark, [("elo_diff",), ("goals_scored_diff",), ("win_percentage_diff",), ("home_win_percentage",), ("x",)], "c string", rules.feature_group(F.col("c")))
    assert [g for (g,) in got] == ["ELO", "Goals", "Win Gap", "Win Rate", "Other"]
    got = values(spark, [(15.0,), (14.9,), (3.0,), (2.9,)], "c double", rules.tier(F.col("c")))
    assert [g for (g,) in got] == ["Top Favourite", "Contender", "Dark Horse", "Underdog"]


def test_rounding_half_away_from_zero(spark):
    got = values(spark, [(2.675, -2.675), (0.125, -0.125), (0.0, -0.001)], "a double, b double", rounding.round_half_up(F.col("a"), 2), rounding.round_half_up(F.col("b"), 2))
    assert got == [(2.68, -2.68), (0.13, -0.13), (0.0, 0.0)]
    assert str(got[2][1]) == "0.0"


def test_names(spark):
    rows = [("  USA ",), ("Türkiye",), ("Peru",), (None,)]
    assert values(spark, rows, "c string", names.canonical_name(F.col("c"))) == [("United States",), ("Turkey",), ("Peru",), (None,)]
    rows = [("Côte  d’Ivoire",), ("St. Kitts, (and) Nevis",), ("  ",), (None,), ("ﬁnal—é",)]
    assert values(spark, rows, "c string", names.normalized_id(F.col("c"))) == [("cote d'ivoire",), ("st kitts and nevis",), ("",), ("",), ("final-e",)]


def test_dates(spark):
    rows = [(2001, None), (2001, 1), (2001, 2)]
    got = values(spark, rows, "y int, h int", dates.effective_date(F.col("y"), F.col("h")))
    assert [g for (g,) in got] == [dt.date(2001, 1, 1), dt.date(2001, 1, 1), dt.date(2001, 7, 1)]
    rows = [("13 Jul 1930 - 15:00",), ("soon",), ("31 Feb 1930 -",), (None,)]
    got = values(spark, rows, "c string", dates.text_date(F.col("c")), dates.text_time(F.col("c")))
    assert got == [(dt.date(1930, 7, 13), "15:00"), (None, ""), (None, ""), (None, "")]


def test_outcomes_with_null_scores(spark):
    h, a = F.col("h"), F.col("a")
    got = values(spark, [(2, 1), (1, 1), (0, 1), (None, 1)], "h int, a int", outcomes.outcome_text(h, a), outcomes.outcome_label(h, a), outcomes.points(a, h))
    assert got == [("home_win", 2, 0), ("draw", 1, 1), ("away_win", 0, 3), (None, None, None)]
    assert values(spark, [("TRUE",), ("no",), (None,)], "c string", outcomes.flag(F.col("c"))) == [(1,), (0,), (0,)]


def test_probabilities_sum_to_one_and_hosts_gain(spark):
    p = scores.outcome_probabilities(F.col("h"), F.col("a"), F.col("hh"), F.col("ah"))
    got = values(spark, [(1500.0, 1500.0, False, False), (1500.0, 1500.0, True, False), (2400.0, 1000.0, True, False)], "h double, a double, hh boolean, ah boolean", *p.values())
    assert all(abs(sum(r) - 1) < 1e-12 for r in got)
    assert got[0] == pytest.approx((0.36, 0.28, 0.36))
    assert got[1][0] > got[0][0]
    # A big gap leaves the smallest draw share and the host cap, before rescaling.
    assert got[2][1] / got[2][0] == pytest.approx(0.15 / min(0.85 / (1 + 10 ** (-1400 / 400)) + 0.04, 0.90))


def test_axis_and_scaling(spark):
    got = values(spark, [(1650.0,), (1000.0,), (3000.0,)], "v double", scores.axis_score(F.col("v"), 1200.0, 2100.0))
    assert [g for (g,) in got] == [50.0, 0.0, 100.0]
    assert values(spark, [(1.0,)], "v double", scores.axis_score(F.col("v"), 200.0, 1.0)) == [(100.0,)]
    assert values(spark, [(1.0, None, 4.0), (None, None, None)], "a double, b double, c double", scores.row_mean(F.col("a"), F.col("b"), F.col("c"))) == [(2.5,), (None,)]
    assert values(spark, [(5.0, 5.0, 5.0)], "v double, l double, h double", scores.min_max(F.col("v"), F.col("l"), F.col("h"))) == [(1.0,)]
