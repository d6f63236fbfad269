"""The whole job on small files in the layout of the football data set."""

from __future__ import annotations

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators.models import Settings
from matchloom.plans import batch, cleaning

TEAMS = ["Spain", "USA", "IR Iran", "Peru", "Japan", "Soviet Union", "Ghana", "Chile"]


def write(path, header, lines):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *lines])


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    folder, rng = tmp_path_factory.mktemp("raw"), random.Random(8)
    games = []
    for i in range(300):
        home, away = rng.sample(TEAMS, 2)
        strong = TEAMS.index(home) < TEAMS.index(away)
        games.append([dt.date(1990, 1, 1) + dt.timedelta(days=i * 7), home, away, 2 + strong if rng.random() < 0.8 else 0, 1, rng.choice(["Friendly", "FIFA World Cup"]), rng.choice(["TRUE", "FALSE"])])
    games += [[games[0][0], f" {games[0][1]} ", *games[0][2:]], ["bad", "Spain", "Peru", 1, 1, "Friendly", "TRUE"], [games[5][0], "Spain", "Spain B", "", 1, "Friendly", "TRUE"]]
    write(folder / "all_matches.csv", cleaning.RAW_COLUMNS["all_matches"], games)
    ranks = [[y, s, r, t, 1000 + r, 900, 1] for y in range(1990, 1996) for s in (1, 2) for r, t in enumerate(rng.sample(TEAMS, 6), 1)]
    write(folder / "fifa_mens_rank.csv", cleaning.RAW_COLUMNS["fifa_mens_rank"], ranks)
    header = cleaning.RAW_COLUMNS["WorldCupMatches"]
    cup = []
    for i in range(20):
        row = dict.fromkeys(header, "") | {"Year": 1990 + 4 * (i % 2), "Datetime": "13 Jul 1990 - 15:00", "Stage": "Final" if i > 17 else "Group A", "Home Team Name": "Spain", "Away Team Name": " USA "}
        cup.append([(row | {"Home Team Goals": i % 4, "Away Team Goals": 1, "MatchID": i // 1, "Attendance": 1000 + i})[h] for h in header])
    write(folder / "WorldCupMatches.csv", header, cup + [cup[0]])
    players = [[t, v, 10, 60 + v, 80, "", "", "", "", "", "", 61, 62] for t in TEAMS[:6] for v in (23, 24)]
    write(folder / "player_aggregates.csv", cleaning.RAW_COLUMNS["player_aggregates"], players)
    write(folder / "former_names.csv", cleaning.RAW_COLUMNS["former_names"], [["Russia", "Soviet Union", "1924-01-01", "1991-12-25"]] * 2)
    return str(folder)


def test_run(spark, raw_dir, tmp_path):
    counts = [("Spain", 120), ("United States", 50), ("Perú", 20), ("Nowhere", 10)]
    odds = spark.createDataFrame([(t, n, n / 2) for t, n in counts], "team string, champion_count long, championship_probability double")
    quick = Settings(max_iter=20, forest_trees=4, forest_depth=4, boost_rounds=2)
    out = batch.run(spark, raw_dir, str(tmp_path / "out"), odds, settings=quick)
    features = out["match_features"]
    assert features.count() == 300
    assert features.filter("home_team = 'USA' or away_team = 'IR Iran'").isEmpty()
    profile = out["team_profiles"]
    assert profile.count() == 8 and abs(profile.agg(F.sum(F.col("elo_rating") - 1500)).first()[0]) < 0.01
    assert out["title_odds"].agg(F.sum("champion_count")).first()[0] == 200
    assert {r.team for r in out["team_rankings_dashboard"].collect()} >= {"Russia", "Spain", "United States"}
    assert "Soviet Union" not in {r.team for r in out["team_rankings_dashboard"].collect()}
    figures = {r.metric_name: r.value for r in out["executive_summary"].collect()}
    assert figures["total_matches"] == "20" and figures["total_tournaments"] == "2" and figures["simulation_runs"] == "200"
    assert [tuple(r) for r in out["unmatched_teams"].collect()] == [("Nowhere",)]
    assert out["evaluation_report"].count() == 3 and out["best_model"].count() == 1
    assert out["historical_match_summary"].filter("match_date is null or match_time <> '15:00'").isEmpty()
    assert spark.read.parquet(str(tmp_path / "out/clean/former_names")).count() == 1
    assert {r.dataset: r.n_rows for r in out["cleaning_report"].collect()} == {"all_matches": 300, "fifa_mens_rank": 72, "WorldCupMatches": 20, "player_aggregates": 6, "former_names": 1}
    assert {"avg_pace", "avg_passing", "avg_dribbling"} <= set(profile.columns)
    assert {"importance_rank", "importance_pct", "importance_norm", "feature_group", "description"} <= set(out["feature_importance"].columns) and out["feature_importance"].count() == 22
    assert {"simulation_runs", "probability_rank", "top_10_flag", "championship_probability_share"} <= set(out["championship_probabilities"].columns)
    assert {*cleaning.SUMMARY_EXTRAS, "match_date", "match_time", "stage_category", "result"} <= set(out["historical_match_summary"].columns)
    told = out["data_dictionary"].collect()
    assert {r.dataset for r in told} == {"executive_summary", "team_rankings", "team_rankings_dashboard", "dashboard_metadata", "championship_probabilities", "feature_importance", "historical_match_summary", "tournament_statistics"}
    assert all(r.description for r in told if r.column_name in cleaning.COLUMN_TEXTS)
