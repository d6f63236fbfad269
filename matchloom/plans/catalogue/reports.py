"""The ten reporting queries and the reporting tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.functions import rules
from matchloom.functions.rounding import ratio, round_half_up
from matchloom.operators import aggregates as A
from matchloom.operators.ranks import report_ranks
from matchloom.operators.summary import match_summary
from matchloom.plans import views as V
from matchloom.operators.columns import canonical_map, resolve_names
from matchloom.operators.power import power_index
from matchloom.plans.catalogue.aggregates import _record_sql, category_totals, define_power, importance, power_table
from matchloom.operators.metrics import described_importance
from matchloom.operators.models import NAMES
from matchloom.plans.catalogue.models import metrics
from matchloom.plans.catalogue.scalars import _GROUPS, _TEXTS
from matchloom.plans.oracle_views import VIEWS, rnd
from matchloom.plans.registry import query

T = V.table
TOP = ("NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5", "NATION_6")
_TOP = ", ".join(f"'{t}'" for t in TOP)


@query("report_title_odds", "SELECT team, championship_probability AS win_prob_pct, champion_count, rank() OVER (ORDER BY championship_probability DESC) AS rank_in_tournament FROM title_odds")
def title_odds(spark, sf):
    ranked = report_ranks(V.title_odds(spark, sf), {"championship_probability": "rank_in_tournament"})
    return ranked.withColumnRenamed("championship_probability", "win_prob_pct").orderBy(F.col("win_prob_pct").desc(), "team")


_STRENGTH = {"elo_rating": 1, "rank_points": 1, "form_score": 2, "goals_scored_avg": 2, "goals_conceded_avg": 2, "avg_overall": 1, "avg_attack": 1, "avg_defense": 1, "team_strength_score": 2}


@query(
    "report_team_strength",
    f"SELECT actor AS team, rank, {rnd('(win_pct * 100.0::DOUBLE)', 1)} AS win_pct_pct, {', '.join(f'{rnd(c, n)} AS {c}' for c, n in _STRENGTH.items())} FROM profile",
)
def team_strength(spark, sf):
    rounded = [round_half_up(F.col(c), n).alias(c) for c, n in _STRENGTH.items()]
    table = V.profile(spark, sf).select(F.col("actor").alias("team"), "rank", round_half_up(F.col("win_pct") * F.lit(100.0), 1).alias("win_pct_pct"), *rounded)
    return table.orderBy(F.col("team_strength_score").desc(), "team")


@query("report_history", _record_sql("home", "contest", "home_score", "away_score") + " UNION ALL " + _record_sql("away", "contest", "away_score", "home_score"))
def history(spark, sf):
    games = V.contest(spark, sf)
    home = A.record(games, [F.col("home").alias("team")], "home_score", "away_score")
    return home.unionByName(A.record(games, [F.col("away").alias("team")], "away_score", "home_score"))


@query(
    "report_rank_trend",
    f"SELECT actor AS team, ts AS date, rank, points, {rnd('(points - lag(points) OVER (PARTITION BY actor ORDER BY ts))', 2)} AS points_change FROM rank_hist WHERE actor IN ({_TOP})",
)
def rank_trend(spark, sf):
    previous = F.lag("points").over(Window.partitionBy("actor").orderBy("ts"))
    chosen = V.rank_hist(spark, sf).filter(F.col("actor").isin(*TOP))
    change = round_half_up(F.col("points") - previous, 2).alias("points_change")
    return chosen.select(F.col("actor").alias("team"), F.col("ts").alias("date"), "rank", "points", change).orderBy("team", "date")


@query(
    "report_goals_by_competition",
    f"""SELECT tournament, count(*) AS match_count, {rnd('(sum(home_score + away_score)::DOUBLE / count(*))', 2)} AS avg_goals_per_match, max(home_score + away_score) AS highest_scoring_match,
    sum(home_score + away_score)::BIGINT AS total_goals FROM contest WHERE tournament IN {rules.REPORTED_COMPETITIONS} GROUP BY tournament""",
)
def goals_by_competition(spark, sf):
    return category_totals(spark, sf)


@query(
    "report_top_pairs",
    f"""SELECT home AS home_team, away AS away_team, count(*) AS total_matches, count(*) FILTER (home_score > away_score) AS home_wins, count(*) FILTER (home_score = away_score) AS draws,
    count(*) FILTER (home_score < away_score) AS away_wins, {rnd('(sum(home_score)::DOUBLE / count(*))', 2)} AS avg_home_goals, {rnd('(sum(away_score)::DOUBLE / count(*))', 2)} AS avg_away_goals
    FROM contest WHERE home IN ({_TOP}) AND away IN ({_TOP}) GROUP BY home, away""",
)
def top_pairs(spark, sf):
    h, a, games = F.col("home_score"), F.col("away_score"), F.count(F.lit(1))
    chosen = V.contest(spark, sf).filter(F.col("home").isin(*TOP) & F.col("away").isin(*TOP))
    pairs = chosen.groupBy(F.col("home").alias("home_team"), F.col("away").alias("away_team")).agg(
        games.alias("total_matches"),
        A.count_if(h > a).alias("home_wins"),
        A.count_if(h == a).alias("draws"),
        A.count_if(h < a).alias("away_wins"),
        round_half_up(ratio(F.sum(h), games), 2).alias("avg_home_goals"),
        round_half_up(ratio(F.sum(a), games), 2).alias("avg_away_goals"),
    )
    return pairs.orderBy(F.col("total_matches").desc(), "home_team", "away_team")


@query("report_model_ranking", f"SELECT unnest({list(NAMES)}) AS model_name, TRUE AS f1_in_range, TRUE AS ranked")
def model_ranking(spark, sf):
    """The trained models by accuracy, with both F1 figures. What they are has no SQL; that they are in range and order has."""
    table = model_report(spark, sf)
    better = table.select(F.col("model_name").alias("other"), F.col("accuracy").alias("a"))
    above = table.join(better, F.col("a") > F.col("accuracy"), "left").groupBy("model_name", "accuracy", "f1_macro", "f1_weighted", "performance_rank").agg(F.count("other").alias("above"))
    inside = F.col("f1_macro").between(0, 1) & F.col("f1_weighted").between(0, 1)
    return above.select("model_name", inside.alias("f1_in_range"), (F.col("performance_rank") == F.col("above") + 1).alias("ranked"))


@query("report_model_ranking_figures")
def model_report(spark, sf):
    """model_name, accuracy, f1_macro, f1_weighted, performance_rank."""
    figures = metrics(spark, sf).select("model_name", "accuracy", "f1_macro", "f1_weighted")
    return report_ranks(figures, {"accuracy": "performance_rank"})


@query(
    "report_finals",
    "SELECT home AS winner, year(d)::INTEGER AS year, stage, home_score AS home_goals_final, away_score AS away_goals_final, away AS runner_up FROM contest WHERE stage = 'Final'",
)
def finals(spark, sf):
    # As the report defines it: the home side stands as winner whatever the score. winner_team has the real one.
    games = V.contest(spark, sf).filter(F.col("stage") == "Final")
    columns = [F.col("home").alias("winner"), F.year("d").alias("year"), F.col("stage"), F.col("home_score").alias("home_goals_final"), F.col("away_score").alias("away_goals_final"), F.col("away").alias("runner_up")]
    return games.select(*columns, "d", "pool", "seq").orderBy(F.col("year").desc(), "d", "pool", "seq").drop("d", "pool", "seq")


@query(
    "report_tiers",
    """SELECT team, championship_probability AS win_prob_pct, CASE WHEN championship_probability >= 15 THEN 'Top Favourite' WHEN championship_probability >= 8 THEN 'Contender'
    WHEN championship_probability >= 3 THEN 'Dark Horse' ELSE 'Underdog' END AS tier FROM title_odds""",
)
def tiers(spark, sf):
    odds = V.title_odds(spark, sf).select("team", F.col("championship_probability").alias("win_prob_pct"), rules.tier(F.col("championship_probability")).alias("tier"))
    return odds.orderBy(F.col("win_prob_pct").desc(), "team")


@query(
    "report_rating_vs_odds",
    """SELECT t.team, t.championship_probability, avg_overall AS player_overall, avg_attack AS player_attack, avg_defense AS player_defense, elo_rating, rank, team_strength_score
    FROM title_odds t JOIN profile p ON t.team = p.actor""",
)
def rating_vs_odds(spark, sf):
    p = V.profile(spark, sf).withColumnsRenamed({"actor": "team", "avg_overall": "player_overall", "avg_attack": "player_attack", "avg_defense": "player_defense"})
    joined = V.title_odds(spark, sf).join(p, "team")
    columns = ["team", "championship_probability", "player_overall", "player_attack", "player_defense", "elo_rating", "rank", "team_strength_score"]
    return joined.select(*columns).orderBy(F.col("championship_probability").desc(), "team")


_SUMMARY = """year match_date pool seq stage stage_category home away home_goals away_goals scoreline total_goals goal_difference winner_team margin_of_victory
    home_win_flag away_win_flag draw_flag attendance result""".split()


@query("report_match_summary", f"SELECT {', '.join(_SUMMARY)} FROM summary")
def summary(spark, sf):
    return match_summary(V.contest(spark, sf)).select(*_SUMMARY)


@query(
    "report_confederations",
    f"""SELECT r_name AS region, count(*) AS teams, {rnd('avg(power_index)', 4)} AS avg_power_index, {rnd('sum(championship_probability)', 2)} AS combined_odds
    FROM power JOIN nation ON team = n_name JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def confederations(spark, sf):
    regions = T(spark, sf, "nation").join(T(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("team"), F.col("r_name").alias("region"))
    return power_table(spark, sf).join(regions, "team").groupBy("region").agg(
        F.count(F.lit(1)).alias("teams"),
        round_half_up(F.avg("power_index"), 4).alias("avg_power_index"),
        round_half_up(F.sum("championship_probability"), 2).alias("combined_odds"),
    )


_RANKING_NUMBERS = "elo form rank rank_points win_pct avg_goals_scored avg_goals_conceded player_strength team_strength_score".split()
VIEWS["merged_rankings"] = f"""
SELECT CASE WHEN r.team = 'NATION_5' THEN 'NATION_6' ELSE r.team END AS team, {', '.join(f'max({c}) AS {c}' for c in _RANKING_NUMBERS)}
FROM team_rankings r JOIN nation ON r.team = n_name WHERE n_nationkey < 20 GROUP BY 1
"""
define_power("dashboard_power", "merged_rankings")


@query("report_dashboard_rankings", f"SELECT team, {', '.join(_RANKING_NUMBERS)}, championship_probability, {rnd('power_index', 6)} AS power_index, power_rank FROM dashboard_power")
def dashboard_rankings(spark, sf):
    """Rankings of known teams only, one row per canonical name, with a power index of their own."""
    known = canonical_map([T(spark, sf, "nation").filter(F.col("n_nationkey") < 20).select(F.col("n_name").alias("name"))], {"nation_5": "NATION_6"})
    named = resolve_names(V.team_rankings(spark, sf), "team", known, "canonical").filter(F.col("canonical") != "")
    merged = A.collapse(named.drop("team").withColumnRenamed("canonical", "team"), "team", _RANKING_NUMBERS, [], "team")
    table = power_index(merged, V.title_odds(spark, sf))
    return table.select("team", *_RANKING_NUMBERS, "championship_probability", round_half_up(F.col("power_index"), 6).alias("power_index"), "power_rank")


@query(
    "report_feature_importance",
    f"SELECT feature, importance, importance_rank, importance_pct, importance_norm, {_GROUPS} AS feature_group, CASE feature {_TEXTS} ELSE '{rules.DEFAULT_DESCRIPTION}' END AS description FROM importance_table",
)
def feature_importance(spark, sf):
    return described_importance(importance(spark, sf))
