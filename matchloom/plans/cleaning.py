"""The five raw tables of the football data set, cleaned. Each function takes the table as read from CSV."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchloom.functions.dates import effective_date
from matchloom.functions.names import canonical_name
from matchloom.functions.outcomes import outcome_text
from matchloom.operators.clean import drop_nulls, first_per_key, latest_per_key
from matchloom.operators.columns import cast_or_default, rename_columns
from matchloom.sources.describe import Steps, unseen
from matchloom.sources.readers import CORRUPT, read_csv

# Column names of the raw files. All are read as text and cast below.
RAW_COLUMNS = {
    "all_matches": ["date", "home_team", "away_team", "home_score", "away_score", "tournament", "neutral"],
    "fifa_mens_rank": ["date", "semester", "rank", "team", "total.points", "previous.points", "diff.points"],
    "WorldCupMatches": [
        "Year",
        "Datetime",
        "Stage",
        "Stadium",
        "City",
        "Home Team Name",
        "Home Team Goals",
        "Away Team Goals",
        "Away Team Name",
        "Win conditions",
        "Attendance",
        "Half-time Home Goals",
        "Half-time Away Goals",
        "Referee",
        "Assistant 1",
        "Assistant 2",
        "RoundID",
        "MatchID",
        "Home Team Initials",
        "Away Team Initials",
    ],
    "player_aggregates": [
        "country",
        "fifa_version",
        "num_players",
        "avg_overall",
        "max_overall",
        "avg_pace",
        "avg_shooting",
        "avg_passing",
        "avg_dribbling",
        "avg_defending",
        "avg_physic",
        "avg_attack_overall",
        "avg_defense_overall",
    ],
    "former_names": ["current", "former", "start_date", "end_date"],
}


# Columns of the cup matches that the match summary keeps as they are.
SUMMARY_EXTRAS = (
    "Stadium",
    "City",
    "win_conditions",
    "ht_home_goals",
    "ht_away_goals",
    "Referee",
    "Assistant 1",
    "Assistant 2",
    "RoundID",
    "MatchID",
    "Home Team Initials",
    "Away Team Initials",
)

# What the columns of the reporting tables mean.
COLUMN_TEXTS = {
    "metric_name": "Unique KPI identifier.",
    "value": "KPI value for dashboard display.",
    "category": "Business domain category for the KPI.",
    "description": "Detailed explanation of the KPI.",
    "team": "National team name.",
    "elo": "ELO rating for the team.",
    "form": "Recent form score.",
    "rank": "FIFA ranking position.",
    "rank_points": "FIFA ranking points.",
    "win_pct": "Win percentage.",
    "avg_goals_scored": "Average goals scored.",
    "avg_goals_conceded": "Average goals conceded.",
    "player_strength": "Average player strength.",
    "team_strength_score": "Composite team strength score.",
    "championship_probability": "Simulated championship probability percentage.",
    "power_index": "Computed World Cup Power Index score.",
    "power_rank": "Rank by power index.",
    "champion_count": "Monte Carlo champion selection count.",
    "simulation_runs": "Inferred number of simulations.",
    "probability_rank": "Rank by championship probability.",
    "top_10_flag": "Indicates top 10 forecasted teams.",
    "championship_probability_share": "Champion probability as a fraction.",
    "feature": "Model feature name.",
    "importance": "Raw feature importance score.",
    "importance_rank": "Rank by importance.",
    "importance_pct": "Share of total importance.",
    "importance_norm": "Normalized importance between 0 and 1.",
    "feature_group": "Feature category grouping.",
    "year": "Tournament year.",
    "match_date": "Match date.",
    "match_time": "Match kickoff time.",
    "stage": "Competition stage.",
    "stage_category": "Stage group for analytics.",
    "Stadium": "Match stadium.",
    "City": "Match city.",
    "home": "Home team name.",
    "away": "Away team name.",
    "home_goals": "Home team goals.",
    "away_goals": "Away team goals.",
    "scoreline": "Formatted scoreline.",
    "total_goals": "Total goals in match.",
    "goal_difference": "Absolute goal difference.",
    "winner_team": "Match winner or Draw.",
    "margin_of_victory": "Winning margin.",
    "home_win_flag": "Home win indicator.",
    "away_win_flag": "Away win indicator.",
    "draw_flag": "Draw indicator.",
    "matches_played": "Number of matches in aggregation.",
    "avg_goals_per_match": "Average goals per match.",
    "home_wins": "Number of home wins.",
    "away_wins": "Number of away wins.",
    "draws": "Number of draws.",
    "avg_attendance": "Average attendance.",
    "total_attendance": "Total attendance.",
    "average_margin": "Average victory margin.",
}


def read_raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """Columns by header name, as text. A file may hold them in another order or hold more of them."""
    path = f"{raw_dir}/{name}.csv"
    header = spark.read.option("header", True).csv(path).columns  # names only; nothing is inferred
    schema = StructType([StructField(c, StringType()) for c in header])
    wanted = [c for c in RAW_COLUMNS[name] if c in header]
    return read_csv(spark, path, schema).drop(CORRUPT).select(*[F.col(f"`{c}`") for c in wanted])


def _cast(df: DataFrame, **kinds: str) -> DataFrame:
    return df.withColumns({c: cast_or_default(F.col(c), kind) for c, kind in kinds.items()})


def all_matches(raw: DataFrame, steps: Steps | Callable[[DataFrame, str], DataFrame] = unseen) -> DataFrame:
    typed = _cast(steps(raw, "read"), date="date", home_score="int", away_score="int", neutral="boolean")
    named = typed.withColumns({c: canonical_name(F.col(c)) for c in ("home_team", "away_team")})
    whole = steps(drop_nulls(named, "date", "home_team", "away_team", "home_score", "away_score"), "nulls")
    # Among duplicates the order makes the survivor the same in every run.
    one = steps(first_per_key(whole, ["date", "home_team", "away_team"], [F.col(c).asc_nulls_last() for c in ("home_score", "away_score", "tournament", "neutral")]), "duplicates")
    return one.withColumns({"year": F.year("date"), "result": outcome_text(F.col("home_score"), F.col("away_score"))})


def rankings(raw: DataFrame, steps: Steps | Callable[[DataFrame, str], DataFrame] = unseen) -> DataFrame:
    """One row per team, year and half, with the date it takes effect."""
    renamed = rename_columns(steps(raw, "read"), {f"{p}.points": f"{p}_points" for p in ("total", "previous", "diff")})
    typed = _cast(renamed, date="int", semester="int", rank="int", total_points="double", previous_points="double", diff_points="double")
    named = typed.withColumns({"team": canonical_name(F.col("team")), "semester": F.coalesce("semester", F.lit(1))})
    whole = steps(drop_nulls(named, "date", "rank", "team", "total_points"), "nulls")
    one = steps(first_per_key(whole, ["date", "semester", "team"], [F.col("rank"), F.col("total_points").desc()]), "duplicates")
    return one.withColumn("ranking_date", effective_date(F.col("date"), F.col("semester")))


def world_cup_matches(raw: DataFrame, steps: Steps | Callable[[DataFrame, str], DataFrame] = unseen) -> DataFrame:
    names = {
        "Home Team Name": "home_team",
        "Away Team Name": "away_team",
        "Home Team Goals": "home_goals",
        "Away Team Goals": "away_goals",
        "Win conditions": "win_conditions",
        "Half-time Home Goals": "ht_home_goals",
        "Half-time Away Goals": "ht_away_goals",
    }
    typed = _cast(rename_columns(steps(raw, "read"), names), home_goals="int", away_goals="int", Attendance="int", Year="int", MatchID="bigint")
    named = typed.withColumns({c: canonical_name(F.col(c)) for c in ("home_team", "away_team")})
    whole = steps(drop_nulls(named, "home_team", "away_team", "home_goals", "away_goals"), "nulls")
    one = steps(first_per_key(whole, ["MatchID"], [F.col(c).asc_nulls_last() for c in ("Year", "Datetime", "home_team", "away_team", "home_goals", "away_goals")]), "duplicates")
    return one.withColumn("result", outcome_text(F.col("home_goals"), F.col("away_goals")))


def player_aggregates(raw: DataFrame, steps: Steps | Callable[[DataFrame, str], DataFrame] = unseen) -> DataFrame:
    """The latest version of each country's squad."""
    scores = [c for c in raw.columns if c.startswith(("avg_", "max_"))]
    typed = _cast(steps(raw, "read"), fifa_version="int", num_players="int", **{c: "double" for c in scores})
    whole = steps(drop_nulls(typed.withColumn("country", canonical_name(F.col("country"))), "country", "avg_overall"), "nulls")
    one = steps(first_per_key(whole, ["country", "fifa_version"], [F.col("num_players").desc_nulls_last(), F.col("avg_overall").desc()]), "duplicates")
    return steps(latest_per_key(one, ["country"], "fifa_version", ["num_players", *scores]), "older versions")


def former_names(raw: DataFrame, steps: Steps | Callable[[DataFrame, str], DataFrame] = unseen) -> DataFrame:
    whole = steps(drop_nulls(_cast(steps(raw, "read"), start_date="date", end_date="date"), "current", "former"), "nulls")
    return steps(first_per_key(whole, ["current", "former"], [F.col("start_date").asc_nulls_last(), F.col("end_date").asc_nulls_last()]), "duplicates")
