"""Reporting form of the contest facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions import outcomes
from matchloom.functions.rules import stage_category


def match_summary(contests: DataFrame, extras: Sequence[str] = ()) -> DataFrame:
    """One row per contest with totals, scoreline, winner, margin, outcome flags and stage category; ``extras`` stay."""
    h, a = F.col("home_score"), F.col("away_score")
    result = outcomes.outcome_text(h, a)
    return contests.select(
        F.year("d").alias("year"),
        F.col("d").alias("match_date"),
        "pool",
        "seq",
        "stage",
        stage_category(F.col("stage")).alias("stage_category"),
        "home",
        "away",
        F.col("home_score").alias("home_goals"),
        F.col("away_score").alias("away_goals"),
        outcomes.scoreline(h, a).alias("scoreline"),
        (h + a).alias("total_goals"),
        F.abs(h - a).alias("goal_difference"),
        outcomes.winner(F.col("home"), F.col("away"), h, a).alias("winner_team"),
        outcomes.margin(h, a).alias("margin_of_victory"),
        (result == "home_win").cast("int").alias("home_win_flag"),
        (result == "away_win").cast("int").alias("away_win_flag"),
        (result == "draw").cast("int").alias("draw_flag"),
        "attendance",
        result.alias("result"),
        *[F.col(f"`{c}`") for c in extras],
    )
