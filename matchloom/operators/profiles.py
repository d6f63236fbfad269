"""One row per team: recent form, averages, joined ratings, ranks and squads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.functions.scores import PROFILE_DEFAULTS, composite_strength


def form_snapshot(long: DataFrame, order: list[str], games: int = 5) -> DataFrame:
    """Points of the last ``games`` contests, averages, win share and number of contests per actor.

    The rank filter also runs before the shuffle, so an actor with most of the rows sends few of them.
    """
    latest = Window.partitionBy("actor").orderBy(*[F.col(c).desc() for c in order])
    last = long.select("actor", "points", F.row_number().over(latest).alias("rn")).filter(F.col("rn") <= games)
    form = last.groupBy("actor").agg(F.sum("points").cast("double").alias("form_score"))
    n = F.count(F.lit(1))
    totals = long.groupBy("actor").agg(
        round_half_up(ratio(F.sum("gf"), n), 3).alias("goals_scored_avg"),
        round_half_up(ratio(F.sum("ga"), n), 3).alias("goals_conceded_avg"),
        round_half_up(ratio(F.sum((F.col("points") == 3).cast("int")), n), 4).alias("win_pct"),
        n.alias("total_matches"),
    )
    return form.join(totals, "actor")


def team_profile(elo: DataFrame, form: DataFrame, ranks: DataFrame, squads: DataFrame) -> DataFrame:
    """Left joins on ``actor``, defaults for what is missing, composite strength. All inputs are unique on actor."""
    joined = elo.join(form, "actor", "left").join(ranks, "actor", "left").join(squads, "actor", "left")
    joined = joined.fillna({c: v for c, v in PROFILE_DEFAULTS.items() if c in joined.columns})
    strength = composite_strength(*[F.col(c) for c in ("elo_rating", "rank", "form_score", "win_pct", "avg_overall")])
    return joined.withColumn("team_strength_score", round_half_up(strength, 6))


def rankings_view(profile: DataFrame) -> DataFrame:
    """Profile under its reporting names."""
    names = {
        "actor": "team",
        "elo_rating": "elo",
        "form_score": "form",
        "goals_scored_avg": "avg_goals_scored",
        "goals_conceded_avg": "avg_goals_conceded",
        "avg_overall": "player_strength",
    }
    columns = "team elo form rank rank_points win_pct avg_goals_scored avg_goals_conceded player_strength team_strength_score".split()
    return profile.withColumnsRenamed(names).select(*columns)
