"""Leakage-safe features: only contests and rankings before a contest count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.outcomes import flag, outcome_label
from matchloom.functions.rounding import ratio, round_half_up
from matchloom.operators.ordered import asof_before, expanding_before, rolling_before
from matchloom.operators.reshape import contest_sides

DEFAULT_RANK = 200
DEFAULT_STRENGTH = 65.0
FORM_GAMES = 5


def history_stats(long: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Add to (pool, actor, d, seq) rows the totals and averages over the actor's earlier contests."""
    keys, order = ["pool", "actor"], ["d", "seq"]
    bucketed = _monthly(long)
    sums = {
        "games": F.lit(1).cast("bigint"),
        "scored": F.col("gf"),
        "conceded": F.col("ga"),
        "wins": (F.col("points") == 3).cast("bigint"),
    }
    out = expanding_before(bucketed, keys, "__month", order, sums, _monthly(source))
    games = F.col("games")
    return out.withColumns(
        {
            "scored_avg": ratio(F.col("scored"), games, 0.0),
            "conceded_avg": ratio(F.col("conceded"), games, 0.0),
            "win_frac": ratio(F.col("wins"), games, 0.0),
        }
    ).drop(*([] if "__month" in long.columns else ["__month"]))


def _monthly(rows: DataFrame | None) -> DataFrame | None:
    """With the month, kept if it is there: operators that share it share the shuffle by it."""
    return rows if rows is None or "__month" in rows.columns else rows.withColumn("__month", F.trunc("d", "MM"))


def rolling_form(long: DataFrame, games: int = FORM_GAMES, source: DataFrame | None = None) -> DataFrame:
    """Add ``form``: points of the actor's last ``games`` earlier contests."""
    out = rolling_before(_monthly(long), ["pool", "actor"], "__month", ["d", "seq"], "points", "form", games, _monthly(source))
    return out.drop(*([] if "__month" in long.columns else ["__month"]))


def rank_before(long: DataFrame, history: DataFrame, default: int = DEFAULT_RANK, source: DataFrame | None = None) -> DataFrame:
    """Add ``rank``: the actor's latest rank dated before the contest."""
    return asof_before(long, history, ["actor"], "d", "ts", {"rank": default}, source=source)


def match_features(rated: DataFrame, history: DataFrame, strength: DataFrame) -> DataFrame:
    """One row per rated contest with both sides' features, their differences, a neutral flag and the label."""
    rest = ["d", "tournament", "neutral", "home", "away", "home_score", "away_score"]
    long = _monthly(contest_sides(rated, ["pool", "seq", *rest], {"elo": ("elo_home", "elo_away")}))
    bare = _monthly(contest_sides(rated, ["pool", "seq", "d"]))
    # Totals and form share one shuffle by actor and month; the as-of join has another, by actor over all pools.
    long = rank_before(rolling_form(history_stats(long, bare), source=bare).drop("__month"), history, source=bare)
    metrics = ("elo", "form", "scored_avg", "conceded_avg", "win_frac", "rank")
    pick = lambda side, m: F.max(F.when(F.col("side") == side, F.col(m))).alias(f"{side}_{m}")
    wide = long.groupBy("pool", "seq").agg(*[F.any_value(c).alias(c) for c in rest], *[pick(side, m) for m in metrics for side in ("home", "away")])
    for side in ("home", "away"):
        own = strength.select(F.col("actor").alias(side), F.col("strength").alias(f"{side}_strength"))
        wide = wide.join(own, side, "left").withColumn(f"{side}_strength", F.coalesce(f"{side}_strength", F.lit(DEFAULT_STRENGTH)))
    return wide.select(
        "pool",
        "seq",
        F.col("home").alias("home_team"),
        F.col("away").alias("away_team"),
        F.col("d").alias("date"),
        "tournament",
        "home_score",
        "away_score",
        *_sides("elo", "elo", 3),
        *_sides("form", "form", 3),
        *_sides("scored_avg", "avg_goals_scored", 3, "goals_scored_diff"),
        *_sides("conceded_avg", "avg_goals_conceded", 3, "goals_conceded_diff"),
        *_sides("win_frac", "win_percentage", 4),
        F.col("home_rank").cast("int").alias("home_fifa_rank"),
        F.col("away_rank").cast("int").alias("away_fifa_rank"),
        # A better rank is a smaller number, so this difference is the other way round.
        (F.col("away_rank") - F.col("home_rank")).cast("int").alias("ranking_diff"),
        *_sides("strength", "player_strength", 3),
        flag(F.col("neutral")).alias("neutral_match_flag"),
        outcome_label(F.col("home_score"), F.col("away_score")).alias("label"),
    )


def _sides(metric: str, name: str, digits: int, diff: str | None = None):
    home, away = F.col(f"home_{metric}").cast("double"), F.col(f"away_{metric}").cast("double")
    return (
        round_half_up(home, digits).alias(f"home_{name}"),
        round_half_up(away, digits).alias(f"away_{name}"),
        round_half_up(home - away, digits).alias(diff or f"{name}_diff"),
    )


# The model's inputs.
FEATURES = (
    "home_elo",
    "away_elo",
    "elo_diff",
    "home_form",
    "away_form",
    "form_diff",
    "home_avg_goals_scored",
    "away_avg_goals_scored",
    "goals_scored_diff",
    "home_avg_goals_conceded",
    "away_avg_goals_conceded",
    "goals_conceded_diff",
    "home_win_percentage",
    "away_win_percentage",
    "win_percentage_diff",
    "home_fifa_rank",
    "away_fifa_rank",
    "ranking_diff",
    "home_player_strength",
    "away_player_strength",
    "player_strength_diff",
    "neutral_match_flag",
)
