"""Numeric scores: expectations, probabilities, scaling and weighted indices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the composite strength and of the power index.
COMPOSITE_WEIGHTS = {"elo": 0.30, "rank": 0.20, "form": 0.15, "win": 0.15, "overall": 0.20}
POWER_WEIGHTS = {"elo": 0.30, "form": 0.20, "strength": 0.20, "win": 0.15, "rank": 0.15}

# Profile defaults.
PROFILE_DEFAULTS = {
    "elo_rating": 1500.0,
    "form_score": 7.5,
    "goals_scored_avg": 1.3,
    "goals_conceded_avg": 1.3,
    "win_pct": 0.33,
    "rank": 100,
    "rank_points": 1000.0,
    "avg_overall": 65.0,
    "avg_attack": 65.0,
    "avg_defense": 65.0,
    "avg_pace": 65.0,
    "avg_passing": 65.0,
    "avg_dribbling": 65.0,
}

# Radar axes (column, low end, high end); a low end above the high end reverses the axis.
AXES = (
    ("Attack", "attack", 30.0, 90.0),
    ("Defense", "defense", 30.0, 90.0),
    ("Form", "form", 0.0, 20.0),
    ("ELO", "elo", 1200.0, 2100.0),
    ("Strength", "player_strength", 50.0, 90.0),
    ("Rank", "rank", 200.0, 1.0),
)


def expected_score(own: Column, other: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (other - own) / F.lit(400.0)))


def outcome_probabilities(home: Column, away: Column, home_host: Column, away_host: Column) -> dict[str, Column]:
    """Home win, draw and away win from two ratings; a host gains 0.04 up to 0.90, then all are rescaled."""
    base = expected_score(home, away)
    draw = F.greatest(F.lit(0.15), F.lit(0.28) - F.abs(home - away) / F.lit(2000.0))
    boosted = lambda p, host: F.when(host, F.least(p + F.lit(0.04), F.lit(0.90))).otherwise(p)
    win = boosted((F.lit(1.0) - draw) * base, home_host)
    loss = boosted((F.lit(1.0) - draw) * (F.lit(1.0) - base), away_host)
    total = win + draw + loss
    return {"p_home": win / total, "p_draw": draw / total, "p_away": loss / total}


def composite_strength(elo: Column, rank: Column, form: Column, win_frac: Column, overall: Column) -> Column:
    w = COMPOSITE_WEIGHTS
    return (
        elo * F.lit(w["elo"])
        + (F.lit(200.0) - rank) * F.lit(3.0) * F.lit(w["rank"])
        + form / F.lit(15.0) * F.lit(100.0) * F.lit(w["form"])
        + win_frac * F.lit(100.0) * F.lit(w["win"])
        + overall * F.lit(w["overall"])
    )


def row_mean(*columns: Column) -> Column:
    """Mean over the non-null columns, null when all are null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    return total / F.nullif(present, F.lit(0))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def axis_score(value: Column, low: float, high: float) -> Column:
    """Position between ``low`` and ``high`` as 0..100; reversed when ``low`` is the larger end."""
    return F.lit(100.0) * clamp((value - F.lit(low)) / F.lit(high - low), 0.0, 1.0)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant column gives 1."""
    return F.when(low == high, F.lit(1.0)).otherwise((value - low) / F.nullif(high - low, F.lit(0.0)))


def proxy_attack(attack: Column, scored_avg: Column) -> Column:
    return F.when(attack > 0, attack).otherwise(clamp(scored_avg * F.lit(35.0), 35.0, 90.0))


def proxy_defense(defense: Column, conceded_avg: Column) -> Column:
    return F.when(defense > 0, defense).otherwise(clamp((F.lit(3.5) - conceded_avg) * F.lit(22.0), 30.0, 90.0))
