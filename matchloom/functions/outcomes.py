"""Expressions over the two scores of a contest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_outcome(first: Column, second: Column, win, draw, loss) -> Column:
    """``win``, ``draw`` or ``loss`` as seen from ``first``; null if a score is null."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return (
        F.when(first > second, as_column(win)).when(first < second, as_column(loss)).when(first == second, as_column(draw))
    )


def outcome_text(home: Column, away: Column) -> Column:
    return by_outcome(home, away, "home_win", "draw", "away_win")


def outcome_label(home: Column, away: Column) -> Column:
    """2 home win, 1 draw, 0 away win."""
    return by_outcome(home, away, 2, 1, 0)


def points(scored: Column, conceded: Column) -> Column:
    return by_outcome(scored, conceded, 3, 1, 0)


def result_score(scored: Column, conceded: Column) -> Column:
    return by_outcome(scored, conceded, 1.0, 0.5, 0.0)


def winner(home: Column, away: Column, home_score: Column, away_score: Column) -> Column:
    return by_outcome(home_score, away_score, home, "Draw", away)


def scoreline(home_score: Column, away_score: Column) -> Column:
    return F.concat_ws("-", home_score.cast("string"), away_score.cast("string"))


def margin(home_score: Column, away_score: Column) -> Column:
    """Absolute gap, which is zero for a draw."""
    return F.abs(home_score - away_score)


def flag(value: Column) -> Column:
    """1 when the value reads ``true`` in any case, else 0 (also for null)."""
    return F.coalesce((F.lower(value.cast("string")) == "true").cast("int"), F.lit(0))
