"""Decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def round_half_up(value: Column, digits: int) -> Column:
    """Half away from zero to ``digits``, as double, of the shortest decimal that prints the number."""
    return F.round(value.cast("double"), digits)


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """``numerator / denominator`` as double; ``default`` where the denominator is zero or null."""
    result = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return result if default is None else F.coalesce(result, F.lit(default))
