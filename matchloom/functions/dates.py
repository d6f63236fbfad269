"""Dates that are not stored as dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_date(year: Column, half: Column) -> Column:
    """First day of the half-year; a missing half counts as the first."""
    return F.make_date(year, F.when(F.coalesce(half, F.lit(1)) == 1, 1).otherwise(7), F.lit(1))


def text_date(text: Column) -> Column:
    """Date from a leading ``13 Jul 1930``; null where the text is something else."""
    return F.try_to_timestamp(F.regexp_extract(text, r"^(\d{1,2} [A-Za-z]+ \d{4})", 1), F.lit("d MMM yyyy")).cast("date")


def text_time(text: Column) -> Column:
    """Whatever follows the first hyphen, else an empty text."""
    return F.coalesce(F.regexp_extract(text, r"-\s*(.+)$", 1), F.lit(""))
