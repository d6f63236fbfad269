"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.storage import materialize


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def record(df: DataFrame, keys: list[Column | str], scored: str, conceded: str) -> DataFrame:
    """Contests, wins, draws, losses, win percent, goals and their difference per key."""
    own, other = F.col(scored), F.col(conceded)
    games = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        games.alias("matches"),
        count_if(own > other).alias("wins"),
        count_if(own == other).alias("draws"),
        count_if(own < other).alias("losses"),
        round_half_up(ratio(count_if(own > other), games) * F.lit(100.0), 1).alias("win_pct"),
        F.sum(own).alias("goals_scored"),
        F.sum(other).alias("goals_conceded"),
        (F.sum(own) - F.sum(other)).alias("goal_difference"),
    )


def frequency_table(df: DataFrame, key: str, count_name: str, percent_name: str) -> DataFrame:
    """Count per key and its percent of all rows.

    The counts are written out: the total is a second look at them, and must not run the input again.
    """
    counts = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)), "frequencies")
    total = counts.select(F.sum(count_name).alias("total")).scalar()
    return counts.withColumn(percent_name, round_half_up(ratio(F.col(count_name), total) * F.lit(100.0), 2))


def stage_rollup(summary: DataFrame) -> DataFrame:
    """Per (year, stage category, stage) and, in the same pass, per year as ``Overall`` / ``Tournament``."""
    df = summary.groupingSets(
        [["year", "stage_category", "stage"], ["year"]], "year", "stage_category", "stage"
    ).agg(
        F.grouping_id().alias("level"),
        F.count(F.lit(1)).alias("matches_played"),
        F.sum("total_goals").alias("total_goals"),
        round_half_up(ratio(F.sum("total_goals"), F.count(F.lit(1))), 2).alias("avg_goals_per_match"),
        F.sum("home_win_flag").cast("bigint").alias("home_wins"),
        F.sum("away_win_flag").cast("bigint").alias("away_wins"),
        F.sum("draw_flag").cast("bigint").alias("draws"),
        round_half_up(ratio(F.sum("attendance"), F.count("attendance")), 0).alias("avg_attendance"),
        F.coalesce(F.sum("attendance"), F.lit(0)).alias("total_attendance"),
        round_half_up(ratio(F.sum("margin_of_victory"), F.count(F.lit(1))), 2).alias("average_margin"),
    )
    overall = F.col("level") > 0
    return df.withColumns(
        {
            "stage_category": F.when(overall, "Overall").otherwise(F.col("stage_category")),
            "stage": F.when(overall, "Tournament").otherwise(F.col("stage")),
        }
    ).drop("level")


def collapse(df: DataFrame, key: str, maxima: list[str], firsts: list[str], order: str) -> DataFrame:
    """One row per key: the maximum of some columns, the first non-null value (by ``order``) of others."""
    return df.groupBy(key).agg(
        *[F.max(c).alias(c) for c in maxima],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts],
    )


def most_frequent(df: DataFrame, key: str, name: str, count: str) -> DataFrame:
    """The most frequent value and its count; the first name wins a tie."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.col(count).desc(), F.col(key)).limit(1).select(F.col(key).alias(name), count)


def infer_total(df: DataFrame, count: str, percent: str, order: list[Column]) -> Column:
    """Scalar: rows behind a (count, percent) table, from its first row with a positive percent."""
    first = df.filter(F.col(percent) > 0).orderBy(*order).limit(1)
    return first.select(round_half_up(F.col(count) / (F.col(percent) / F.lit(100.0)), 0).cast("bigint").alias("total")).scalar()


def profile_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count, non-null count, distinct count, minimum and maximum of each column.

    Each distinct count is a scalar subquery that reads its one column; several in one aggregate would
    multiply every row by the number of columns.
    """
    aggregates, structs = [], []
    for i, c in enumerate(columns):
        aggregates += [F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
        structs.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"n{i}").alias("non_null"),
                df.select(c).agg(F.count_distinct(c)).scalar().alias("distinct_values"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
            )
        )
    one = df.agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    return one.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
