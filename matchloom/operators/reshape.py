"""Wide and long forms of contests and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.outcomes import points


def contest_sides(contests: DataFrame, keep: list[str], extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Two rows per contest, one per side, from a single scan. ``extra`` maps name to (home, away) column."""
    extra = extra or {}

    def side(own: str, other: str, index: int) -> Column:
        return F.struct(
            F.lit(own).alias("side"),
            F.col(own).alias("actor"),
            F.col(other).alias("opponent"),
            F.col(f"{own}_score").alias("gf"),
            F.col(f"{other}_score").alias("ga"),
            points(F.col(f"{own}_score"), F.col(f"{other}_score")).alias("points"),
            *[F.col(pair[index]).alias(name) for name, pair in extra.items()],
        )

    both = F.explode(F.array(side("home", "away", 0), side("away", "home", 1)))
    return contests.select(*keep, both.alias("s")).select(*keep, "s.*")


def to_long(df: DataFrame, ids: list[str], columns: dict[str, str], name: str = "metric", value: str = "value") -> DataFrame:
    """Unpivot: one row per id and entry of ``columns`` (label -> column), all as double."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), F.col(c).cast("double").alias(value)) for k, c in columns.items()])
    return df.select(*ids, F.explode(pairs).alias("p")).select(*ids, "p.*")


def head_to_head(profiles: DataFrame, pairs: DataFrame, key: str, metrics: dict[str, str], lower_is_better: tuple[str, ...]) -> DataFrame:
    """Per pair (a, b) and metric both values and the better side; on a tie b is the better one."""
    long = to_long(profiles, [key], metrics)
    a = long.select(F.col(key).alias("a"), "metric", F.col("value").alias("value_a"))
    b = long.select(F.col(key).alias("b"), "metric", F.col("value").alias("value_b"))
    lower = F.col("metric").isin(*lower_is_better)
    a_better = F.when(lower, F.col("value_a") < F.col("value_b")).otherwise(F.col("value_a") > F.col("value_b"))
    return pairs.join(a, "a").join(b, ["b", "metric"]).withColumn("better", F.when(a_better, F.col("a")).otherwise(F.col("b")))


def group_fixtures(entries: DataFrame, groups: list[str]) -> DataFrame:
    """The games of a round robin: each pair of a group's actors once, better seed at home."""
    a = entries.select(*groups, F.col("actor").alias("home"), F.col("seed").alias("home_seed"))
    b = entries.select(*groups, F.col("actor").alias("away"), F.col("seed").alias("away_seed"))
    return a.join(b, groups).filter(F.col("home_seed") < F.col("away_seed"))
