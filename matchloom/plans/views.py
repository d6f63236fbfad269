"""The contest domain derived from the given tables.

Everything downstream reads these. The heavy ones (``contest``, ``rated``, ``match_features``) and the
per-actor ones are feature-store tables: built once per input folder, then read as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.functions.outcomes import outcome_label, result_score
from matchloom.functions.rounding import ratio, round_half_up
from matchloom.functions.rules import rating_weight
from matchloom.functions.scores import row_mean
from matchloom.operators.clean import first_per_key, latest_per_key
from matchloom.operators.features import match_features as build_match_features
from matchloom.operators.ordered import with_ordinal
from matchloom.operators.profiles import form_snapshot, rankings_view, team_profile
from matchloom.operators.rating import final_ratings, sequential_rating
from matchloom.operators.reshape import contest_sides
from matchloom.session import settings
from matchloom.storage import materialize, stored

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

COMPETITIONS = {
    "1-URGENT": "FIFA World Cup",
    "2-HIGH": "FIFA World Cup qualification",
    "3-MEDIUM": "UEFA Euro",
    "4-NOT SPECIFIED": "Invitational Cup",
    "5-LOW": "Friendly",
}
STAGES = {1: "Group A", 2: "Round of 16", 3: "Quarter-finals", 4: "Semi-finals", 5: "Match for third place", 6: "Final"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(column, mapping: dict) -> F.Column:
    pairs = list(mapping.items())
    expr = F.when(column == pairs[0][0], pairs[0][1])
    for key, value in pairs[1:]:
        expr = expr.when(column == key, value)
    return expr


def contest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line whose customer and supplier come from different nations, with the columns a contest is made of.

    What follows from these columns is added by ``contest_columns``, after the shuffles rather than before.
    """
    t = lambda name: table(spark, sf_dir, name)
    # Written out, because a written table has a real size: planned as joins, these sides look too large to be broadcast at
    # any size, and all lines would be shuffled by supplier first.
    home = stored(spark, sf_dir, "home_names", lambda: t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("c_mktsegment").alias("pool"), F.col("n_name").alias("home")))
    away = stored(spark, sf_dir, "away_names", lambda: t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("away")))
    # The small sides are attached before the one join in which both sides are large.
    orders = t("orders").join(home, F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.select("o_orderkey", "pool", F.col("o_orderdate").cast("date").alias("d"), "home", "o_orderpriority")
    lines = t("lineitem").join(away, F.col("l_suppkey") == F.col("s_suppkey")).select("away", *CONTEST_ORDER)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).filter(F.col("home") != F.col("away")).drop("o_orderkey")


def contest_columns(lines: DataFrame) -> DataFrame:
    price = F.floor("l_extendedprice").cast("bigint")
    neutral = F.col("l_returnflag") == "N"
    return lines.select(
        *CONTEST_KEY,
        (F.floor("l_quantity").cast("bigint") % 6).alias("home_score"),
        (price % 5).alias("away_score"),
        _lookup(F.col("o_orderpriority"), COMPETITIONS).alias("tournament"),
        neutral.alias("neutral"),
        _lookup(F.col("l_linenumber"), STAGES).alias("stage"),
        F.when(~neutral, price % 50000).alias("attendance"),
    )


CONTEST_KEY = ["pool", "d", "home", "away"]
CONTEST_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
# The lines are joined and sorted in pieces that fit a task's memory; Spark merges smaller ones up to this size.
PIECES = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def first_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with complete scores, one row per (pool, d, home, away)."""
    # Both scores are there exactly if what they are made of is.
    lines = contest_lines(spark, sf_dir).dropna(subset=["l_quantity", "l_extendedprice"])
    return contest_columns(first_per_key(lines, CONTEST_KEY, [F.col(c) for c in CONTEST_ORDER]))


def contest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``first_contests``, written."""
    with settings(spark, PIECES):
        return materialize(first_contests(spark, sf_dir), "contest-unnumbered")


def contest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned facts: complete scores, one row per (pool, d, home, away), numbered within the pool."""
    # Numbering reads its input twice, so it starts from a written table.
    return stored(spark, sf_dir, "contest", lambda: with_ordinal(contest_once(spark, sf_dir), ["pool"], ["d"], ["home", "away"], "seq"))


def contest_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contest_sides(contest(spark, sf_dir), ["pool", "seq", "d"])


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests with the ratings of both sides before and after."""

    def build() -> DataFrame:
        games = contest(spark, sf_dir).withColumns(
            {"weight": rating_weight(F.col("tournament")), "score": result_score(F.col("home_score"), F.col("away_score"))}
        )
        return sequential_rating(games, ["seq"], "score", "weight").drop("weight", "score")

    return stored(spark, sf_dir, "rated", build)


def elo_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating per actor: mean over its pools."""
    finals = final_ratings(rated(spark, sf_dir), "seq")
    return finals.groupBy("actor").agg(round_half_up(F.avg("rating"), 3).alias("elo_rating"))


def rank_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every actor by order value, per quarter, dated on the first day of the quarter."""
    return stored(spark, sf_dir, "rank_hist", lambda: _rank_hist(spark, sf_dir))


def _rank_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    value = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    totals = (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("actor"), F.trunc("o_orderdate", "quarter").alias("ts"))
        .agg(value.alias("cents"))
    )
    # A quarter holds one row per actor.
    order = Window.partitionBy("ts").orderBy(F.col("cents").desc(), "actor")
    return totals.select("actor", "ts", F.row_number().over(order).alias("rank"), (F.col("cents") / F.lit(100.0)).alias("points"))


def ranks_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(rank_hist(spark, sf_dir), ["actor"], "ts", ["rank", "points"])


def squad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squad aggregates per actor and version (order year); attack or defence is null without such orders."""
    t = lambda name: table(spark, sf_dir, name)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    part = lambda *levels: F.when(F.col("o_orderpriority").isin(*levels), cents)
    score = lambda c: round_half_up(F.lit(40.0) + ratio(F.sum(c), F.count(c)) / F.lit(1000000.0), 4)
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"), F.year("o_orderdate").alias("version"))
        .agg(
            F.count(F.lit(1)).alias("num_players"),
            score(cents).alias("avg_overall"),
            score(part("1-URGENT", "2-HIGH")).alias("avg_attack"),
            score(part("5-LOW")).alias("avg_defense"),
        )
    )


SQUAD_SCORES = ["avg_overall", "avg_attack", "avg_defense"]


def squad_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        return latest_per_key(squad(spark, sf_dir), ["country"], "version", ["num_players", *SQUAD_SCORES])

    return stored(spark, sf_dir, "squad_latest", build)


def player_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strength per actor: mean of the scores that are there."""
    mean = row_mean(*[F.col(c) for c in SQUAD_SCORES])
    return squad_latest(spark, sf_dir).select(F.col("country").alias("actor"), mean.alias("strength")).dropna(subset=["strength"])


def team_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot per actor over all pools: points of the last five contests, averages, win share, contests."""
    return form_snapshot(contest_long(spark, sf_dir), ["d", "pool", "seq"])


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per actor: rating, form, latest rank and squad, defaults filled, composite strength."""

    def build() -> DataFrame:
        ranks = ranks_latest(spark, sf_dir).select("actor", "rank", F.col("points").alias("rank_points"))
        players = squad_latest(spark, sf_dir).select(F.col("country").alias("actor"), *SQUAD_SCORES)
        return team_profile(elo_ratings(spark, sf_dir), team_form(spark, sf_dir), ranks, players)

    return stored(spark, sf_dir, "profile", build)


def team_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile under its reporting names."""
    return rankings_view(profile(spark, sf_dir))


def title_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each actor won a final: count and percent of all decided finals."""

    def build() -> DataFrame:
        from matchloom.operators.aggregates import frequency_table

        games = contest(spark, sf_dir).filter((F.col("stage") == "Final") & (F.col("home_score") != F.col("away_score")))
        won = games.select(F.when(F.col("home_score") > F.col("away_score"), F.col("home")).otherwise(F.col("away")).alias("team"))
        return frequency_table(won, "team", "champion_count", "championship_probability")

    return stored(spark, sf_dir, "title_odds", build)


def match_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        return build_match_features(rated(spark, sf_dir), rank_hist(spark, sf_dir), player_strength(spark, sf_dir))

    return stored(spark, sf_dir, "match_features", build)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label against a rule-based guess per contest: the side with the higher rating wins, near equals draw."""
    gap = F.col("elo_home") - F.col("elo_away")
    guess = F.when(gap > 20, 2).when(gap < -20, 0).otherwise(1)
    return rated(spark, sf_dir).select("pool", "seq", outcome_label(F.col("home_score"), F.col("away_score")).alias("label"), guess.alias("pred"))
