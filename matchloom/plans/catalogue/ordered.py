"""Window-like operators, ratings, features and splits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.functions.draws import uniform
from matchloom.functions.rounding import round_half_up
from matchloom.operators.clean import first_per_key
from matchloom.operators.features import FEATURES, history_stats, rolling_form
from matchloom.operators.ordered import chronological_split
from matchloom.operators.ranks import global_ranks
from matchloom.operators.rating import final_ratings
from matchloom.plans import views as V
from matchloom.plans.oracle_views import rnd
from matchloom.plans.registry import query
from matchloom.streaming.form import FormStream

T = V.table


@query("w1_row_number", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def row_number(spark, sf):
    latest = first_per_key(T(spark, sf, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("user_id", "event_id", "event_type", "value")


@query("w2_global_rank", "SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS price_rank FROM orders")
def global_rank(spark, sf):
    return global_ranks(T(spark, sf, "orders").select("o_orderkey", "o_totalprice"), {"o_totalprice": "price_rank"})


@query("w2b_scaled_rank", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, rank() OVER (ORDER BY l_quantity) AS quantity_rank FROM lineitem")
def scaled_rank(spark, sf):
    # Few distinct values with many ties each.
    lines = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return global_ranks(lines, {"l_quantity": "quantity_rank"}, descending=False)


_RANKED = {"qty": "qty_rank", "lines": "lines_rank", "parts": "parts_rank", "biggest": "biggest_rank", "discounted": "discounted_rank"}


@query(
    "w3_min_ranks",
    f"""WITH s AS (SELECT l_suppkey, sum(l_quantity)::DOUBLE AS qty, count(*) AS lines, max(l_partkey) AS parts, max(l_extendedprice) AS biggest,
      count(*) FILTER (l_discount > 0.05) AS discounted FROM lineitem GROUP BY 1)
    SELECT l_suppkey, {', '.join(f'rank() OVER (ORDER BY {m} DESC) AS {r}' for m, r in _RANKED.items())} FROM s""",
)
def min_ranks(spark, sf):
    stats = T(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("lines"),
        F.max("l_partkey").alias("parts"),
        F.max("l_extendedprice").alias("biggest"),
        F.count(F.when(F.col("l_discount") > 0.05, 1)).alias("discounted"),
    )
    return global_ranks(stats, _RANKED).select("l_suppkey", *_RANKED.values())


@query("w4_stream_form", "SELECT pool, seq, actor, form, games, scored, conceded, wins FROM history_stats")
def stream_form(spark, sf):
    """The same figures from a stream that lands in three spans of time, with a restart after each."""

    def build():
        sides = V.contest_long(spark, sf).select("pool", "actor", "d", "seq", "gf", "ga", "points")
        low, high = sides.agg(F.percentile_approx(F.unix_date("d"), F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("p")).first()["p"]
        day, stream = F.unix_date("d"), FormStream(sides)
        for span in (day <= low, (day > low) & (day <= high), day > high):
            stream.land(sides.where(span))
        return stream.figures().where("NOT late").drop("late")

    return V.stored(spark, sf, "stream_form", build).select("pool", "seq", "actor", "form", "games", "scored", "conceded", "wins")


@query("w4_rolling_form", "SELECT pool, seq, actor, form FROM history_stats")
def form(spark, sf):
    return rolling_form(V.contest_long(spark, sf)).select("pool", "seq", "actor", "form")


@query(
    "w5_expanding_stats",
    f"""SELECT pool, seq, actor, games, {rnd('coalesce(scored / nullif(games, 0), 0)::DOUBLE', 3)} AS scored_avg, {rnd('coalesce(conceded / nullif(games, 0), 0)::DOUBLE', 3)} AS conceded_avg,
    {rnd('coalesce(wins / nullif(games, 0), 0)::DOUBLE', 4)} AS win_frac FROM history_stats""",
)
def expanding(spark, sf):
    stats = history_stats(V.contest_long(spark, sf))
    rounded = [round_half_up(F.col(c), n).alias(c) for c, n in (("scored_avg", 3), ("conceded_avg", 3), ("win_frac", 4))]
    return stats.select("pool", "seq", "actor", "games", *rounded)


@query("w6_elo_final", f"SELECT pool, actor, {rnd('rating', 3)} AS elo_rating FROM final_elo")
def elo_final(spark, sf):
    return final_ratings(V.rated(spark, sf), "seq").select("pool", "actor", round_half_up(F.col("rating"), 3).alias("elo_rating"))


@query("w6_elo_prematch", f"SELECT pool, seq, home, away, {rnd('elo_home', 3)} AS home_elo, {rnd('elo_away', 3)} AS away_elo, {rnd('(elo_home - elo_away)', 3)} AS elo_diff FROM rated")
def elo_prematch(spark, sf):
    h, a = F.col("elo_home"), F.col("elo_away")
    rounded = [round_half_up(c, 3).alias(n) for n, c in (("home_elo", h), ("away_elo", a), ("elo_diff", h - a))]
    return V.rated(spark, sf).select("pool", "seq", "home", "away", *rounded)


_W7 = ["pool", "seq", "home_team", "away_team", "date", "tournament", "home_score", "away_score", *FEATURES, "label"]


@query("w7_match_features", f"SELECT {', '.join(_W7)} FROM match_features")
def features(spark, sf):
    return V.match_features(spark, sf).select(*_W7)


@query(
    "w8_chrono_split",
    """SELECT pool, seq, d, CASE WHEN row_number() OVER (ORDER BY d, pool, home, away) <= floor((SELECT count(*) FROM contest) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM contest""",
)
def split(spark, sf):
    return chronological_split(V.contest(spark, sf), ["d", "pool"], ["home", "away"], 0.8).select("pool", "seq", "d", "split")


@query(
    "w9_standings",
    """WITH t AS (SELECT pool, year(d)::INTEGER AS year, actor, sum(points)::BIGINT AS pts, sum(gf - ga)::BIGINT AS gd FROM contest_long GROUP BY 1, 2, 3),
    u AS (SELECT *, ('0x' || substr(md5('7|' || pool || '|' || year || '|' || actor), 1, 13))::BIGINT AS draw FROM t)
    SELECT pool, year, actor, pts, gd, CAST(row_number() OVER (PARTITION BY pool, year ORDER BY pts DESC, gd DESC, draw DESC) AS INTEGER) AS position FROM u""",
)
def standings(spark, sf):
    table = V.contest_long(spark, sf).groupBy("pool", F.year("d").alias("year"), "actor").agg(F.sum("points").alias("pts"), F.sum(F.col("gf") - F.col("ga")).alias("gd"))
    order = [F.col("pts").desc(), F.col("gd").desc(), uniform(7, F.col("pool"), F.col("year"), F.col("actor")).desc()]
    position = F.row_number().over(Window.partitionBy("pool", "year").orderBy(*order))
    return table.withColumn("position", position)
