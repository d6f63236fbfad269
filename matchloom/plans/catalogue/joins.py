"""Joins, set operations, reshaping, sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.operators import columns as C
from matchloom.operators.clean import rename_in_interval
from matchloom.operators.features import rank_before
from matchloom.operators.ordered import with_ordinal
from matchloom.operators.reshape import group_fixtures
from matchloom.operators.reshape import head_to_head as head_to_head_table
from matchloom.plans import views as V
from matchloom.plans.oracle_views import rnd
from matchloom.plans.registry import query

T = V.table


@query(
    "j1_profile_join",
    """SELECT actor, elo_rating, form_score, goals_scored_avg, goals_conceded_avg, win_pct, total_matches, rank, rank_points, avg_overall, avg_attack,
    avg_defense, team_strength_score FROM profile""",
)
def profile_join(spark, sf):
    return V.profile(spark, sf)


@query("j2_inner", "SELECT t.team, championship_probability, avg_overall, elo_rating, rank FROM title_odds t JOIN profile p ON t.team = p.actor")
def inner(spark, sf):
    p = V.profile(spark, sf).withColumnRenamed("actor", "team")
    return V.title_odds(spark, sf).join(p, "team").select("team", "championship_probability", "avg_overall", "elo_rating", "rank")


@query(
    "j3_full_outer",
    """SELECT coalesce(h.pool, a.pool) AS pool, coalesce(h.d, a.d) AS d, coalesce(h.actor, a.actor) AS actor, h.n AS home_games, a.n AS away_games
    FROM (SELECT pool, d, home AS actor, count(*) AS n FROM contest GROUP BY ALL) h
    FULL JOIN (SELECT pool, d, away AS actor, count(*) AS n FROM contest GROUP BY ALL) a ON h.pool = a.pool AND h.d = a.d AND h.actor = a.actor""",
)
def full_outer(spark, sf):
    side = lambda s: V.contest(spark, sf).groupBy("pool", "d", F.col(s).alias("actor")).agg(F.count(F.lit(1)).alias(f"{s}_games"))
    return side("home").join(side("away"), ["pool", "d", "actor"], "full")


@query("j4_lookup_fill", "SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def lookup_fill(spark, sf):
    counts = T(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return C.lookup(T(spark, sf, "customer"), counts, F.col("c_custkey") == F.col("o_custkey"), "orders", 0).select("c_custkey", "orders")


@query("j5_asof", "SELECT pool, seq, side, rank FROM long_ranked")
def asof(spark, sf):
    long = V.contest_long(spark, sf).select("pool", "seq", "d", "side", "actor")
    return rank_before(long, V.rank_hist(spark, sf)).select("pool", "seq", "side", "rank")


@query(
    "j6_dim_default",
    f"""WITH k AS (SELECT actor, strength FROM player_strength WHERE strength > 65)
    SELECT pool, seq, {rnd('coalesce(h.strength, 65.0::DOUBLE)', 3)} AS home_strength, {rnd('coalesce(a.strength, 65.0::DOUBLE)', 3)} AS away_strength
    FROM contest LEFT JOIN k h ON home = h.actor LEFT JOIN k a ON away = a.actor""",
)
def dim_default(spark, sf):
    known = V.player_strength(spark, sf).filter(F.col("strength") > 65)
    games = V.contest(spark, sf).select("pool", "seq", "home", "away")
    for side in ("home", "away"):
        own = known.select(F.col("actor").alias("__actor"), F.col("strength").alias(f"{side}_strength"))
        games = C.lookup(games, own, F.col(side) == F.col("__actor"), f"{side}_strength", 65.0).drop("__actor")
    return games.select("pool", "seq", *[round_half_up(F.col(f"{side}_strength"), 3).alias(f"{side}_strength") for side in ("home", "away")])


@query(
    "j7_semi_share",
    f"""SELECT tournament, count(*) AS n, {rnd('(count(*)::DOUBLE / (SELECT count(*) FROM contest) * 100)', 2)} AS pct FROM contest
    WHERE home IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE') GROUP BY tournament""",
)
def semi_share(spark, sf):
    games = V.contest(spark, sf)
    members = T(spark, sf, "nation").join(T(spark, sf, "region").filter(F.col("r_name") == "EUROPE"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    total = games.agg(F.count(F.lit(1))).scalar()
    inside = games.join(members, F.col("home") == F.col("n_name"), "left_semi").groupBy("tournament").agg(F.count(F.lit(1)).alias("n"))
    return inside.withColumn("pct", round_half_up(ratio(F.col("n"), total) * F.lit(100.0), 2))


@query(
    "j8_fixture_pairs",
    f"""WITH e AS (SELECT pool, r_name AS grp, actor, rating, row_number() OVER (PARTITION BY pool, r_name ORDER BY {rnd('rating', 3)} DESC, actor) AS seed
      FROM final_elo JOIN nation ON actor = n_name JOIN region ON n_regionkey = r_regionkey)
    SELECT a.pool, a.grp, a.actor AS home, b.actor AS away, a.seed::INTEGER AS home_seed, b.seed::INTEGER AS away_seed FROM e a JOIN e b ON a.pool = b.pool AND a.grp = b.grp AND a.seed < b.seed""",
)
def fixture_pairs(spark, sf):
    from matchloom.operators.rating import final_ratings

    regions = T(spark, sf, "nation").join(T(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("actor"), F.col("r_name").alias("grp"))
    entries = final_ratings(V.rated(spark, sf), "seq").join(regions, "actor")
    order = Window.partitionBy("pool", "grp").orderBy(round_half_up(F.col("rating"), 3).desc(), "actor")
    return group_fixtures(entries.withColumn("seed", F.row_number().over(order)), ["pool", "grp"])


# Compared metrics; of those in _LOWER the smaller value is the better one.
_PAIR = ["elo", "form", "win_pct", "rank", "rank_points", "player_strength", "avg_goals_scored", "avg_goals_conceded", "team_strength_score"]
_LOWER = ("rank", "avg_goals_conceded")


@query(
    "j9_pair_features",
    "SELECT c.pool, c.seq, "
    + ", ".join(f"{rnd(f'({a}.{m} - {b}.{m})::DOUBLE', 3)} AS {m}_diff" for m in _PAIR for a, b in [("a", "h") if m in _LOWER else ("h", "a")])
    + " FROM contest c JOIN team_rankings h ON c.home = h.team JOIN team_rankings a ON c.away = a.team",
)
def pair_features(spark, sf):
    dim = V.team_rankings(spark, sf)
    side = lambda s: dim.select(F.col("team").alias(s), *[F.col(m).alias(f"{s}_{m}") for m in _PAIR])
    both = V.contest(spark, sf).select("pool", "seq", "home", "away").join(side("home"), "home").join(side("away"), "away")
    out = C.difference_features(both, _PAIR, reversed_metrics=_LOWER)
    return out.select("pool", "seq", *[round_half_up(F.col(f"{m}_diff").cast("double"), 3).alias(f"{m}_diff") for m in _PAIR])


@query(
    "j10_head_to_head",
    f"""WITH p AS (SELECT DISTINCT home AS a, away AS b FROM contest),
    l AS (UNPIVOT (SELECT team, {', '.join(f'{m}::DOUBLE AS {m}' for m in _PAIR)} FROM team_rankings) ON {', '.join(_PAIR)} INTO NAME metric VALUE value)
    SELECT a, b, x.metric, x.value AS value_a, y.value AS value_b,
    CASE WHEN (x.metric NOT IN {_LOWER} AND x.value > y.value) OR (x.metric IN {_LOWER} AND x.value < y.value) THEN a ELSE b END AS better
    FROM p JOIN l x ON a = x.team JOIN l y ON b = y.team AND x.metric = y.metric""",
)
def head_to_head(spark, sf):
    pairs = V.contest(spark, sf).select(F.col("home").alias("a"), F.col("away").alias("b")).distinct()
    return head_to_head_table(V.team_rankings(spark, sf), pairs, "team", {m: m for m in _PAIR}, _LOWER)


@query(
    "j11_interval_rename",
    """WITH names AS (SELECT n_name AS former, 'NEW ' || n_name AS current, make_date(1995 + n_regionkey, 1, 1) AS s, make_date(1997 + n_regionkey, 6, 30) AS e
      FROM nation WHERE n_nationkey < 12)
    SELECT pool, seq, home, coalesce(current, home) AS home_current FROM contest LEFT JOIN names ON home = former AND d BETWEEN s AND e""",
)
def interval_rename(spark, sf):
    names = T(spark, sf, "nation").filter(F.col("n_nationkey") < 12).select(
        F.col("n_name").alias("former"),
        F.concat(F.lit("NEW "), "n_name").alias("current"),
        F.make_date(F.lit(1995) + F.col("n_regionkey"), F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(F.lit(1997) + F.col("n_regionkey"), F.lit(6), F.lit(30)).alias("end_date"),
    )
    return rename_in_interval(V.contest(spark, sf), "home", "d", names).select("pool", "seq", "home", "home_current")


@query("u1_union_all", "SELECT home AS team, count(*) AS games FROM contest GROUP BY home UNION ALL SELECT away, count(*) FROM contest GROUP BY away")
def union_all(spark, sf):
    games = V.contest(spark, sf)
    home = games.groupBy(F.col("home").alias("team")).agg(F.count(F.lit(1)).alias("games"))
    # Positional: the second branch takes the names of the first.
    return home.union(games.groupBy("away").agg(F.count(F.lit(1)).alias("away_games")))


@query(
    "u2_align_union",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""",
)
def align_union(spark, sf):
    suppliers = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = T(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    return suppliers.unionByName(customers, allowMissingColumns=True)


@query("u3_key_universe", "SELECT id FROM (SELECT c_custkey AS id FROM customer UNION SELECT o_custkey FROM orders UNION SELECT l_suppkey FROM lineitem UNION SELECT user_id FROM events) WHERE id IS NOT NULL")
def key_universe(spark, sf):
    parts = [("customer", "c_custkey"), ("orders", "o_custkey"), ("lineitem", "l_suppkey"), ("events", "user_id")]
    first, *rest = [T(spark, sf, t).select(F.col(c).alias("id")) for t, c in parts]
    for other in rest:
        first = first.union(other)
    return first.dropna().distinct()


@query("u4_contest_long", "SELECT pool, seq, d, side, actor, opponent, gf, ga, points FROM contest_long")
def contest_long(spark, sf):
    return V.contest_long(spark, sf)


@query("o1_sort", "SELECT pool, d, home, away, row_number() OVER (ORDER BY d, pool, home, away) AS position FROM contest")
def sort(spark, sf):
    # The position is what the sort assigns; written out, the sorted rows would be range partitions in this order.
    games = V.contest(spark, sf).select("pool", "d", "home", "away")
    return with_ordinal(games, [], ["d", "pool"], ["home", "away"], "position").orderBy("position")


@query("o2_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_n(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(25)


@query("o3_top_resort", "SELECT * FROM (SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 15) ORDER BY p_retailprice, p_partkey")
def top_resort(spark, sf):
    top = T(spark, sf, "part").select("p_partkey", "p_retailprice").orderBy(F.col("p_retailprice").desc_nulls_last(), "p_partkey").limit(15)
    return top.orderBy(F.col("p_retailprice").asc_nulls_last(), "p_partkey")


@query(
    "o4_trend",
    """WITH m AS (SELECT n_name AS actor, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_1', 'NATION_5', 'NATION_9') GROUP BY 1, 2)
    SELECT actor, month, cents, cents - lag(cents) OVER (PARTITION BY actor ORDER BY month) AS diff_points FROM m""",
)
def trend(spark, sf):
    chosen = T(spark, sf, "nation").filter(F.col("n_name").isin("NATION_1", "NATION_5", "NATION_9"))
    buyers = T(spark, sf, "customer").join(chosen, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    monthly = (
        T(spark, sf, "orders")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("n_name").alias("actor"), F.trunc("o_orderdate", "MM").alias("month"))
        .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    )
    previous = F.lag("cents").over(Window.partitionBy("actor").orderBy("month"))
    return monthly.withColumn("diff_points", F.col("cents") - previous).orderBy("actor", "month")
