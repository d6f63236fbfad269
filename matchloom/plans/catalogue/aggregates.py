"""Aggregations, executive figures and model-quality metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions.names import normalized_id
from matchloom.functions.rounding import ratio, round_half_up
from matchloom.functions.rules import REPORTED_COMPETITIONS
from matchloom.operators import aggregates as A
from matchloom.operators import metrics as M
from matchloom.operators import power as P
from matchloom.operators.clean import latest_per_key
from matchloom.operators.features import FEATURES
from matchloom.operators.reshape import to_long
from matchloom.operators.summary import match_summary
from matchloom.operators import sketches as SK
from matchloom.plans import views as V
from matchloom.plans.oracle_views import VIEWS, rnd, stage_category
from matchloom.plans.registry import query

T = V.table

VIEWS["summary"] = f"""
SELECT year(d)::INTEGER AS year, d AS match_date, pool, seq, stage, {stage_category('stage')} AS stage_category, home, away, home_score AS home_goals,
  away_score AS away_goals, home_score || '-' || away_score AS scoreline, home_score + away_score AS total_goals, abs(home_score - away_score) AS goal_difference,
  CASE WHEN home_score > away_score THEN home WHEN home_score < away_score THEN away ELSE 'Draw' END AS winner_team,
  abs(home_score - away_score) AS margin_of_victory, (home_score > away_score)::INTEGER AS home_win_flag, (home_score < away_score)::INTEGER AS away_win_flag,
  (home_score = away_score)::INTEGER AS draw_flag, attendance,
  CASE WHEN home_score > away_score THEN 'home_win' WHEN home_score < away_score THEN 'away_win' ELSE 'draw' END AS result FROM contest
"""
_SCALED = {"elo_score": "elo", "form_score_norm": "form", "player_score_norm": "player_strength", "win_score_norm": "win_pct", "rank_inv": "rank"}
_NORMS = ", ".join(
    f"CASE WHEN min({c}) OVER () = max({c}) OVER () THEN 1.0 ELSE ({c} - min({c}) OVER ())::DOUBLE / nullif(max({c}) OVER () - min({c}) OVER (), 0) END AS {n}" for n, c in _SCALED.items()
)
_INDEX = (
    "((elo_score * 0.30::DOUBLE + form_score_norm * 0.20::DOUBLE + player_score_norm * 0.20::DOUBLE + win_score_norm * 0.15::DOUBLE"
    " + (1.0::DOUBLE - rank_inv) * 0.15::DOUBLE) * 100.0::DOUBLE)"
)


def define_power(name: str, source: str) -> None:
    """DuckDB views of the power index over a rankings table."""
    VIEWS[f"{name}_base"] = f"""
SELECT r.*, coalesce(championship_probability, 0)::DOUBLE AS championship_probability, {_NORMS} FROM {source} r LEFT JOIN title_odds t ON r.team = t.team
"""
    VIEWS[name] = f"""
SELECT *, rank() OVER (ORDER BY elo DESC) AS elo_rank, rank() OVER (ORDER BY form DESC) AS form_rank, rank() OVER (ORDER BY player_strength DESC) AS player_strength_rank,
  rank() OVER (ORDER BY win_pct DESC) AS win_pct_rank, rank() OVER (ORDER BY power_index DESC) AS power_rank
FROM (SELECT *, {rnd(_INDEX, 9)} AS power_index FROM {name}_base)
"""


define_power("power", "team_rankings")


def power_table(spark, sf):
    return V.stored(spark, sf, "power", lambda: P.power_index(V.team_rankings(spark, sf), V.title_odds(spark, sf)))


@query("a1_dedup", "SELECT pool, d, home, away, home_score, away_score, tournament, neutral, stage, attendance FROM contest")
def dedup(spark, sf):
    return V.first_contests(spark, sf)


@query("a2_count", "SELECT pool, count(*) AS matches FROM contest GROUP BY pool UNION ALL SELECT 'all', count(*) FROM contest")
def count(spark, sf):
    per_pool = V.contest(spark, sf).rollup("pool").agg(F.count(F.lit(1)).alias("matches"))
    return per_pool.withColumn("pool", F.coalesce("pool", F.lit("all")))


def _record_sql(key: str, source: str, own: str, other: str) -> str:
    return f"""SELECT {key} AS team, count(*) AS matches, count(*) FILTER ({own} > {other}) AS wins, count(*) FILTER ({own} = {other}) AS draws,
    count(*) FILTER ({own} < {other}) AS losses, {rnd(f'(count(*) FILTER ({own} > {other})::DOUBLE / count(*) * 100.0::DOUBLE)', 1)} AS win_pct,
    sum({own})::BIGINT AS goals_scored, sum({other})::BIGINT AS goals_conceded, (sum({own}) - sum({other}))::BIGINT AS goal_difference FROM {source} GROUP BY {key}"""


@query("a3_record_by_side", _record_sql("home", "contest", "home_score", "away_score") + " UNION ALL " + _record_sql("away", "contest", "away_score", "home_score"))
def record_by_side(spark, sf):
    games = V.contest(spark, sf)
    home = A.record(games, [F.col("home").alias("team")], "home_score", "away_score")
    return home.unionByName(A.record(games, [F.col("away").alias("team")], "away_score", "home_score"))


@query("a3b_record_total", _record_sql("actor", "contest_long", "gf", "ga"))
def record_total(spark, sf):
    return A.record(V.contest_long(spark, sf), [F.col("actor").alias("team")], "gf", "ga")


_BIG = str(REPORTED_COMPETITIONS)


@query(
    "a4_category_totals",
    f"""SELECT tournament, count(*) AS match_count, {rnd('(sum(home_score + away_score)::DOUBLE / count(*))', 2)} AS avg_goals_per_match,
    max(home_score + away_score) AS highest_scoring_match, sum(home_score + away_score)::BIGINT AS total_goals FROM contest WHERE tournament IN {_BIG} GROUP BY tournament""",
)
def category_totals(spark, sf):
    goals = F.col("home_score") + F.col("away_score")
    chosen = F.col("tournament").isin(*REPORTED_COMPETITIONS)
    totals = V.contest(spark, sf).filter(chosen).groupBy("tournament").agg(
        F.count(F.lit(1)).alias("match_count"),
        round_half_up(ratio(F.sum(goals), F.count(F.lit(1))), 2).alias("avg_goals_per_match"),
        F.max(goals).alias("highest_scoring_match"),
        F.sum(goals).alias("total_goals"),
    )
    return totals.orderBy(F.col("avg_goals_per_match").desc(), "tournament")


@query(
    "a5_pair_record",
    f"""SELECT home, away, count(*) AS total_matches, count(*) FILTER (home_score > away_score) AS home_wins, count(*) FILTER (home_score = away_score) AS draws,
    count(*) FILTER (home_score < away_score) AS away_wins, {rnd('(sum(home_score)::DOUBLE / count(*))', 2)} AS avg_home_goals,
    {rnd('(sum(away_score)::DOUBLE / count(*))', 2)} AS avg_away_goals FROM contest GROUP BY home, away""",
)
def pair_record(spark, sf):
    h, a, games = F.col("home_score"), F.col("away_score"), F.count(F.lit(1))
    return V.contest(spark, sf).groupBy("home", "away").agg(
        games.alias("total_matches"),
        A.count_if(h > a).alias("home_wins"),
        A.count_if(h == a).alias("draws"),
        A.count_if(h < a).alias("away_wins"),
        round_half_up(ratio(F.sum(h), games), 2).alias("avg_home_goals"),
        round_half_up(ratio(F.sum(a), games), 2).alias("avg_away_goals"),
    )


_ROLL = f"""count(*) AS matches_played, sum(total_goals)::BIGINT AS total_goals, {rnd('(sum(total_goals)::DOUBLE / count(*))', 2)} AS avg_goals_per_match,
    sum(home_win_flag)::BIGINT AS home_wins, sum(away_win_flag)::BIGINT AS away_wins, sum(draw_flag)::BIGINT AS draws,
    {rnd('(sum(attendance)::DOUBLE / nullif(count(attendance), 0))', 0)} AS avg_attendance, coalesce(sum(attendance), 0)::BIGINT AS total_attendance,
    {rnd('(sum(margin_of_victory)::DOUBLE / count(*))', 2)} AS average_margin FROM summary"""


@query(
    "a6_rollup",
    f"SELECT year, stage_category, stage, {_ROLL} GROUP BY year, stage_category, stage UNION ALL SELECT year, 'Overall', 'Tournament', {_ROLL} GROUP BY year",
)
def rollup(spark, sf):
    return A.stage_rollup(match_summary(V.contest(spark, sf)))


@query(
    "a7_collapse",
    """SELECT lower(p_name) AS name, max(p_size) AS p_size, max(p_retailprice) AS p_retailprice,
    arg_min(b, p_partkey) FILTER (b IS NOT NULL) AS p_brand, arg_min(p_type, p_partkey) AS p_type
    FROM (SELECT *, CASE WHEN p_size > 10 THEN p_brand END AS b FROM part) GROUP BY 1""",
)
def collapse(spark, sf):
    parts = T(spark, sf, "part").withColumns({"name": normalized_id(F.col("p_name")), "p_brand": F.when(F.col("p_size") > 10, F.col("p_brand"))})
    return A.collapse(parts, "name", ["p_size", "p_retailprice"], ["p_brand", "p_type"], "p_partkey")


@query(
    "a8_distinct_pair",
    """SELECT count(DISTINCT tournament) AS tournaments, count(DISTINCT d) AS days,
    (SELECT count(DISTINCT t) FROM (SELECT home AS t FROM contest UNION ALL SELECT away FROM contest)) AS teams FROM contest""",
)
def distinct_pair(spark, sf):
    games = V.contest(spark, sf)
    teams = games.select(F.explode(F.array("home", "away")).alias("t")).agg(F.count_distinct("t")).scalar()
    return games.agg(F.count_distinct("tournament").alias("tournaments"), F.count_distinct("d").alias("days")).withColumn("teams", teams)


@query(
    "a8_month_sketches",
    """SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS parts, TRUE AS parts_close, TRUE AS median_close, TRUE AS tail_close, count(DISTINCT date_trunc('month', l_shipdate)) AS months
    FROM lineitem GROUP BY 1, 2""",
)
def month_sketches(spark, sf):
    """Sketches by month and flags, stored once, merged over the months: distinct parts and quantiles of the price, beside
    exact figures. A quantile is close if its true rank is within the bound."""
    lines = T(spark, sf, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    stored = V.stored(spark, sf, "line_sketches", lambda: SK.sketched(lines, ["l_returnflag", "l_linestatus", "month"], "l_partkey", "l_extendedprice"))
    flags = ["l_returnflag", "l_linestatus"]
    whole = SK.merged(stored, flags).select(*flags, SK.estimate(F.col("values")).alias("e"), SK.quantile(F.col("numbers"), 0.5).alias("q50"), SK.quantile(F.col("numbers"), 0.95).alias("q95"))
    price = F.col("l_extendedprice")
    between = lambda q, share: (F.avg((price < F.col(q)).cast("int")) <= share + SK.RANK_ERROR) & (F.avg((price <= F.col(q)).cast("int")) >= share - SK.RANK_ERROR)
    exact = lines.join(whole, flags).groupBy(*flags).agg(
        F.count_distinct("l_partkey").alias("parts"), F.max("e").alias("e"), between("q50", 0.5).alias("median_close"), between("q95", 0.95).alias("tail_close"), F.count_distinct("month").alias("months")
    )
    return exact.select(*flags, "parts", (F.abs(F.col("e") - F.col("parts")) <= F.greatest(F.lit(1.0), F.col("parts") * SK.COUNT_ERROR)).alias("parts_close"), "median_close", "tail_close", "months")


def _fix(x: str, n: int) -> str:
    return f"printf('%.{n}f', {rnd(f'({x})::DOUBLE', n)})"


_KPI = [
    ("total_tournaments", "(SELECT count(DISTINCT year)::VARCHAR FROM summary)", "Tournament"),
    ("total_matches", "(SELECT count(*)::VARCHAR FROM summary)", "Tournament"),
    ("total_goals", "(SELECT sum(total_goals)::VARCHAR FROM summary)", "Match Analytics"),
    ("average_goals_per_match", f"(SELECT {_fix('sum(total_goals)::DOUBLE / count(*)', 2)} FROM summary)", "Match Analytics"),
    ("total_unique_teams", "(SELECT count(DISTINCT t)::VARCHAR FROM (SELECT home AS t FROM summary UNION ALL SELECT away FROM summary))", "Teams"),
    ("average_attendance_per_match", f"(SELECT {_fix('avg(attendance) FILTER (attendance > 0)', 0)} FROM summary)", "Fan Experience"),
    *[(f"{n}_percentage", f"(SELECT {_fix(f'sum({f})::DOUBLE / count(*) * 100', 2)} FROM summary)", "Match Analytics") for n, f in (("home_win", "home_win_flag"), ("away_win", "away_win_flag"), ("draw", "draw_flag"))],
    ("most_successful_team", "(SELECT winner_team FROM titles)", "Teams"),
    ("most_successful_team_titles", "(SELECT n::VARCHAR FROM titles)", "Teams"),
    ("top_champion_probability_team", "(SELECT team FROM title_odds ORDER BY championship_probability DESC, team LIMIT 1)", "Simulation"),
    ("top_champion_probability_percent", f"(SELECT {_fix('max(championship_probability)', 2)} FROM title_odds)", "Simulation"),
    ("top_power_index_team", "(SELECT team FROM power ORDER BY power_index DESC, team LIMIT 1)", "Power Index"),
    ("top_power_index_score", f"(SELECT {_fix('max(power_index)', 2)} FROM power)", "Power Index"),
    ("top_5_power_index_average", f"(SELECT {_fix('avg(power_index)', 2)} FROM (SELECT power_index FROM power ORDER BY power_index DESC, team LIMIT 5))", "Power Index"),
    ("top_10_championship_probability_share", f"(SELECT {_fix('sum(p)', 2)} FROM (SELECT championship_probability AS p FROM title_odds ORDER BY p DESC, team LIMIT 10))", "Simulation"),
    ("simulation_runs", f"(SELECT {rnd('(champion_count / (championship_probability / 100.0::DOUBLE))', 0)}::BIGINT::VARCHAR FROM title_odds WHERE championship_probability > 0 ORDER BY championship_probability DESC, team LIMIT 1)", "Simulation"),
]


@query(
    "a9_kpi_long",
    "WITH titles AS (SELECT winner_team, count(*) AS n FROM summary WHERE stage = 'Final' GROUP BY 1 ORDER BY n DESC, winner_team LIMIT 1) "
    + " UNION ALL ".join(f"SELECT '{n}' AS metric_name, {v} AS value, '{c}' AS category, '{P.KPI_TEXTS[n]}' AS description" for n, v, c in _KPI),
)
def kpi_long(spark, sf):
    return P.executive_summary(match_summary(V.contest(spark, sf)), power_table(spark, sf), V.title_odds(spark, sf))


_META = [
    ("total_current_teams", "(SELECT count(*)::VARCHAR FROM power)", "Teams in the dashboard table."),
    ("top_power_index_team", "(SELECT team FROM power ORDER BY power_index DESC, team LIMIT 1)", "Team with the best power index."),
    ("top_power_index_score", f"(SELECT {_fix('max(power_index)', 2)} FROM power)", "Best power index."),
    ("top_championship_probability_team", "(SELECT team FROM title_odds ORDER BY championship_probability DESC, team LIMIT 1)", "Team with the best title odds."),
    ("top_championship_probability_pct", f"(SELECT {_fix('max(championship_probability)', 2)} FROM title_odds)", "Best title odds in percent."),
]


@query("a10_top_metadata", " UNION ALL ".join(f"SELECT '{n}' AS metric_name, {v} AS value, '{d}' AS description" for n, v, d in _META))
def top_metadata(spark, sf):
    return P.dashboard_metadata(power_table(spark, sf), V.title_odds(spark, sf))


@query("a11_mode", "SELECT winner_team, count(*) AS titles FROM summary WHERE stage = 'Final' GROUP BY 1 ORDER BY titles DESC, winner_team LIMIT 1")
def mode(spark, sf):
    return A.most_frequent(match_summary(V.contest(spark, sf)).filter(F.col("stage") == "Final"), "winner_team", "winner_team", "titles")


@query("a12_latest", "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def latest(spark, sf):
    return latest_per_key(T(spark, sf, "orders"), ["o_custkey"], "o_orderkey", ["o_totalprice", "o_orderpriority"])


@query(
    "a13_minmax",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('((l_quantity - (SELECT min(l_quantity) FROM lineitem)) / (SELECT max(l_quantity) - min(l_quantity) FROM lineitem))', 6)} AS quantity_norm,
    {rnd('((l_extendedprice - (SELECT min(l_extendedprice) FROM lineitem)) / (SELECT max(l_extendedprice) - min(l_extendedprice) FROM lineitem))', 6)} AS price_norm, 1.0::DOUBLE AS constant_norm FROM lineitem""",
)
def minmax(spark, sf):
    df = P.scaled(T(spark, sf, "lineitem"), {"quantity_norm": F.col("l_quantity"), "price_norm": F.col("l_extendedprice"), "constant_norm": F.lit(7.0)})
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[round_half_up(F.col(c), 6).alias(c) for c in ("quantity_norm", "price_norm", "constant_norm")])


_POWER_OUT = ["power_index", "elo_rank", "form_rank", "player_strength_rank", "win_pct_rank", "power_rank", "championship_probability"]


@query("a14_power_index", f"SELECT team, {rnd('power_index', 6)} AS power_index, {', '.join(_POWER_OUT[1:])} FROM power")
def power_index(spark, sf):
    return power_table(spark, sf).select("team", round_half_up(F.col("power_index"), 6).alias("power_index"), *_POWER_OUT[1:])


@query("a15_team_form", "SELECT actor, form_score, goals_scored_avg, goals_conceded_avg, win_pct, total_matches FROM team_form")
def team_form(spark, sf):
    return V.team_form(spark, sf)


@query(
    "a16_frequency",
    f"""SELECT winner_team, n AS wins, {rnd('(n::DOUBLE / total * 100)', 2)} AS pct FROM (SELECT winner_team, count(*) AS n, sum(count(*)) OVER ()::DOUBLE AS total FROM summary GROUP BY 1)""".replace(
        "sum(count(*)) OVER ()::DOUBLE", "(sum(count(*)) OVER ())::DOUBLE"
    ),
)
def frequency(spark, sf):
    return A.frequency_table(match_summary(V.contest(spark, sf)), "winner_team", "wins", "pct").orderBy(F.col("wins").desc(), "winner_team")


@query(
    "a17_infer_total",
    f"""WITH f AS (SELECT {rnd('(champion_count / (championship_probability / 100.0::DOUBLE))', 0)}::BIGINT AS runs FROM title_odds WHERE championship_probability > 0
      ORDER BY championship_probability DESC, team LIMIT 1)
    SELECT team, champion_count, championship_probability, runs AS simulation_runs, rank() OVER (ORDER BY championship_probability DESC) AS probability_rank,
    rank() OVER (ORDER BY championship_probability DESC) <= 10 AS top_10_flag, {rnd('(championship_probability / 100.0::DOUBLE)', 6)} AS championship_probability_share FROM title_odds, f""",
)
def enrich_odds(spark, sf):
    return P.enriched_odds(V.title_odds(spark, sf))


@query(
    "a18_topn_share",
    f"""SELECT 'top 3' AS part, {rnd('sum(p)', 2)} AS share FROM (SELECT championship_probability AS p FROM title_odds ORDER BY p DESC, team LIMIT 3)
    UNION ALL SELECT r_name, {rnd('sum(championship_probability)', 2)} FROM title_odds JOIN nation ON team = n_name JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def topn_share(spark, sf):
    odds = V.title_odds(spark, sf)
    total = round_half_up(F.sum("championship_probability"), 2).alias("share")
    top = odds.orderBy(F.col("championship_probability").desc(), "team").limit(3).agg(total).select(F.lit("top 3").alias("part"), "share")
    regions = T(spark, sf, "nation").join(T(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("team"), F.col("r_name").alias("part"))
    return top.unionByName(odds.join(regions, "team").groupBy("part").agg(total))


@query("a19_positive_avg", f"SELECT pool, {rnd('(sum(CASE WHEN attendance > 0 THEN attendance END)::DOUBLE / nullif(count(CASE WHEN attendance > 0 THEN 1 END), 0))', 3)} AS avg_attendance FROM contest GROUP BY pool")
def positive_avg(spark, sf):
    present = F.when(F.col("attendance") > 0, F.col("attendance"))
    return V.contest(spark, sf).groupBy("pool").agg(round_half_up(ratio(F.sum(present), F.count(present)), 3).alias("avg_attendance"))


VIEWS["matrix"] = """
SELECT a.c AS actual, p.c AS predicted, count(label) AS n FROM (SELECT unnest([0, 1, 2]) AS c) a, (SELECT unnest([0, 1, 2]) AS c) p
LEFT JOIN predictions ON label = a.c AND pred = p.c GROUP BY 1, 2
"""


@query("a20_confusion", "SELECT actual, predicted, n FROM matrix")
def confusion(spark, sf):
    return M.confusion_matrix(V.predictions(spark, sf))


@query(
    "a21_class_report",
    f"""WITH c AS (SELECT k.c AS cls, (SELECT sum(n) FROM matrix WHERE actual = k.c)::DOUBLE AS support, (SELECT sum(n) FROM matrix WHERE predicted = k.c)::DOUBLE AS guessed,
      (SELECT sum(n) FROM matrix WHERE actual = k.c AND predicted = k.c)::DOUBLE AS hit FROM (SELECT unnest([0, 1, 2]) AS c) k),
    r AS (SELECT cls, coalesce(hit / nullif(guessed, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r, coalesce(2 * hit / nullif(guessed + support, 0), 0) AS f, support, hit FROM c),
    u AS (SELECT cls::VARCHAR AS name, p, r, f, support FROM r UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM r
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM r
      UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM r)
    SELECT name, {rnd('p', 6)} AS "precision", {rnd('r', 6)} AS recall, {rnd('f', 6)} AS f1, support::BIGINT AS support FROM u""",
)
def class_report(spark, sf):
    report = M.class_report(M.confusion_matrix(V.predictions(spark, sf)))
    return report.withColumns({c: round_half_up(F.col(c), 6) for c in ("precision", "recall", "f1")})


_SPREAD = ", ".join(f"abs(avg({f}) FILTER (label = 2) - avg({f}) FILTER (label = 0)) AS {f}" for f in FEATURES)
_HIGH = ", ".join(f"abs(avg({f}) FILTER (label = 1) - avg({f})) AS {f}" for f in FEATURES)


VIEWS["importance_table"] = f"""WITH v AS (SELECT 'win gap' AS model, {_SPREAD} FROM match_features UNION ALL SELECT 'draw gap', {_HIGH} FROM match_features),
    l AS (UNPIVOT v ON {', '.join(FEATURES)} INTO NAME feature VALUE value),
    s AS (SELECT *, value / sum(value) OVER (PARTITION BY model) AS share FROM l),
    i AS (SELECT feature, {rnd('avg(share)', 8)} AS importance FROM s GROUP BY feature)
    SELECT feature, importance, rank() OVER (ORDER BY importance DESC) AS importance_rank, {rnd('(importance / sum(importance) OVER () * 100)', 2)} AS importance_pct,
    {rnd('((importance - min(importance) OVER ()) / (max(importance) OVER () - min(importance) OVER ()))', 4)} AS importance_norm FROM i"""


@query("a22_importance", "SELECT feature, importance, importance_rank, importance_pct, importance_norm FROM importance_table")
def importance(spark, sf):
    # Importance as a model-free gap: how far a feature's mean moves with the outcome.
    mean = lambda f, k: F.avg(F.when(F.col("label") == k, F.col(f)))
    features = V.match_features(spark, sf)
    win = features.agg(*[F.abs(mean(f, 2) - mean(f, 0)).alias(f) for f in FEATURES]).withColumn("model", F.lit("win gap"))
    draw = features.agg(*[F.abs(mean(f, 1) - F.avg(f)).alias(f) for f in FEATURES]).withColumn("model", F.lit("draw gap"))
    values = to_long(win.unionByName(draw), ["model"], {f: f for f in FEATURES}, "feature")
    return M.scaled_importance(M.mean_importance(values).withColumn("importance", round_half_up(F.col("importance"), 8)))


@query("a23_class_weights", f"SELECT quality AS label, count(*) AS n, {rnd('((SELECT count(*) FROM labels)::DOUBLE / ((SELECT count(DISTINCT quality) FROM labels) * count(*)))', 6)} AS weight FROM labels GROUP BY quality")
def class_weights(spark, sf):
    labels = T(spark, sf, "labels").withColumnRenamed("quality", "label")
    return M.class_weights(labels).withColumn("weight", round_half_up(F.col("weight"), 6))
