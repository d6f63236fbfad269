"""Projections, scalar functions, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import dates, outcomes, rules, scores
from matchloom.functions.names import normalized_id
from matchloom.functions.rounding import ratio, round_half_up
from matchloom.operators import columns as C
from matchloom.operators.aggregates import count_if
from matchloom.operators.clean import drop_nulls, first_per_key
from matchloom.operators.features import FEATURES
from matchloom.operators.reshape import to_long
from matchloom.operators.close_names import resolve_close
from matchloom.plans import views as V
from matchloom.plans.oracle_views import rnd, stage_category, weight
from matchloom.plans.registry import query

T = V.table
HOSTS = ("NATION_1", "NATION_2", "NATION_3")


@query("p1_rename", "SELECT p_partkey AS part_id, p_brand AS brand, p_retailprice AS price, p_size FROM part")
def rename(spark, sf):
    raw = T(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("Brand Name"), F.col("p_retailprice").alias("retail.price"), "p_size")
    return C.rename_columns(raw, {"p_partkey": "part_id", "Brand Name": "brand", "retail.price": "price"})


@query(
    "p2_try_cast",
    """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no, TRY_CAST(p_brand AS INTEGER) AS brand_as_number,
    coalesce(TRY_CAST(p_type AS DOUBLE), 0) AS type_or_zero FROM part""",
)
def try_cast(spark, sf):
    return T(spark, sf, "part").select(
        "p_partkey",
        C.cast_or_default(F.split_part("p_brand", F.lit("#"), F.lit(2)), "int").alias("brand_no"),
        C.cast_or_default(F.col("p_brand"), "int").alias("brand_as_number"),
        C.cast_or_default(F.col("p_type"), "double", 0.0).alias("type_or_zero"),
    )


@query(
    "p3_date_parts",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d,
    CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate)::INTEGER END AS year FROM orders""",
)
def date_parts(spark, sf):
    text = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("not a date")
    return T(spark, sf, "orders").select("o_orderkey", F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date").alias("d")).withColumn("year", F.year("d"))


ALIASES = {"NATION_3": "Third Nation", "NATION_11": "Nation Eleven", "NATION_24": "Last Nation"}


@query(
    "p4_canonical_name",
    """SELECT pool, seq, CASE home WHEN 'NATION_3' THEN 'Third Nation' WHEN 'NATION_11' THEN 'Nation Eleven' WHEN 'NATION_24' THEN 'Last Nation' ELSE home END AS home,
    CASE away WHEN 'NATION_3' THEN 'Third Nation' WHEN 'NATION_11' THEN 'Nation Eleven' WHEN 'NATION_24' THEN 'Last Nation' ELSE away END AS away FROM contest""",
)
def canonical(spark, sf):
    padded = V.contest(spark, sf).select("pool", "seq", F.concat(F.lit("  "), "home").alias("home"), F.concat("away", F.lit(" ")).alias("away"))
    return C.canonical_columns(padded, ["home", "away"], ALIASES)


@query(
    "p5_outcome",
    """SELECT pool, seq, CASE WHEN home_score > away_score THEN 'home_win' WHEN home_score < away_score THEN 'away_win' ELSE 'draw' END AS result,
    CASE WHEN home_score > away_score THEN 2 WHEN home_score < away_score THEN 0 ELSE 1 END AS label,
    CASE WHEN home_score > away_score THEN 3 WHEN home_score < away_score THEN 0 ELSE 1 END AS home_points,
    CASE WHEN home_score > away_score THEN 0 WHEN home_score < away_score THEN 3 ELSE 1 END AS away_points,
    CASE WHEN home_score > away_score THEN 1.0 WHEN home_score < away_score THEN 0.0 ELSE 0.5 END::DOUBLE AS home_result FROM contest""",
)
def outcome(spark, sf):
    h, a = F.col("home_score"), F.col("away_score")
    return V.contest(spark, sf).select(
        "pool",
        "seq",
        outcomes.outcome_text(h, a).alias("result"),
        outcomes.outcome_label(h, a).alias("label"),
        outcomes.points(h, a).alias("home_points"),
        outcomes.points(a, h).alias("away_points"),
        outcomes.result_score(h, a).alias("home_result"),
    )


@query("p6_weight_rule", f"SELECT pool, seq, tournament, {weight('tournament')} AS weight FROM contest")
def weight_rule(spark, sf):
    return V.contest(spark, sf).select("pool", "seq", "tournament", rules.rating_weight(F.col("tournament")).alias("weight"))


@query(
    "p7_expected",
    f"""SELECT pool, seq, {rnd('(1 / (1 + pow(10, (elo_away - elo_home) / 400.0::DOUBLE)))', 9)} AS home_expected,
    {rnd('(1 / (1 + pow(10, (elo_home - elo_away) / 400.0::DOUBLE)))', 9)} AS away_expected FROM rated""",
)
def expected(spark, sf):
    h, a = F.col("elo_home"), F.col("elo_away")
    return V.rated(spark, sf).select(
        "pool",
        "seq",
        round_half_up(scores.expected_score(h, a), 9).alias("home_expected"),
        round_half_up(scores.expected_score(a, h), 9).alias("away_expected"),
    )


@query(
    "p8_effective_date",
    """SELECT o_orderkey, make_date(year(o_orderdate), CASE WHEN o_orderstatus <> 'P' AND month(o_orderdate) > 6 THEN 7 ELSE 1 END, 1) AS effective
    FROM orders""",
)
def effective_date(spark, sf):
    half = F.when(F.col("o_orderstatus") != "P", F.when(F.month("o_orderdate") <= 6, 1).otherwise(2))
    return T(spark, sf, "orders").select("o_orderkey", dates.effective_date(F.year("o_orderdate"), half).alias("effective"))


@query("p9_flag", "SELECT pool, seq, neutral::INTEGER AS neutral_flag, (stage = 'Final' AND stage IS NOT NULL)::INTEGER AS final_flag FROM contest")
def flag(spark, sf):
    final = F.when(F.col("stage") == "Final", "TRUE").when(F.col("stage").isNotNull(), "no")
    return V.contest(spark, sf).select(
        "pool", "seq", outcomes.flag(F.initcap(F.col("neutral").cast("string"))).alias("neutral_flag"), outcomes.flag(final).alias("final_flag")
    )


# Differences of both sides: metric of the features, column of the rankings.
_DIFFS = {"elo": "elo", "ranking": "rank", "win_percentage": "win_pct", "player_strength": "player_strength", "form": "form", "goals_scored": "avg_goals_scored", "goals_conceded": "avg_goals_conceded"}


@query(
    "p10_diffs",
    "SELECT c.pool, c.seq, "
    + ", ".join(f"{rnd(f'(a.{c} - h.{c})' if m == 'ranking' else f'(h.{c} - a.{c})', 3)} AS {m}_diff" for m, c in _DIFFS.items())
    + " FROM contest c JOIN team_rankings h ON c.home = h.team JOIN team_rankings a ON c.away = a.team",
)
def diffs(spark, sf):
    dim = V.team_rankings(spark, sf)
    side = lambda s: dim.select(F.col("team").alias(s), *[F.col(c).alias(f"{s}_{m}") for m, c in _DIFFS.items()])
    both = V.contest(spark, sf).select("pool", "seq", "home", "away").join(side("home"), "home").join(side("away"), "away")
    out = C.difference_features(both, list(_DIFFS), reversed_metrics=("ranking",))
    return out.select("pool", "seq", *[round_half_up(F.col(f"{m}_diff"), 3).alias(f"{m}_diff") for m in _DIFFS])


@query(
    "p11_round",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"{rnd('(l_extendedprice * (1 - l_discount) / 7)', n)} AS net_{n}" for n in (1, 2, 3, 4))
    + " FROM lineitem",
)
def rounding(spark, sf):
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) / F.lit(7)
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[round_half_up(net, n).alias(f"net_{n}") for n in (1, 2, 3, 4)])


@query(
    "p12_row_mean",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('(s / nullif(n, 0))', 6)} AS mean
    FROM (SELECT *, coalesce(l_discount, 0) + coalesce(l_tax, 0) AS s, (nullif(l_discount, 0) IS NOT NULL)::INT + (nullif(l_tax, 0) IS NOT NULL)::INT AS n FROM lineitem)""",
)
def row_mean(spark, sf):
    parts = [F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")]
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", round_half_up(scores.row_mean(*parts), 6).alias("mean"))


@query(
    "p13_fill_defaults",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(nullif(l_discount, 0), 0.33)::DOUBLE AS discount, coalesce(nullif(l_tax, 0), 7.5)::DOUBLE AS tax
    FROM lineitem""",
)
def fill_defaults(spark, sf):
    holes = [F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"), F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax")]
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *holes).fillna({"discount": 0.33, "tax": 7.5})


@query("p14_composite", "SELECT actor, team_strength_score FROM profile")
def composite(spark, sf):
    return V.profile(spark, sf).select("actor", "team_strength_score")


def _id_sql(c: str) -> str:
    plain = f"translate(strip_accents({c}), '’‘“”´`–—', '''''\"\"''''--')"
    plain = f"replace(replace(replace(replace({plain}, '.', ''), ',', ''), '(', ''), ')', '')"
    return f"trim(regexp_replace(lower({plain}), '\\s+', ' ', 'g'))"


@query("p15_normalize_id", f"SELECT doc_id, {_id_sql('text')} AS normalized FROM documents")
def normalize_id(spark, sf):
    return T(spark, sf, "documents").select("doc_id", normalized_id(F.col("text")).alias("normalized"))


@query(
    "p16_canonical_map",
    f"""WITH src AS (SELECT {_id_sql('c_name')} AS key, c_name AS name, 0 AS priority FROM customer
      UNION ALL SELECT {_id_sql('c_name')}, upper(c_name), 1 FROM customer WHERE c_acctbal > 5000
      UNION ALL SELECT 'customer#000000003', 'Third', 2 UNION ALL SELECT 'old customer', 'Customer#000000000', 2),
    best AS (SELECT key, name FROM src QUALIFY row_number() OVER (PARTITION BY key ORDER BY priority DESC, name DESC) = 1),
    asked AS (SELECT c_name AS asked, {_id_sql("'Ç' || substr(c_name, 2) || '.'")} AS key FROM customer UNION ALL SELECT s_name, {_id_sql('s_name')} FROM supplier)
    SELECT asked, coalesce(name, '') AS name FROM asked LEFT JOIN best USING (key)""",
)
def canonical_map(spark, sf):
    customers = T(spark, sf, "customer")
    override = customers.filter(F.col("c_acctbal") > 5000).select(F.upper("c_name").alias("name"))
    aliases = {"customer#000000003": "Third", "old customer": "Customer#000000000"}
    names = C.canonical_map([customers.select(F.col("c_name").alias("name")), override], aliases)
    spelled = F.concat(F.lit("Ç"), F.expr("substr(c_name, 2)"), F.lit("."))
    asked = customers.select(F.col("c_name").alias("asked"), spelled.alias("variant")).union(T(spark, sf, "supplier").select("s_name", "s_name"))
    return C.resolve_names(asked, "variant", names, "name").select("asked", "name")


@query(
    "p16_close_names",
    """WITH n AS (SELECT lower(n_name) AS match FROM nation),
    v AS (SELECT c_custkey, lower(n_name) AS name, (c_custkey % length(n_name) + 1)::INTEGER AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey),
    k AS (SELECT c_custkey, left(name, pos - 1) || CASE c_custkey % 4 WHEN 0 THEN substr(name, pos, 1) WHEN 1 THEN '?' WHEN 2 THEN '' ELSE 'xx' END || substr(name, pos + 1) AS key FROM v),
    m AS (SELECT c_custkey, key, match FROM k, n WHERE CASE WHEN contains(key, '?') THEN match LIKE replace(key, '?', '_') ELSE levenshtein(key, match) <= 1 END)
    SELECT c_custkey, k.key, first(match ORDER BY m.key <> match, match) FILTER (match IS NOT NULL) AS match FROM k LEFT JOIN m USING (c_custkey) GROUP BY ALL""",
)
def close_names(spark, sf):
    """Nations spelt with a wrong, missing or unknown character."""
    nations = T(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("name"))
    asked = T(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    at = (F.col("c_custkey") % F.length("name") + 1).cast("int")
    kind = F.col("c_custkey") % 4
    middle = F.when(kind == 0, F.substr("name", at, F.lit(1))).when(kind == 1, "?").when(kind == 2, "").otherwise("xx")
    key = F.concat(F.substr("name", F.lit(1), at - 1), middle, F.substr("name", at + 1))
    return resolve_close(asked.select("c_custkey", key.alias("key")), "key", nations.select(F.col("name").alias("key")), "match")


@query("p17_stage_category", f"SELECT pool, seq, stage, {stage_category('stage')} AS stage_category FROM contest")
def stage(spark, sf):
    return V.contest(spark, sf).select("pool", "seq", "stage", rules.stage_category(F.col("stage")).alias("stage_category"))


@query(
    "p18_text_datetime",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS match_date,
    CASE WHEN o_orderstatus <> 'P' THEN '15:' || CASE WHEN o_orderstatus = 'F' THEN '00' ELSE '30' END ELSE '' END AS match_time FROM orders""",
)
def text_datetime(spark, sf):
    good = F.concat(F.date_format("o_orderdate", "d MMM yyyy"), F.when(F.col("o_orderstatus") == "F", " - 15:00").otherwise(" -15:30"))
    raw = T(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", good).otherwise("to be set").alias("text"))
    return raw.select("o_orderkey", dates.text_date(F.col("text")).alias("match_date"), dates.text_time(F.col("text")).alias("match_time"))


@query(
    "p19_scoreline",
    """SELECT pool, seq, home_score || '-' || away_score AS scoreline, home_score + away_score AS total_goals, abs(home_score - away_score) AS goal_difference,
    CASE WHEN home_score = away_score THEN 0 ELSE abs(home_score - away_score) END AS margin_of_victory FROM contest""",
)
def scoreline(spark, sf):
    h, a = F.col("home_score"), F.col("away_score")
    return V.contest(spark, sf).select(
        "pool", "seq", outcomes.scoreline(h, a).alias("scoreline"), (h + a).alias("total_goals"), F.abs(h - a).alias("goal_difference"), outcomes.margin(h, a).alias("margin_of_victory")
    )


@query("p20_winner", "SELECT pool, seq, CASE WHEN home_score > away_score THEN home WHEN home_score < away_score THEN away ELSE 'Draw' END AS winner FROM contest")
def winner(spark, sf):
    won = outcomes.winner(F.col("home"), F.col("away"), F.col("home_score"), F.col("away_score"))
    return V.contest(spark, sf).select("pool", "seq", won.alias("winner"))


_GROUPS = """CASE WHEN contains(feature, 'elo') THEN 'ELO' WHEN contains(feature, 'fifa') THEN 'FIFA' WHEN contains(feature, 'goal') THEN 'Goals'
    WHEN contains(feature, 'win') AND contains(feature, 'diff') THEN 'Win Gap' WHEN contains(feature, 'win') THEN 'Win Rate'
    WHEN contains(feature, 'form') THEN 'Form' WHEN contains(feature, 'player') THEN 'Player Strength'
    WHEN contains(feature, 'neutral') THEN 'Match Context' ELSE 'Other' END"""
_TEXTS = " ".join(f"WHEN '{name}' THEN '{text}'" for name, text in rules.FEATURE_DESCRIPTIONS.items())


@query(
    "p21_feature_group",
    f"""SELECT feature, {_GROUPS} AS feature_group, CASE feature {_TEXTS} ELSE '{rules.DEFAULT_DESCRIPTION}' END AS description, count(*) AS observations
    FROM (SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in FEATURES)} FROM match_features) UNPIVOT (value FOR feature IN ({', '.join(FEATURES)})) GROUP BY feature""",
)
def feature_groups(spark, sf):
    long = to_long(V.match_features(spark, sf), [], {c: c for c in FEATURES}, "feature")
    counted = long.groupBy("feature").agg(F.count("value").alias("observations"))
    return counted.select("feature", rules.feature_group(F.col("feature")).alias("feature_group"), rules.feature_description(F.col("feature")).alias("description"), "observations")


@query(
    "p22_tier",
    """SELECT team, championship_probability, CASE WHEN championship_probability >= 15 THEN 'Top Favourite' WHEN championship_probability >= 8 THEN 'Contender'
    WHEN championship_probability >= 3 THEN 'Dark Horse' ELSE 'Underdog' END AS tier FROM title_odds""",
)
def tier(spark, sf):
    return V.title_odds(spark, sf).select("team", "championship_probability", rules.tier(F.col("championship_probability")).alias("tier"))


@query(
    "p23_lookup_default",
    """SELECT c_custkey, CASE WHEN r_name IS NULL OR r_name = 'EUROPE' THEN 'Other' ELSE r_name END AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def lookup_default(spark, sf):
    known = T(spark, sf, "region").filter(F.col("r_name") != "EUROPE")
    dim = T(spark, sf, "nation").join(known, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    return C.lookup(T(spark, sf, "customer"), dim, F.col("c_nationkey") == F.col("n_nationkey"), "region", "Other").select("c_custkey", "region")


_AXES = [("Attack", "avg_attack", 30, 90), ("Defense", "avg_defense", 30, 90), ("Form", "form_score", 0, 20), ("ELO", "elo_rating", 1200, 2100), ("Strength", "avg_overall", 50, 90), ("Rank", "rank", 200, 1)]


@query(
    "p24_axis_scores",
    " UNION ALL ".join(
        f"SELECT actor, '{n}' AS axis, {rnd(f'(100.0::DOUBLE * least(greatest(({c} - {lo}.0::DOUBLE) / {hi - lo}.0::DOUBLE, 0), 1))', 6)} AS score FROM profile" for n, c, lo, hi in _AXES
    ),
)
def axis_scores(spark, sf):
    p = V.profile(spark, sf).withColumnsRenamed({"avg_attack": "attack", "avg_defense": "defense", "form_score": "form", "elo_rating": "elo", "avg_overall": "player_strength"})
    scored = p.select("actor", *[round_half_up(scores.axis_score(F.col(c), lo, hi), 6).alias(name) for name, c, lo, hi in scores.AXES])
    return to_long(scored, ["actor"], {name: name for name, *_ in scores.AXES}, "axis", "score")


_HOST_SQL = ", ".join(f"'{h}'" for h in HOSTS)


@query(
    "p25_outcome_probs",
    f"""WITH a AS (SELECT pool, seq, home, away, 1 / (1 + pow(10, (elo_away - elo_home) / 400.0::DOUBLE)) AS base,
      greatest(0.15::DOUBLE, 0.28::DOUBLE - abs(elo_home - elo_away) / 2000.0::DOUBLE) AS dr FROM rated),
    b AS (SELECT *, CASE WHEN home IN ({_HOST_SQL}) THEN least((1 - dr) * base + 0.04::DOUBLE, 0.90::DOUBLE) ELSE (1 - dr) * base END AS w,
      CASE WHEN away IN ({_HOST_SQL}) THEN least((1 - dr) * (1 - base) + 0.04::DOUBLE, 0.90::DOUBLE) ELSE (1 - dr) * (1 - base) END AS l FROM a)
    SELECT pool, seq, {rnd('(w / (w + dr + l))', 7)} AS p_home, {rnd('(dr / (w + dr + l))', 7)} AS p_draw, {rnd('(l / (w + dr + l))', 7)} AS p_away FROM b""",
)
def outcome_probs(spark, sf):
    p = scores.outcome_probabilities(F.col("elo_home"), F.col("elo_away"), F.col("home").isin(*HOSTS), F.col("away").isin(*HOSTS))
    return V.rated(spark, sf).select("pool", "seq", *[round_half_up(c, 7).alias(n) for n, c in p.items()])


@query(
    "p26_precedence",
    """SELECT c_custkey, coalesce(f.v, o.v, CASE WHEN c_acctbal > 5000 THEN c_acctbal END, 0)::DOUBLE AS value FROM customer
    LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) f ON c_custkey = f.o_custkey
    LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) o ON c_custkey = o.o_custkey""",
)
def precedence(spark, sf):
    orders, customers = T(spark, sf, "orders"), T(spark, sf, "customer")
    best = lambda keep: orders.filter(keep).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("value"))
    rich = customers.filter(F.col("c_acctbal") > 5000).select("c_custkey", F.col("c_acctbal").alias("value"))
    sources = [best(F.col("o_orderstatus") == "P"), best(F.col("o_orderpriority") == "1-URGENT"), rich]
    return C.merge_by_precedence(customers.select("c_custkey"), sources, "c_custkey", "value", 0.0)


@query(
    "p27_proxy_scores",
    f"""SELECT actor, {rnd('(CASE WHEN a > 0 THEN a ELSE least(greatest(goals_scored_avg * 35, 35), 90) END)', 6)} AS attack,
    {rnd('(CASE WHEN b > 0 THEN b ELSE least(greatest((3.5 - goals_conceded_avg) * 22, 30), 90) END)', 6)} AS defense
    FROM (SELECT f.*, CASE WHEN avg_attack > 65 THEN avg_attack ELSE 0 END AS a, CASE WHEN avg_defense > 65 THEN avg_defense END AS b
      FROM team_form f LEFT JOIN squad_latest s ON f.actor = s.country)""",
)
def proxies(spark, sf):
    joined = V.team_form(spark, sf).join(V.squad_latest(spark, sf), F.col("actor") == F.col("country"), "left")
    attack = F.when(F.col("avg_attack") > 65, F.col("avg_attack")).otherwise(0.0)
    defense = F.when(F.col("avg_defense") > 65, F.col("avg_defense"))
    return joined.select(
        "actor",
        round_half_up(scores.proxy_attack(attack, F.col("goals_scored_avg")), 6).alias("attack"),
        round_half_up(scores.proxy_defense(defense, F.col("goals_conceded_avg")), 6).alias("defense"),
    )


@query(
    "p28_insight_text",
    """SELECT pool, actor, printf('%s won %.2f%% of its %d contests', actor, floor(wins::DOUBLE / games * 100 * 100.0::DOUBLE + 0.500001::DOUBLE) / 100.0::DOUBLE, games) AS line
    FROM (SELECT pool, actor, count(*) AS games, count(*) FILTER (points = 3) AS wins FROM contest_long GROUP BY pool, actor)""",
)
def insight_text(spark, sf):
    games, wins = F.count(F.lit(1)), count_if(F.col("points") == 3)
    share = round_half_up(ratio(wins, games) * F.lit(100.0), 2)
    lines = V.contest_long(spark, sf).groupBy("pool", "actor").agg(share.alias("share"), games.alias("games"))
    return lines.select("pool", "actor", F.format_string("%s won %.2f%% of its %d contests", "actor", "share", "games").alias("line"))


@query(
    "p29_shares",
    f"""SELECT event_type, count(*) AS n, {rnd('(count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE * 100)', 4)} AS pct, {rnd('(count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE)', 6)} AS frac
    FROM events GROUP BY event_type""".replace("OVER ()::DOUBLE", "OVER ()"),
)
def shares(spark, sf):
    counts = T(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n").alias("t")).scalar()
    share = ratio(F.col("n"), total, 0.0)
    return counts.select("event_type", "n", round_half_up(share * F.lit(100), 4).alias("pct"), round_half_up(share, 6).alias("frac"))


@query("f1_dropna", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0")
def dropna(spark, sf):
    holes = T(spark, sf, "lineitem").withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")})
    return drop_nulls(holes, "l_discount", "l_tax").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("f2_in_list", "SELECT pool, seq, home, away FROM contest WHERE home IN ('NATION_1', 'NATION_2', 'NATION_7') AND away IN ('NATION_1', 'NATION_2', 'NATION_7')")
def in_list(spark, sf):
    chosen = ("NATION_1", "NATION_2", "NATION_7")
    return V.contest(spark, sf).filter(F.col("home").isin(*chosen) & F.col("away").isin(*chosen)).select("pool", "seq", "home", "away")


@query("f3_threshold", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000 AND o_orderdate >= TIMESTAMP '1996-01-01'")
def threshold(spark, sf):
    keep = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000) & (F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("1996-01-01"), F.lit("yyyy-MM-dd")))
    return T(spark, sf, "orders").filter(keep).select("o_orderkey", "o_totalprice")


@query(
    "f4_any_column_search",
    """SELECT doc_id, lang, source FROM documents WHERE contains(lower(doc_id::VARCHAR), 'th') OR contains(lower(text), 'th') OR contains(lower(lang), 'th')
    OR contains(lower(source), 'th') OR contains(lower(n_chars::VARCHAR), 'th')""",
)
def any_column_search(spark, sf):
    return C.contains_anywhere(T(spark, sf, "documents"), "TH").select("doc_id", "lang", "source")


@query("f5_point_lookup", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7 ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def point_lookup(spark, sf):
    # The key filter goes below the deduplication, so only that key's rows are read and shuffled.
    latest = first_per_key(T(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return latest.filter(F.col("o_custkey") == 7).select("o_custkey", "o_orderkey", "o_totalprice").limit(1)
