"""Power index, executive figures and dashboard metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.rounding import ratio, round_half_up
from matchloom.functions.scores import POWER_WEIGHTS, min_max
from matchloom.operators.aggregates import count_if, infer_total, most_frequent
from matchloom.operators.ranks import report_ranks

RANKED = {"elo": "elo_rank", "form": "form_rank", "player_strength": "player_strength_rank", "win_pct": "win_pct_rank", "power_index": "power_rank"}


def scaled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add each expression min-max scaled over the whole table; extremes come from one scalar aggregate."""
    filled = df.withColumns({f"__x_{n}": e for n, e in columns.items()})
    extremes = filled.agg(F.struct(*[f(f"__x_{n}").alias(f"{k}_{n}") for n in columns for k, f in (("lo", F.min), ("hi", F.max))]).alias("e")).scalar()
    with_bounds = filled.withColumn("__e", extremes)
    out = {n: min_max(F.col(f"__x_{n}"), F.col(f"__e.lo_{n}"), F.col(f"__e.hi_{n}")) for n in columns}
    return with_bounds.withColumns(out).drop("__e", *[f"__x_{n}" for n in columns])


def power_index(rankings: DataFrame, odds: DataFrame, drop_incomplete: bool = False, digits: int = 9) -> DataFrame:
    """Weighted sum of five min-max scores times 100, ranks by five metrics, and the title odds (0 if none).

    A missing rank counts as the worst one. With ``drop_incomplete`` rows without elo, form or strength
    are left out first and a missing win share counts as 0.
    """
    base = rankings
    if drop_incomplete:
        base = base.dropna(subset=["elo", "form", "player_strength"]).fillna({"win_pct": 0.0})
    base = base.join(odds.select("team", "championship_probability"), "team", "left").fillna({"championship_probability": 0.0})
    worst = base.agg(F.max("rank")).scalar()
    parts = scaled(
        base,
        {
            "elo_score": F.col("elo"),
            "form_score_norm": F.col("form"),
            "player_score_norm": F.col("player_strength"),
            "win_score_norm": F.col("win_pct"),
            "__rank_norm": F.coalesce("rank", worst).cast("double"),
        },
    ).withColumn("rank_score_norm", F.lit(1.0) - F.col("__rank_norm"))
    w = POWER_WEIGHTS
    index = (
        F.col("elo_score") * F.lit(w["elo"])
        + F.col("form_score_norm") * F.lit(w["form"])
        + F.col("player_score_norm") * F.lit(w["strength"])
        + F.col("win_score_norm") * F.lit(w["win"])
        + F.col("rank_score_norm") * F.lit(w["rank"])
    ) * F.lit(100.0)
    # Rounding the index keeps equal teams equal when they are ranked.
    indexed = parts.drop("__rank_norm").withColumn("power_index", round_half_up(index, digits))
    return report_ranks(indexed, RANKED)


def top_entries(table: DataFrame, key: str, value: str) -> Column:
    """Struct (key, value) of the best row; the first key wins a tie."""
    best = table.orderBy(F.col(value).desc_nulls_last(), key).limit(1)
    return best.select(F.struct(F.col(key).alias("name"), F.col(value).alias("value")).alias("top")).scalar()


def dashboard_metadata(power: DataFrame, odds: DataFrame) -> DataFrame:
    """Five named facts, value as text."""
    top_power, top_odds = top_entries(power, "team", "power_index"), top_entries(odds, "team", "championship_probability")
    one = power.agg(F.count(F.lit(1)).alias("teams")).withColumns({"p": top_power, "o": top_odds})
    entry = lambda name, value, text: F.struct(F.lit(name).alias("metric_name"), value.alias("value"), F.lit(text).alias("description"))
    rows = F.array(
        entry("total_current_teams", F.col("teams").cast("string"), "Teams in the dashboard table."),
        entry("top_power_index_team", F.col("p.name"), "Team with the best power index."),
        entry("top_power_index_score", text_of(F.col("p.value"), 2), "Best power index."),
        entry("top_championship_probability_team", F.col("o.name"), "Team with the best title odds."),
        entry("top_championship_probability_pct", text_of(F.col("o.value"), 2), "Best title odds in percent."),
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def text_of(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", round_half_up(value.cast("double"), digits))


# What each key figure says.
KPI_TEXTS = {
    "total_tournaments": "Tournaments that the matches belong to.",
    "total_matches": "Matches of all tournaments.",
    "total_goals": "Goals of all matches.",
    "average_goals_per_match": "Goals of a match, on average.",
    "total_unique_teams": "Teams with at least one match.",
    "average_attendance_per_match": "Attendance of a match, on average over those with a known one.",
    "home_win_percentage": "Percent of matches that the home side won.",
    "away_win_percentage": "Percent of matches that the away side won.",
    "draw_percentage": "Percent of matches without a winner.",
    "most_successful_team": "Team that won most finals.",
    "most_successful_team_titles": "Finals that this team won.",
    "top_champion_probability_team": "Team with the best title odds.",
    "top_champion_probability_percent": "Best title odds in percent.",
    "top_power_index_team": "Team with the best power index.",
    "top_power_index_score": "Best power index.",
    "top_5_power_index_average": "Mean power index of the best five teams.",
    "top_10_championship_probability_share": "Title odds of the ten best teams together, in percent.",
    "simulation_runs": "Trials behind the title odds.",
}


def executive_summary(summary: DataFrame, power: DataFrame, odds: DataFrame) -> DataFrame:
    """Key figures in long form: (metric_name, value as text, category, description).

    All match figures come from one aggregate. Others are scalar subqueries over small tables.
    """
    games = F.count(F.lit(1))
    matches = summary.agg(
        F.count_distinct("year").alias("years"),
        games.alias("games"),
        F.sum("total_goals").alias("goals"),
        ratio(F.sum("total_goals"), games).alias("avg_goals"),
        F.avg(F.when(F.col("attendance") > 0, F.col("attendance"))).alias("attendance"),
        ratio(count_if(F.col("result") == "home_win"), games, 0.0).alias("home"),
        ratio(count_if(F.col("result") == "away_win"), games, 0.0).alias("away"),
        ratio(count_if(F.col("result") == "draw"), games, 0.0).alias("draw"),
    )
    teams = summary.select(F.explode(F.array("home", "away")).alias("team")).agg(F.count_distinct("team")).scalar()
    titles = most_frequent(summary.filter(F.col("stage") == "Final"), "winner_team", "name", "value").select(F.struct("name", "value").alias("t")).scalar()
    top5 = power.orderBy(F.col("power_index").desc(), "team").limit(5).agg(F.avg("power_index")).scalar()
    by_odds = [F.col("championship_probability").desc(), F.col("team")]
    top10 = odds.orderBy(*by_odds).limit(10).agg(F.sum("championship_probability")).scalar()
    one = matches.withColumns(
        {
            "teams": teams,
            "titles": titles,
            "p": top_entries(power, "team", "power_index"),
            "o": top_entries(odds, "team", "championship_probability"),
            "top5": top5,
            "top10": top10,
            "runs": infer_total(odds, "champion_count", "championship_probability", by_odds),
        }
    )
    whole = lambda c: F.col(c).cast("string")
    percent = lambda c: text_of(F.col(c) * F.lit(100.0), 2)
    figures = [
        ("total_tournaments", whole("years"), "Tournament"),
        ("total_matches", whole("games"), "Tournament"),
        ("total_goals", whole("goals"), "Match Analytics"),
        ("average_goals_per_match", text_of(F.col("avg_goals"), 2), "Match Analytics"),
        ("total_unique_teams", whole("teams"), "Teams"),
        ("average_attendance_per_match", text_of(F.col("attendance"), 0), "Fan Experience"),
        ("home_win_percentage", percent("home"), "Match Analytics"),
        ("away_win_percentage", percent("away"), "Match Analytics"),
        ("draw_percentage", percent("draw"), "Match Analytics"),
        ("most_successful_team", F.col("titles.name"), "Teams"),
        ("most_successful_team_titles", whole("titles.value"), "Teams"),
        ("top_champion_probability_team", F.col("o.name"), "Simulation"),
        ("top_champion_probability_percent", text_of(F.col("o.value"), 2), "Simulation"),
        ("top_power_index_team", F.col("p.name"), "Power Index"),
        ("top_power_index_score", text_of(F.col("p.value"), 2), "Power Index"),
        ("top_5_power_index_average", text_of(F.col("top5"), 2), "Power Index"),
        ("top_10_championship_probability_share", text_of(F.col("top10"), 2), "Simulation"),
        ("simulation_runs", whole("runs"), "Simulation"),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("metric_name"), v.alias("value"), F.lit(c).alias("category"), F.lit(KPI_TEXTS[n]).alias("description")) for n, v, c in figures])
    # Without positive odds the number of runs is unknown and its row is left out.
    return one.select(F.explode(rows).alias("r")).select("r.*").filter((F.col("metric_name") != "simulation_runs") | F.col("value").isNotNull())


def enriched_odds(odds: DataFrame) -> DataFrame:
    """Title odds with the number of trials behind them, rank, top-ten flag and share."""
    order = [F.col("championship_probability").desc(), F.col("team")]
    runs = infer_total(odds, "champion_count", "championship_probability", order)
    ranked = report_ranks(odds.withColumn("simulation_runs", runs), {"championship_probability": "probability_rank"})
    share = round_half_up(F.col("championship_probability") / F.lit(100.0), 6)
    return ranked.withColumns({"top_10_flag": F.col("probability_rank") <= 10, "championship_probability_share": share})
