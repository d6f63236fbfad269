"""The whole job on the football files: clean, features, profiles, models, reports.

``run(spark, raw_dir, out_dir, odds)`` writes every table below ``out_dir`` as Parquet, and the reporting tables as CSV
too. ``odds`` has the title odds: (team, champion_count, championship_probability).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.dates import text_date, text_time
from matchloom.functions.names import HISTORICAL_ALIASES
from matchloom.functions.outcomes import result_score
from matchloom.functions.rounding import round_half_up
from matchloom.functions.rules import rating_weight
from matchloom.functions.scores import row_mean
from matchloom.operators import models as M
from matchloom.operators.aggregates import collapse, stage_rollup
from matchloom.operators.clean import latest_per_key
from matchloom.operators.columns import canonical_map, resolve_names
from matchloom.operators.features import match_features
from matchloom.operators.metrics import described_importance, mean_importance, scaled_importance
from matchloom.operators.ordered import chronological_split, with_ordinal
from matchloom.operators.power import dashboard_metadata, enriched_odds, executive_summary, power_index
from matchloom.operators.profiles import form_snapshot, rankings_view, team_profile
from matchloom.operators.rating import final_ratings, sequential_rating
from matchloom.operators.reshape import contest_sides
from matchloom.operators.summary import match_summary
from matchloom.plans import cleaning
from matchloom.sources.describe import Steps, data_dictionary, described
from matchloom.sources.writers import nested_summary, write_csv, write_json

CLEANERS = {
    "all_matches": cleaning.all_matches,
    "fifa_mens_rank": cleaning.rankings,
    "WorldCupMatches": cleaning.world_cup_matches,
    "player_aggregates": cleaning.player_aggregates,
    "former_names": cleaning.former_names,
}


class Store:
    """Tables below one folder: written once, read back, so that each step starts from stored input."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def report(self, name: str, df: DataFrame, single_file: bool = True) -> DataFrame:
        """``single_file`` is for tables that don't grow with the facts."""
        table = self.put(name, df)
        write_csv(table, f"{self.folder}/csv/{name}", single_file=single_file)
        return table


def run(spark: SparkSession, raw_dir: str, out_dir: str, odds: DataFrame, settings: M.Settings = M.Settings()) -> dict[str, DataFrame]:
    store = Store(spark, out_dir)
    raw, seen = {}, {name: Steps(name) for name in CLEANERS}
    for name, clean in CLEANERS.items():
        raw[name] = store.put(f"clean/{name}", clean(cleaning.read_raw(spark, raw_dir, name), seen[name]))
    steps = store.report("cleaning_steps", reduce(DataFrame.union, [s.report(spark) for s in seen.values()]))
    counts = steps.where("rule = 'kept'").select("dataset", F.col("n").alias("n_rows"))
    out = {"cleaning_report": store.report("cleaning_report", counts), "cleaning_steps": steps}
    out |= features(store, raw)
    out |= profiles(store, raw, out)
    out |= train(store, out["match_features"], settings)
    known = canonical_map([out["team_profiles"].select(F.col("actor").alias("name"))], {})
    # Teams may be spelt another way than in the results; what stays unknown is reported.
    named = store.put("named_odds", resolve_names(odds, "team", known, "known"))
    out["unmatched_teams"] = named.filter(F.col("known") == "").select("team")
    out["title_odds"] = store.report("title_odds", named.withColumn("team", F.when(F.col("known") != "", F.col("known")).otherwise(F.col("team"))).drop("known"))
    document = nested_summary(out["title_odds"], out["title_odds"].agg(F.sum("champion_count")).scalar(), "team", "champion_count", "championship_probability")
    write_json(document, f"{store.folder}/trial_summary")
    return out | reports(store, raw, out)


def features(store: Store, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    games = raw["all_matches"].withColumnsRenamed({"home_team": "home", "away_team": "away", "date": "d"}).withColumns(
        {"pool": F.lit("all"), "weight": rating_weight(F.col("tournament")), "score": result_score(F.col("home_score"), F.col("away_score"))}
    )
    numbered = store.put("contests", with_ordinal(games, ["pool"], ["d"], ["home", "away"], "seq"))
    rated = store.put("rated", sequential_rating(numbered, ["seq"], "score", "weight").drop("weight", "score"))
    history = raw["fifa_mens_rank"].select(F.col("team").alias("actor"), F.col("ranking_date").alias("ts"), "rank")
    scores = [F.col(c) for c in ("avg_overall", "avg_attack_overall", "avg_defense_overall")]
    strength = raw["player_aggregates"].select(F.col("country").alias("actor"), row_mean(*scores).alias("strength")).dropna()
    return {"rated": rated, "match_features": store.put("match_features", match_features(rated, history, strength))}


def profiles(store: Store, raw: dict[str, DataFrame], out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    finals = final_ratings(out["rated"], "seq")
    elo = store.report("elo_ratings", finals.select("actor", round_half_up(F.col("rating"), 3).alias("elo_rating")))
    form = store.report("team_form", form_snapshot(contest_sides(out["rated"], ["pool", "seq", "d"]), ["d", "seq"]))
    latest = latest_per_key(raw["fifa_mens_rank"], ["team"], "ranking_date", ["rank", "total_points"])
    ranks = store.report("rankings_latest", latest.select(F.col("team").alias("actor"), "rank", F.col("total_points").alias("rank_points")))
    renamed = {"country": "actor", "avg_attack_overall": "avg_attack", "avg_defense_overall": "avg_defense"}
    squads = raw["player_aggregates"].withColumnsRenamed(renamed).select("actor", "avg_overall", "avg_attack", "avg_defense", "avg_pace", "avg_passing", "avg_dribbling")
    return {"team_profiles": store.report("team_profiles", team_profile(elo, form, ranks, squads)), "rankings_latest": ranks}


def train(store: Store, table: DataFrame, settings: M.Settings) -> dict[str, DataFrame]:
    split = chronological_split(table, ["date"], ["home_team", "away_team", "seq"], 0.8)
    rows = store.put("model_rows", M.feature_contract(split, keep=("split",)))
    training, test = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")
    fitted = {name: M.train(name, training, settings) for name in M.NAMES}
    for name, model in fitted.items():
        M.save(model, f"{store.folder}/models/{name}")
    metrics = store.put("evaluation_report", reduce(lambda a, b: a.unionByName(b), [M.model_metrics(n, M.predict(m, test).select("label", "pred")) for n, m in fitted.items()]))
    values = mean_importance(M.importances({n: fitted[n] for n in M.NAMES[1:]}, rows))
    importance = store.report("feature_importance", described_importance(scaled_importance(values)))
    return {"evaluation_report": metrics, "best_model": M.best_model(metrics), "feature_importance": importance}


def reports(store: Store, raw: dict[str, DataFrame], out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    odds, rankings = out["title_odds"], rankings_view(out["team_profiles"])
    power = store.report("team_rankings", power_index(rankings, odds))
    known = canonical_map([out["rankings_latest"].select(F.col("actor").alias("name")), odds.select(F.col("team").alias("name"))], HISTORICAL_ALIASES)
    numbers = [c for c in rankings.columns if c != "team"]
    modern = resolve_names(rankings, "team", known, "canonical").filter(F.col("canonical") != "")
    merged = collapse(modern.drop("team").withColumnRenamed("canonical", "team"), "team", numbers, [], "team")
    dashboard = store.report("team_rankings_dashboard", power_index(merged, odds))
    metadata = store.report("dashboard_metadata", dashboard_metadata(dashboard, odds))
    enriched = store.report("championship_probabilities", enriched_odds(odds))
    cup = raw["WorldCupMatches"]
    cup = cup.select(
        *[c for c in cleaning.SUMMARY_EXTRAS if c in cup.columns],
        F.lit("cup").alias("pool"),
        F.col("MatchID").alias("seq"),
        F.make_date("Year", F.lit(1), F.lit(1)).alias("d"),
        F.col("home_team").alias("home"),
        F.col("away_team").alias("away"),
        F.col("home_goals").alias("home_score"),
        F.col("away_goals").alias("away_score"),
        F.col("Stage").alias("stage"),
        F.col("Attendance").cast("bigint").alias("attendance"),
        text_date(F.col("Datetime")).alias("played"),
        text_time(F.col("Datetime")).alias("match_time"),
    )
    extras = [c for c in (*cleaning.SUMMARY_EXTRAS, "played", "match_time") if c in cup.columns]
    summary = match_summary(cup, extras).drop("match_date").withColumnRenamed("played", "match_date")
    summary = store.report("historical_match_summary", summary, single_file=False)
    statistics = store.report("tournament_statistics", stage_rollup(summary))
    executive = store.report("executive_summary", executive_summary(summary, power, odds))
    tables = {"executive_summary": executive, "team_rankings": power, "team_rankings_dashboard": dashboard, "dashboard_metadata": metadata, "championship_probabilities": enriched, "feature_importance": out["feature_importance"], "historical_match_summary": summary, "tournament_statistics": statistics}
    dictionary = store.report("data_dictionary", data_dictionary({name: described(table, cleaning.COLUMN_TEXTS) for name, table in tables.items()}))
    return {"data_dictionary": dictionary, "team_rankings": power, "team_rankings_dashboard": dashboard, "dashboard_metadata": metadata, "championship_probabilities": enriched, "historical_match_summary": summary, "tournament_statistics": statistics, "executive_summary": executive}
