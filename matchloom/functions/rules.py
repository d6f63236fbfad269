"""Ordered text rules: the first matching rule decides."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches when any token of ``any_of`` occurs, all of ``all_of`` occur and none of ``none_of`` does."""

    value: object
    any_of: tuple[str, ...] = ()
    all_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()

    def condition(self, text: Column) -> Column:
        either = [text.contains(t) for t in self.any_of]
        if self.equals:
            either.append(text.isin(*self.equals))
        parts = [reduce(lambda a, b: a | b, either)] if either else []
        parts += [text.contains(t) for t in self.all_of]
        parts += [~text.contains(t) for t in self.none_of]
        return reduce(lambda a, b: a & b, parts)


def first_match(text: Column, rules: tuple[Rule, ...], default) -> Column:
    """Value of the first rule that matches, else ``default`` (also for null text)."""
    first, *rest = rules
    expr = F.when(first.condition(text), F.lit(first.value))
    for rule in rest:
        expr = expr.when(rule.condition(text), F.lit(rule.value))
    return expr.otherwise(F.lit(default))


# Rating weight by competition name (lower case), in order of precedence.
WEIGHT_RULES = (
    Rule(60, any_of=("fifa world cup",), none_of=("qualification", "qualifier")),
    Rule(
        40,
        any_of=(
            "uefa euro",
            "copa america",
            "copa américa",
            "afc asian cup",
            "africa cup of nations",
            "concacaf gold cup",
            "ofc nations cup",
            "cafu nations cup",
        ),
    ),
    Rule(30, any_of=("qualification", "qualifier", "qualifying")),
    Rule(20, any_of=("friendly",)),
)
DEFAULT_WEIGHT = 30

# Stage categories. Case matters, and so does the order.
STAGE_RULES = (
    Rule("Group Stage", any_of=("Group",), equals=("Preliminary round", "First round")),
    Rule("Final", any_of=("Final",)),
    Rule("Third Place", any_of=("Third place", "Play-off")),
    Rule("Knockout Stage", any_of=("Round of", "Quarter", "Semi", "Knockout")),
)

# Reporting group of a model feature (lower case name).
FEATURE_GROUP_RULES = (
    Rule("ELO", any_of=("elo",)),
    Rule("FIFA", any_of=("fifa",)),
    Rule("Goals", any_of=("goal",)),
    Rule("Win Gap", all_of=("win", "diff")),
    Rule("Win Rate", any_of=("win",)),
    Rule("Form", any_of=("form",)),
    Rule("Player Strength", any_of=("player",)),
    Rule("Match Context", any_of=("neutral",)),
)

# What each model feature means.
FEATURE_DESCRIPTIONS = {
    "neutral_match_flag": "Indicates matches played at neutral venues.",
    "elo_diff": "Difference between home and away ELO ratings.",
    "win_percentage_diff": "Difference in win percentage between teams.",
    "goals_conceded_diff": "Difference in goals conceded averages.",
    "ranking_diff": "Difference in FIFA ranking positions.",
    "away_elo": "Away team ELO rating.",
    "player_strength_diff": "Difference in average player strength.",
    "goals_scored_diff": "Difference in goals scored averages.",
    "home_avg_goals_conceded": "Home team average goals conceded.",
    "home_elo": "Home team ELO rating.",
    "away_avg_goals_conceded": "Away team average goals conceded.",
    "away_avg_goals_scored": "Away team average goals scored.",
    "away_win_percentage": "Away team win percentage.",
    "home_win_percentage": "Home team win percentage.",
    "home_avg_goals_scored": "Home team average goals scored.",
    "away_player_strength": "Away team player strength.",
    "home_player_strength": "Home team player strength.",
    "away_fifa_rank": "Away team FIFA ranking.",
    "home_fifa_rank": "Home team FIFA ranking.",
    "form_diff": "Difference in recent form between home and away teams.",
    "home_form": "Home team recent form score.",
    "away_form": "Away team recent form score.",
}
DEFAULT_DESCRIPTION = "Feature importance contribution used by the match outcome model."

# Competitions of the category report.
REPORTED_COMPETITIONS = ("FIFA World Cup", "UEFA Euro", "Copa América", "Africa Cup of Nations", "AFC Asian Cup")

# Probability tiers, lower bound in percent.
TIERS = ((15.0, "Top Favourite"), (8.0, "Contender"), (3.0, "Dark Horse"))
LOWEST_TIER = "Underdog"


def rating_weight(competition: Column) -> Column:
    return first_match(F.lower(competition), WEIGHT_RULES, DEFAULT_WEIGHT)


def stage_category(stage: Column) -> Column:
    return F.when(stage.isNull(), "Unknown").otherwise(first_match(F.trim(stage), STAGE_RULES, "Other"))


def feature_group(feature: Column) -> Column:
    return first_match(F.lower(feature), FEATURE_GROUP_RULES, "Other")


def tier(percent: Column) -> Column:
    (bound, name), *rest = TIERS
    expr = F.when(percent >= bound, name)
    for bound, name in rest:
        expr = expr.when(percent >= bound, name)
    return expr.otherwise(LOWEST_TIER)


def feature_description(feature: Column) -> Column:
    texts = F.create_map(*[F.lit(x) for pair in FEATURE_DESCRIPTIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(texts, feature), F.lit(DEFAULT_DESCRIPTION))
