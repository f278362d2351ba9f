"""Reports on team histories over a season. `history` is the by-race view or the team-race mart."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import change_sign
from pitlane.operators.joins import attach_small
from pitlane.operators.ranking import latest_per_key

METRICS = ["cumulative_points", "total_wealth", "asset_value", "remaining_budget"]


def team_key() -> Column:
    return F.concat_ws("_", "user_guid", F.col("team_no").cast("string")).alias("team_key")


def team_directory(history: DataFrame, races: DataFrame) -> DataFrame:
    """Each team's last row; teams of the latest race first, then by points and name."""
    last = latest_per_key(
        history.select("season", "user_guid", "team_no", "team_name", "race_number",
                       "cumulative_points"),
        V.TEAM_KEY, "race_number",
    )
    latest = history.groupBy("season").agg(F.max("race_number").alias("__latest"))
    return attach_small(last, latest, ["season"], proof=races).select(
        "season", team_key(), "user_guid", "team_no", "team_name", "race_number",
        "cumulative_points",
        (F.col("race_number") == F.col("__latest")).alias("in_latest_snapshot"),
    ).orderBy("season", F.desc("in_latest_snapshot"), F.desc_nulls_last("cumulative_points"),
              "team_name", "team_key")


def team_history(history: DataFrame, directory: DataFrame, selected: DataFrame) -> DataFrame:
    """Histories of the selected teams (season, team_key) under each team's latest name."""
    names = directory.join(selected.select("season", "team_key"), ["season", "team_key"],
                           "left_semi").select(*V.TEAM_KEY, "team_key",
                                               F.col("team_name").alias("chart_team_name"))
    return history.select(*V.TEAM_RACE_KEY, *METRICS).join(names, V.TEAM_KEY).orderBy(
        "season", "team_key", "race_number"
    )


def metric_series(history: DataFrame) -> DataFrame:
    """The four measures as one long series."""
    return history.select("season", "race_number", team_key(), *METRICS).unpivot(
        ["season", "race_number", "team_key"], METRICS, "metric", "value"
    )


def league_average_series(history: DataFrame) -> DataFrame:
    """The league averages, once per race."""
    return history.groupBy(*V.RACE_KEY).agg(
        F.max("league_average_cumulative_points").alias("league_average_cumulative_points"),
        F.max("league_average_total_wealth").alias("league_average_total_wealth"),
    ).orderBy(*V.RACE_KEY)


def race_directory(history: DataFrame) -> DataFrame:
    return history.select(*V.RACE_KEY, "race_name").distinct().orderBy(*V.RACE_KEY)


def race_performance(history: DataFrame, race_number: int | None = None) -> DataFrame:
    """Points and change of value of every team, race by race; nulls last."""
    rows = history if race_number is None else history.filter(F.col("race_number") == race_number)
    return rows.select(
        *V.RACE_KEY, team_key(), "team_name", "race_points", "wealth_change", "total_wealth",
        change_sign("wealth_change").alias("change_sign"),
    ).orderBy(*V.RACE_KEY, F.desc_nulls_last("race_points"), F.desc_nulls_last("wealth_change"),
              "team_key")
