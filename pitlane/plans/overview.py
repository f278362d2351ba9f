"""Reports on the latest standings: ranks, movement, finances."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import movement_label
from pitlane.operators.ranking import competition_rank, competition_ranks
from pitlane.plans.views import latest_race_rows, rows_of_last_races


def latest_race_rank(
    mart: DataFrame, races: DataFrame, loaded: DataFrame | None = None,
) -> DataFrame:
    """Rank of each team by the points of its season's latest race."""
    rows = mart.select(*V.TEAM_RACE_KEY, "team_name", "race_points")
    return competition_rank(
        latest_race_rows(rows, races, loaded), ["season"], "race_points", "league_race_rank"
    ).select("season", "race_number", "user_guid", "team_no", "team_name", "race_points",
             "league_race_rank")


def rank_movement(
    mart: DataFrame, races: DataFrame, loaded: DataFrame | None = None,
) -> DataFrame:
    """Season and race ranks at the latest race against the league's previous race.

    Both races are ranked in full, then each team's two rows meet in one aggregate by team. A
    team that was absent from the previous race has no movement.
    """
    rows = rows_of_last_races(
        mart.select(*V.TEAM_RACE_KEY, "team_name", "cumulative_points", "race_points"), races, 2,
        loaded,
    )
    ranked = competition_ranks(
        rows, V.RACE_KEY,
        {"cumulative_points": "league_rank", "race_points": "league_race_rank"},
    )

    def at(recency, column):
        return F.max(F.when(F.col("recency") == recency, F.col(column)))

    moved = ranked.groupBy(*V.TEAM_KEY).agg(
        at(1, "race_number").alias("race_number"), at(1, "team_name").alias("team_name"),
        at(1, "league_rank").alias("league_rank"),
        at(1, "league_race_rank").alias("league_race_rank"),
        (at(2, "league_rank") - at(1, "league_rank")).alias("season_rank_change"),
        (at(2, "league_race_rank") - at(1, "league_race_rank")).alias("race_rank_change"),
    ).filter("race_number IS NOT NULL")
    return moved.select(
        *V.TEAM_RACE_KEY, "team_name", "league_rank", "league_race_rank", "season_rank_change",
        "race_rank_change", movement_label("season_rank_change").alias("season_label"),
        movement_label("race_rank_change").alias("race_label"),
    )


FINANCES = ["asset_value", "remaining_budget", "total_wealth"]


def finance_components(teams: DataFrame, selected_team: str | None = None) -> DataFrame:
    """Asset value and cash of each fully valued team as rows, with the segment each belongs to."""
    segment = (
        F.when(F.col("component") == "remaining_budget", "Cash")
        .when(F.col("team_name") == F.lit(selected_team), "Selected team's assets")
        .otherwise("Assets")
    )
    return (
        teams.dropna(subset=FINANCES)
        .unpivot([*V.TEAM_KEY, "team_name", "total_wealth", "wealth_change"],
                 ["asset_value", "remaining_budget"], "component", "value")
        .withColumn("segment", segment)
        .orderBy("total_wealth", *V.TEAM_KEY, "component")
    )


def standings_table(teams: DataFrame) -> DataFrame:
    """Season standings under their display names."""
    return teams.orderBy("season", "league_rank", "user_guid", "team_no").select(
        F.col("season").alias("Season"), F.col("league_rank").alias("Rank"),
        F.col("team_name").alias("Team"), F.col("cumulative_points").alias("Season points"),
        F.col("total_wealth").alias("Total value ($m)"),
        F.col("asset_value").alias("Asset value ($m)"),
        F.col("remaining_budget").alias("Cash ($m)"),
    )
