"""Parameterised queries over the marts.

Text filters are skipped when empty, numeric ones when None. Given the index of names (`plans.names`)
of the same build, a filter on a team's name reads the rows of the users that it finds there. Every order is total: the published
order comes first, then keys that settle ties, with nulls where they are stated.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import all_of, any_of, contains_fold
from pitlane.operators.joins import attach_small
from pitlane.operators.ranking import competition_rank
from pitlane.plans import names


def _kept(df: DataFrame, *conditions) -> DataFrame:
    wanted = [c for c in conditions if c is not None]
    return df.filter(all_of(wanted)) if wanted else df


def _equals(column: str, value):
    return None if value is None else F.col(column) == value


def _folded(column: str, value, fold):
    return F.col(column) == fold(value) if value else None


def _contains(column: str, text):
    return contains_fold(column, text) if text else None


def _teams_named(rows: DataFrame, text, index: DataFrame | None, season=None) -> DataFrame:
    """Rows of teams whose name contains a text, through the index of names if there is one."""
    if not text or index is None:
        return _kept(rows, _contains("team_name", text))
    return names.named(rows, index, text, season)


def assets_latest(
    mart: DataFrame, asset_type: str | None = None, display_name: str | None = None,
) -> DataFrame:
    return _kept(
        mart, _folded("asset_type", asset_type, str.upper),
        _contains("display_name", display_name),
    ).select(
        "season", "asset_id", "asset_type", "display_name", "points_race_number",
        "price_feed_race_number", "race_causing_change", "current_value", "previous_value",
        "latest_value_change", "overall_points", "gameday_points", "selected_percentage",
    ).orderBy("asset_type", F.desc_nulls_last("current_value"), "season", "asset_id")


def asset_value_changes(
    mart: DataFrame, asset_type: str | None = None, display_name: str | None = None,
    race_number: int | None = None, limit: int = V.DEFAULT_LIMIT,
) -> DataFrame:
    """The largest changes first; ties at the cut are settled by the asset's key."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    return _kept(
        mart, _folded("asset_type", asset_type, str.upper),
        _contains("display_name", display_name), _equals("race_number", race_number),
    ).select(
        "season", "race_number", "asset_id", "asset_type", "display_name", "value",
        "old_asset_value", "value_change", "gameday_points", "overall_points",
        "selected_percentage",
    ).orderBy(
        F.desc_nulls_last("value_change"), "season", "race_number", "asset_id"
    ).limit(limit)


def teams_assets_latest(mart: DataFrame, team_name: str | None = None) -> DataFrame:
    return _kept(mart, _contains("team_name", team_name)).select(
        "season", "team_snapshot_race_number", "price_feed_race_number", "points_race_number",
        "team_name", "asset_id", "asset_type", "display_name", "current_value",
        "latest_value_change", "overall_points", "latest_completed_race_points",
    ).orderBy(
        "team_name", "asset_type", F.desc_nulls_last("current_value"), "season", "asset_id"
    )


def teams_by_race(
    mart: DataFrame, races: DataFrame, season: int | None = None,
    race_number: int | None = None, team_name: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    rows = _teams_named(
        _kept(mart, _equals("season", season), _equals("race_number", race_number)), team_name,
        index, season)
    days = races.select(*V.RACE_KEY, "race_date", "sprint_weekend")
    return attach_small(rows, days, V.RACE_KEY, "left", proof=races).select(
        "season", "race_number", "race_name", "race_date", "sprint_weekend", "user_guid",
        "team_no", "team_name", "race_points", "race_rank", "cumulative_points",
        "league_average_race_points", "league_average_cumulative_points", "asset_value",
        "remaining_budget", "total_wealth", "wealth_change", "league_average_total_wealth",
        "valuation_source",
    ).orderBy(
        "season", "race_number", F.desc_nulls_last("cumulative_points"), "user_guid", "team_no"
    )


def of_users(rows: DataFrame, user_guids: list[str]) -> DataFrame:
    """All rows of some users, from a table that is laid out by race.

    The list reaches the files as a filter. Published files are sorted by user and carry bloom filters
    (`write_parts`), so what is read follows the number of users and not that of rows.
    """
    return rows.filter(F.col("user_guid").isin(list(user_guids)))


def loaded_races(mart: DataFrame) -> DataFrame:
    """The races that a table has rows of, from its partitions where it is laid out by race."""
    return mart.select(*V.RACE_KEY).distinct()


def last_races(loaded: DataFrame, count: int) -> DataFrame:
    """The last races of each season with their recency, 1 being the latest."""
    newest = Window.partitionBy("season").orderBy(F.desc("race_number"))
    return (
        loaded.select(*V.RACE_KEY).distinct()
        .withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= count)
    )


def rows_of_last_races(
    rows: DataFrame, races: DataFrame, count: int, loaded: DataFrame | None = None,
) -> DataFrame:
    """Rows of the last races of each season, with their recency.

    `loaded` is a table of the loaded races. Its last ones, a few rows per season, become part of the
    plan, so partitions, files and row groups of other races are passed over. Without it they are
    found in `rows` and broadcast, which passes over partitions if the table is laid out by race.
    """
    if loaded is None:
        return attach_small(rows, last_races(loaded_races(rows), count), V.RACE_KEY, proof=races)
    last = last_races(loaded, count).collect()
    here = [(F.col("season") == r.season) & (F.col("race_number") == r.race_number) for r in last]
    recency = F.coalesce(*[F.when(c, r.recency) for c, r in zip(here, last)], F.lit(0))
    return rows.filter(any_of(here)).withColumn("recency", recency)


def latest_race_rows(
    mart: DataFrame, races: DataFrame, loaded: DataFrame | None = None,
) -> DataFrame:
    """The rows of each season's latest loaded race."""
    return rows_of_last_races(mart, races, 1, loaded).drop("recency")


def standings(
    mart: DataFrame, races: DataFrame, loaded: DataFrame | None = None,
) -> DataFrame:
    """Teams at each season's latest race with their championship rank."""
    return competition_rank(
        latest_race_rows(mart, races, loaded), ["season"], "cumulative_points", "league_rank"
    )


# The columns of this query.
TEAMS_LATEST = [
    "season", "race_number", "race_name", "user_guid", "team_no", "team_name", "race_points",
    "race_rank", "cumulative_points", "league_rank", "asset_value", "remaining_budget",
    "total_wealth", "wealth_change", "valuation_source",
]


def teams_latest(
    mart: DataFrame, races: DataFrame, season: int | None = None, team_name: str | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Ranks are within the season, so the season is filtered before them and names after."""
    seasons = _kept(mart, _equals("season", season))
    ranked = standings(seasons.select(*[c for c in TEAMS_LATEST if c != "league_rank"]), races,
                       loaded).select(*TEAMS_LATEST)
    return _kept(ranked, _contains("team_name", team_name)).orderBy(
        "season", "league_rank", "user_guid", "team_no"
    )


def team_chips(
    mart: DataFrame, season: int | None = None, team_name: str | None = None,
    chip_id: int | None = None, chip_status: str | None = None, index: DataFrame | None = None,
) -> DataFrame:
    return _teams_named(_kept(
        mart, _equals("season", season), _equals("chip_id", chip_id),
        _folded("chip_status", chip_status, str.lower),
    ), team_name, index, season).select(
        "season", "user_guid", "team_no", "team_name", "last_observed_race", "chip_id",
        "chip_name", "chip_short_name", "available_first_race", "race_used", "race_used_name",
        "race_used_short_name", "chip_status", "chip_race_points", "league_average_race_points",
    ).orderBy("season", "team_name", "user_guid", "team_no", "chip_id")
