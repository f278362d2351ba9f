"""The marts and the steps they are made of."""

from checks.registry import registered
from checks.star_league import AS_OF
from pitlane.plans import marts


def _untimed(df):
    """Without the two retrieval times, which the star-schema league does not have."""
    return df.drop("retrieved_at_utc", "feed_time_utc")


@registered("SELECT * FROM mart_asset_value_changes")
def mart_asset_value_changes_by_race(league):
    return _untimed(marts.asset_value_changes(league.asset_race))


@registered("SELECT * FROM completed")
def latest_completed_race(league):
    return marts.latest_completed_race(league.races, AS_OF)


@registered("SELECT season, MAX(race_number) AS race_number FROM asset_race GROUP BY season")
def latest_price_feed(league):
    return marts.latest_price_feed(league.asset_race)


@registered("SELECT * FROM mart_assets_latest")
def mart_assets_latest(league):
    return _untimed(marts.assets_latest(league.asset_race, league.races, AS_OF))


@registered("SELECT * FROM mart_team_assets_latest")
def mart_team_assets_latest(league):
    return league.build_team_assets_latest()


@registered("SELECT * FROM roster_values")
def roster_values(league):
    return marts.roster_values(
        league.team_race_asset, league.asset_race, league.team_chip_usage
    )


@registered("SELECT * FROM mart_team_race")
def mart_team_race(league):
    return league.build_team_race_mart()


@registered("""
    SELECT season, race_number, user_guid, team_no, race_points,
           SUM(race_points) OVER (PARTITION BY season, user_guid, team_no ORDER BY race_number
                                  ROWS UNBOUNDED PRECEDING) AS cumulative_points
    FROM team_race""")
def cumulative_points(league):
    return marts.with_cumulative_points(league.team_race.select(
        "season", "race_number", "user_guid", "team_no", "race_points"
    ))


@registered("""
    SELECT DISTINCT season, race_number, league_average_race_points,
           league_average_cumulative_points, league_average_total_wealth
    FROM mart_team_race""")
def league_averages(league):
    values = marts.roster_values(
        league.team_race_asset, league.asset_race, league.team_chip_usage
    )
    return marts.league_averages(marts.team_metrics(league.team_race, values, league.races))


@registered("""
    SELECT season, race_number, user_guid, team_no, total_wealth, wealth_change
    FROM mart_team_race""")
def wealth_change(league):
    return marts.with_wealth_change(league.mart_team_race.select(
        "season", "race_number", "user_guid", "team_no", "total_wealth"
    ))


@registered("SELECT * FROM mart_team_chips")
def mart_team_chips(league):
    return league.build_team_chips()
