"""The parameterised queries, without filters and with them."""

from pyspark.sql import functions as F

from checks.registry import registered
from pitlane.functions.columns import as_json, contains_fold
from pitlane.plans import names, views

ASSETS = """SELECT season, asset_id, asset_type, display_name, points_race_number,
    price_feed_race_number, race_causing_change, current_value, previous_value,
    latest_value_change, overall_points, gameday_points, selected_percentage
    FROM mart_assets_latest"""


@registered(ASSETS)
def assets_latest(league):
    return views.assets_latest(league.mart_assets_latest)


@registered(ASSETS + " WHERE asset_type = 'DRIVER' AND lower(display_name) LIKE '%set 1%'")
def assets_latest_filtered(league):
    return views.assets_latest(league.mart_assets_latest, "driver", "SET 1")


@registered("""SELECT * FROM mart_asset_value_changes
    ORDER BY value_change DESC NULLS LAST, season, race_number, asset_id LIMIT 20""")
def asset_value_changes_topk(league):
    return views.asset_value_changes(league.mart_asset_value_changes)


@registered("""SELECT season, team_snapshot_race_number, price_feed_race_number,
    points_race_number, team_name, asset_id, asset_type, display_name, current_value,
    latest_value_change, overall_points, latest_completed_race_points
    FROM mart_team_assets_latest""")
def teams_assets_latest(league):
    return views.teams_assets_latest(league.mart_team_assets_latest)


BY_RACE = """SELECT season, race_number, m.race_name, CAST(race_date AS VARCHAR) AS race_date,
    sprint_weekend, user_guid, team_no, team_name, race_points, race_rank, cumulative_points,
    league_average_race_points, league_average_cumulative_points, asset_value, remaining_budget,
    total_wealth, wealth_change, league_average_total_wealth, valuation_source
    FROM mart_team_race m LEFT JOIN races r USING (season, race_number)"""


def _dates_as_text(df):
    return df.withColumn("race_date", F.col("race_date").cast("string"))


@registered(BY_RACE)
def teams_by_race(league):
    return _dates_as_text(views.teams_by_race(league.mart_team_race, league.races))


@registered(BY_RACE + " WHERE lower(team_name) LIKE '%m 1%'")
def teams_by_race_filtered(league):
    return _dates_as_text(views.teams_by_race(
        league.mart_team_race, league.races, team_name="M 1"
    ))


@registered("SELECT * FROM mart_team_race WHERE user_guid IN ('1', '7', '10', 'none')")
def rows_of_users(league):
    return views.of_users(league.mart_team_race, ["1", "7", "10", "none"])


LATEST = """SELECT season, race_number, race_name, user_guid, team_no, team_name, race_points,
    race_rank, cumulative_points, league_rank, asset_value, remaining_budget, total_wealth,
    wealth_change, valuation_source FROM standings"""
STANDINGS = """SELECT m.*, rank() OVER (PARTITION BY season ORDER BY cumulative_points DESC)
        AS league_rank,
        rank() OVER (PARTITION BY season ORDER BY race_points DESC) AS league_race_rank
    FROM mart_team_race m WHERE race_number =
        (SELECT MAX(race_number) FROM mart_team_race x WHERE x.season = m.season)"""


@registered(LATEST, standings=STANDINGS)
def teams_latest(league):
    return views.teams_latest(
        league.mart_team_race, league.races, loaded=league.loaded_races)


@registered(LATEST + " WHERE lower(team_name) LIKE '%7%'", standings=STANDINGS)
def teams_latest_filtered(league):
    return views.teams_latest(
        league.mart_team_race, league.races, team_name="7", loaded=league.loaded_races)


@registered("SELECT * FROM mart_team_chips")
def team_chips(league):
    return views.team_chips(league.mart_team_chips)


@registered("SELECT * FROM mart_team_chips WHERE chip_status = 'used'")
def team_chips_filtered(league):
    return views.team_chips(league.mart_team_chips, chip_status="USED")


@registered("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%e_w%'", views=False)
def name_contains(league):
    return league.table("part").filter(contains_fold("p_name", "E_W")).select(
        "p_partkey", "p_name"
    )


FIRST_NAMES = """SELECT season, user_guid, team_no, team_name, MIN(race_number) AS race_number
    FROM team_race GROUP BY season, user_guid, team_no, team_name"""


@registered("""SELECT DISTINCT season, race_number, user_guid, team_no, team_name,
        lower(unnest(list_append([team_name[i:i + 2] FOR i IN range(1, length(team_name) - 1)], '')))
        AS run FROM first_names""", first_names=FIRST_NAMES)
def team_name_index(league):
    return league.team_names


@registered("SELECT * FROM first_names WHERE lower(team_name) LIKE '%eam%1_%'",
            first_names=FIRST_NAMES)
def team_names_containing(league):
    return names.containing(league.team_names, "EAM%1_")


@registered(BY_RACE + " WHERE lower(team_name) LIKE '%eam 14%'")
def teams_by_race_by_index(league):
    return _dates_as_text(views.teams_by_race(
        league.mart_team_race, league.races, team_name="EAM 14", index=league.team_names))


# The columns of a record, in order.
_JSON = ["season", "asset_id", "asset_type", "display_name", "points_race_number",
         "price_feed_race_number", "race_causing_change", "current_value", "previous_value",
         "latest_value_change", "overall_points", "gameday_points", "selected_percentage"]


@registered("SELECT season, asset_id, CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in _JSON)
            + "}) AS VARCHAR) AS record FROM mart_assets_latest")
def records_as_json(league):
    mart = views.assets_latest(league.mart_assets_latest)
    return mart.select("season", "asset_id", as_json(mart.columns).alias("record"))
