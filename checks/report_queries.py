"""The reports: standings, histories, chips."""

from checks.registry import registered
from checks.view_queries import STANDINGS
from pitlane import fixed_values as V
from pitlane.plans import chips, evolution, overview, views

RACES = list(range(1, 13))
CHIPS = list(V.CHIP_FIELDS)


@registered("""SELECT season, race_number, user_guid, team_no, team_name, race_points,
    league_race_rank FROM standings""", standings=STANDINGS)
def latest_race_rank(league):
    return overview.latest_race_rank(league.mart_team_race, league.races, league.loaded_races)


LABEL = """CASE WHEN {c} <> 0 THEN concat(CASE WHEN {c} > 0 THEN '+' ELSE '' END,
    CAST({c} AS VARCHAR), CASE WHEN abs({c}) = 1 THEN ' place' ELSE ' places' END) END"""


@registered(f"""
    SELECT *, {LABEL.format(c='season_rank_change')} AS season_label,
           {LABEL.format(c='race_rank_change')} AS race_label
    FROM (SELECT s.season, s.race_number, s.user_guid, s.team_no, s.team_name, s.league_rank,
                 s.league_race_rank, p.league_rank - s.league_rank AS season_rank_change,
                 p.league_race_rank - s.league_race_rank AS race_rank_change
          FROM standings s LEFT JOIN previous p USING (season, user_guid, team_no))""",
    standings=STANDINGS, previous="""
    SELECT m.season, user_guid, team_no,
           rank() OVER (PARTITION BY season ORDER BY cumulative_points DESC) AS league_rank,
           rank() OVER (PARTITION BY season ORDER BY race_points DESC) AS league_race_rank
    FROM mart_team_race m WHERE race_number =
        (SELECT MAX(race_number) FROM mart_team_race x WHERE x.season = m.season
         AND x.race_number < (SELECT MAX(race_number) FROM mart_team_race y
                              WHERE y.season = m.season))""")
def rank_movement(league):
    return overview.rank_movement(league.mart_team_race, league.races, league.loaded_races)


FULL = "asset_value IS NOT NULL AND remaining_budget IS NOT NULL AND total_wealth IS NOT NULL"


@registered(f"""
    SELECT season, user_guid, team_no, team_name, total_wealth, wealth_change,
           'asset_value' AS component, asset_value AS value,
           CASE WHEN team_name = 'Team 7' THEN 'Selected team''s assets' ELSE 'Assets' END
               AS segment
    FROM standings WHERE {FULL}
    UNION ALL
    SELECT season, user_guid, team_no, team_name, total_wealth, wealth_change,
           'remaining_budget', remaining_budget, 'Cash' FROM standings WHERE {FULL}""",
    standings=STANDINGS)
def finance_components(league):
    teams = views.standings(league.mart_team_race, league.races, league.loaded_races)
    return overview.finance_components(teams, "Team 7")


@registered("""SELECT season AS "Season", league_rank AS "Rank", team_name AS "Team",
    cumulative_points AS "Season points", total_wealth AS "Total value ($m)",
    asset_value AS "Asset value ($m)", remaining_budget AS "Cash ($m)" FROM standings""",
    standings=STANDINGS)
def standings_table(league):
    return overview.standings_table(views.standings(league.mart_team_race, league.races, league.loaded_races))


DIRECTORY = """
    SELECT season, concat(user_guid, '_', CAST(team_no AS VARCHAR)) AS team_key, user_guid,
           team_no, team_name, race_number, cumulative_points,
           race_number = (SELECT MAX(race_number) FROM mart_team_race x WHERE x.season = m.season)
               AS in_latest_snapshot
    FROM mart_team_race m
    QUALIFY row_number() OVER (PARTITION BY season, user_guid, team_no
                               ORDER BY race_number DESC) = 1"""


@registered("SELECT * FROM directory", directory=DIRECTORY)
def team_directory(league):
    return evolution.team_directory(league.mart_team_race, league.races)


@registered("""
    SELECT m.season, m.race_number, m.user_guid, m.team_no, m.cumulative_points, m.total_wealth,
           m.asset_value, m.remaining_budget, d.team_key, d.team_name AS chart_team_name
    FROM mart_team_race m JOIN directory d USING (season, user_guid, team_no)
    WHERE d.in_latest_snapshot""", directory=DIRECTORY)
def team_history_selected(league):
    directory = evolution.team_directory(league.mart_team_race, league.races)
    return evolution.team_history(
        league.mart_team_race, directory, directory.filter("in_latest_snapshot")
    )


@registered("\n    UNION ALL ".join(
    f"""SELECT season, race_number, concat(user_guid, '_', CAST(team_no AS VARCHAR)) AS team_key,
    '{m}' AS metric, {m} AS value FROM mart_team_race""" for m in evolution.METRICS))
def team_metric_series(league):
    return evolution.metric_series(league.mart_team_race)


@registered("""SELECT DISTINCT season, race_number, league_average_cumulative_points,
    league_average_total_wealth FROM mart_team_race""")
def league_average_series(league):
    return evolution.league_average_series(league.mart_team_race)


@registered("SELECT DISTINCT season, race_number, race_name FROM mart_team_race")
def race_directory(league):
    return evolution.race_directory(league.mart_team_race)


@registered("""
    SELECT season, race_number, concat(user_guid, '_', CAST(team_no AS VARCHAR)) AS team_key,
           team_name, race_points, wealth_change, total_wealth,
           CASE WHEN wealth_change > 0 THEN 'positive' WHEN wealth_change < 0 THEN 'negative'
                WHEN wealth_change = 0 THEN 'zero' ELSE 'missing' END AS change_sign
    FROM mart_team_race""")
def race_performance(league):
    return evolution.race_performance(league.mart_team_race)


ORDER = """
    SELECT c.*, s.league_rank,
           row_number() OVER (PARTITION BY c.season ORDER BY s.league_rank NULLS LAST,
                              c.team_name, c.user_guid, c.team_no) - 1 AS display_order
    FROM (SELECT DISTINCT season, user_guid, team_no, team_name FROM mart_team_chips) c
    LEFT JOIN standings s USING (season, user_guid, team_no)"""


def _order(league):
    ranked = views.standings(league.mart_team_race, league.races, league.loaded_races)
    return chips.team_order(league.mart_team_chips, ranked)


@registered("SELECT season, user_guid, team_no, team_name, league_rank, display_order FROM ord",
            standings=STANDINGS, ord=ORDER)
def chip_team_order(league):
    return _order(league)


@registered("""
    SELECT season, user_guid, team_no, team_name,
           row_number() OVER (PARTITION BY season ORDER BY team_name, user_guid, team_no) - 1
               AS display_order
    FROM (SELECT DISTINCT season, user_guid, team_no, team_name FROM mart_team_chips)""")
def chip_team_order_by_name(league):
    return chips.team_order(league.mart_team_chips)


CELL = """CASE WHEN chip_status = 'unused' THEN '✕'
    WHEN race_used_short_name IS NULL
        THEN CASE WHEN chip_status = 'upcoming' THEN 'Upcoming' ELSE 'Used' END
    WHEN chip_status = 'upcoming' THEN concat('Upcoming · ', race_used_short_name)
    ELSE race_used_short_name END"""


@registered(
    "SELECT c.season, c.user_guid, c.team_no, c.team_name, c.last_observed_race, "
    + ", ".join(f"MAX(CASE WHEN chip_id = {k} THEN {CELL} END) AS chip_{k}" for k in CHIPS)
    + ", MAX(o.display_order) AS display_order FROM mart_team_chips c "
      "LEFT JOIN ord o USING (season, user_guid, team_no) "
      "GROUP BY c.season, c.user_guid, c.team_no, c.team_name, c.last_observed_race",
    standings=STANDINGS, ord=ORDER)
def chip_matrix(league):
    return chips.chip_matrix(league.mart_team_chips, _order(league), CHIPS)


TIMING = "SELECT season, user_guid, team_no, team_name, " + ", ".join(
    f"""COALESCE(string_agg(chip_short_name, ' / ' ORDER BY chip_id)
    FILTER (WHERE chip_status = 'used' AND race_used = {r}), '') AS r{r}""" for r in RACES
) + " FROM mart_team_chips GROUP BY 1, 2, 3, 4"


@registered(TIMING)
def chip_timing_matrix(league):
    return chips.chip_timing_matrix(league.mart_team_chips, RACES)


@registered(TIMING)
def chip_timing_without_blanks(league):
    """Two races more, in which no chip was used: their columns go, the months stay."""
    matrix = chips.chip_timing_matrix(league.mart_team_chips, [*RACES, 13, 14])
    return chips.without_blank_columns(matrix, [*chips.TEAM, *[f"r{n}" for n in RACES]])


@registered("SELECT MAX(last_observed_race) AS latest_race FROM mart_team_chips")
def chip_latest_race(league):
    return chips.latest_observed_race(league.mart_team_chips)


@registered("""SELECT season, race_used, COUNT(*) AS chips_used FROM mart_team_chips
    WHERE chip_status = 'used' GROUP BY 1, 2""")
def races_with_chip_use(league):
    return chips.races_with_chip_use(league.mart_team_chips)


@registered("""
    SELECT season, user_guid, team_no, team_name,
           chip_race_points - league_average_race_points AS points_vs_average, chip_id, chip_name,
           race_used_short_name, chip_race_points, league_average_race_points
    FROM mart_team_chips WHERE chip_status = 'used' AND chip_race_points IS NOT NULL
      AND league_average_race_points IS NOT NULL""")
def chip_performance(league):
    return chips.chip_performance(league.mart_team_chips)
