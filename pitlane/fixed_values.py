"""Names and codes that have to equal those of the feeds and of the published tables.

Everything in this module is a fixed value, not logic: field names, table keys, codes.
"""

# Asset feed field -> prepared column.
ASSET_COLUMNS = {
    "PlayerId": "asset_id",
    "Skill": "skill",
    "PositionName": "asset_type",
    "Value": "value",
    "TeamId": "team_id",
    "FUllName": "full_name",
    "DisplayName": "display_name",
    "IsActive": "is_active",
    "DriverTLA": "driver_tla",
    "OverallPpints": "overall_points",
    "GamedayPoints": "gameday_points",
    "SelectedPercentage": "selected_percentage",
    "CaptainSelectedPercentage": "captain_selected_percentage",
    "OldPlayerValue": "old_asset_value",
    "BestRaceFinished": "best_race_finished",
    "HigestGridStart": "highest_grid_start",
    "HigestChampFinish": "highest_champ_finish",
    "FastestPitstopAward": "fastest_pitstop_award",
    "BestRaceFinishCount": "best_race_finish_count",
    "HighestGridStartCount": "highest_grid_start_count",
    "HighestChampFinishCount": "highest_champ_finish_count",
    "FastestPitstopAwardCount": "fastest_pitstop_award_count",
    "QualifyingPoints": "qualifying_points",
    "RacePoints": "race_points",
    "SprintPoints": "sprint_points",
    "NoNegativePoints": "no_negative_points",
    "F1PlayerId": "driver_team_id",
    "FirstName": "driver_team_first_name",
    "LastName": "driver_team_last_name",
    "SessionWisePoints": "all_session_points",
    "old_Value": "old_value",
    "new_value": "new_value",
    "ProjectedGamedayPoints": "projected_gameday_points",
    "ProjectedNoNegativePoints": "projected_no_negative_points",
    "ProjectedOverallPpints": "projected_overall_points",
}

# Field of the nested statistics block -> prepared column.
ASSET_STATISTICS = {
    "fastest_lap_pts": "fastest_lap_points",
    "dotd_pts": "dotd_points",
    "overtaking_pts": "overtake_points",
    "q3_finishes_pts": "q3_finishes_points",
    "top10_race_position_pts": "top10_race_position_points",
    "top8_sprint_position_pts": "top8_sprint_position_points",
    "total_position_pts": "total_position_points",
    "total_position_gained_lost": "total_positions_gained_lost_points",
    "total_dnf_dq_pts": "total_dnf_dq_points",
    "value_for_money": "value_for_money",
}

# Prepared asset columns that are dropped, and those held as whole numbers.
# Every other numeric asset column is a double; the text columns are listed last.
ASSET_DROPPED = ["old_value", "new_value"]
ASSET_INTEGERS = [
    "asset_id", "skill", "team_id", "is_active", "gameday_points", "best_race_finish_count",
    "highest_grid_start_count", "highest_champ_finish_count", "fastest_pitstop_award_count",
    "driver_team_id",
]
ASSET_TEXTS = [
    "asset_type", "full_name", "display_name", "driver_tla", "driver_team_first_name",
    "driver_team_last_name", "all_session_points",
]

# Leaderboard field -> prepared column, and the personal fields removed on landing.
STANDINGS_COLUMNS = {"cur_rank": "race_rank", "cur_points": "race_points"}
STANDINGS_PERSONAL = "user_name"
TEAM_DETAIL_PERSONAL = "socialId"

# Chip id -> (flag field, race field); a chip is used when its flag equals its id.
CHIP_FIELDS = {
    1: ("islimitlesstaken", "limitlesstakengd"),
    2: ("iswildcardtaken", "wildcardtakengd"),
    3: ("isfinalfixtaken", "finalfixtakengd"),
    4: ("isautopilottaken", "autopilottakengd"),
    5: ("isnonigativetaken", "nonigativetakengd"),
    6: ("isextradrstaken", "extradrstakengd"),
}
LIMITLESS = 1

# Swap codes of a roster row.
UNAFFECTED, INCOMING, OUTGOING = 0, 1, 2

ROSTER_SIZE = 7
DEFAULT_LIMIT = 20
FEED_TIME_FORMAT = "M/d/yyyy h:mm:ss a"

# Team detail field -> prepared column.
FINANCE_COLUMNS = {
    "teamval": "recorded_asset_value",
    "teambal": "remaining_budget",
    "maxteambal": "recorded_total_budget",
    "usersubs": "transfers_made",
    "usersubsleft": "free_transfers_remaining",
}
LINEUP_COLUMNS = {
    "id": "asset_id",
    "iscaptain": "is_captain",
    "ismgcaptain": "is_mg_captain",
    "playerpostion": "player_position",
    "isfinal": "is_final",
}

# Table keys, required measures, optional measures and relationships.
TEAM_KEY = ["season", "user_guid", "team_no"]
RACE_KEY = ["season", "race_number"]
TEAM_RACE_KEY = ["season", "race_number", "user_guid", "team_no"]
LOOKED_UP = ["run", "user_guid"]
KEYS = {
    "asset_race": ["season", "race_number", "asset_id"],
    "team_race": TEAM_RACE_KEY,
    "team_race_asset": [*TEAM_RACE_KEY, "asset_id"],
    "team_chip_usage": ["season", "user_guid", "team_no", "chip_id"],
    "races": RACE_KEY,
    "chips": ["chip_id"],
}
REQUIRED = {
    "asset_race": ["asset_type", "value", "gameday_points"],
    "team_race": [
        "race_points", "race_rank", "remaining_budget", "transfers_made",
        "free_transfers_remaining",
    ],
    "team_race_asset": ["is_captain", "is_mg_captain", "player_position", "is_final"],
    "team_chip_usage": ["race_used"],
}
OPTIONAL = {"team_race": ["recorded_asset_value", "recorded_total_budget"]}
MAY_BE_EMPTY = ["team_chip_usage"]
RELATIONSHIPS = [
    ("team_race_asset", "team_race", {k: k for k in TEAM_RACE_KEY}),
    ("team_race_asset", "asset_race", {k: k for k in KEYS["asset_race"]}),
    ("team_race", "races", {k: k for k in RACE_KEY}),
    ("asset_race", "races", {k: k for k in RACE_KEY}),
    ("team_chip_usage", "chips", {"chip_id": "chip_id"}),
    ("team_chip_usage", "races", {"season": "season", "race_used": "race_number"}),
    ("team_chip_usage", "team_race", {k: k for k in TEAM_KEY}),
]

# Marts that earlier releases created and that a rebuild removes.
RETIRED_MARTS = [
    "mart_team_season_summary", "mart_team_values_by_race", "mart_team_values_latest",
]

# Display texts of the reports.
UNUSED_MARK = "✕"
PLACE_SEPARATOR = " · "
CHIP_SEPARATOR = " / "
