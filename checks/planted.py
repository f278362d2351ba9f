"""League tables with planted violations, for the quality checks.

Each text reads one whole table and is run unchanged by both engines; the rows that get a defect
are chosen by arithmetic on their keys, and no row is left out.
"""

from checks.star_league import StarLeague

PLANTED = {
    "asset_race": """
        SELECT season, CASE WHEN asset_id % 19 = 0 THEN race_number + 20 ELSE race_number END
                   AS race_number, asset_id,
               CASE WHEN (asset_id*race_number) % 31 = 0 THEN NULL ELSE asset_type END
                   AS asset_type, value,
               CASE WHEN (asset_id+race_number) % 37 = 0 THEN NULL ELSE gameday_points END
                   AS gameday_points FROM {asset_race}
        UNION ALL
        SELECT season, race_number, asset_id, asset_type, value, gameday_points
        FROM {asset_race} WHERE (asset_id + season) % 23 = 0""",
    "team_race": """
        SELECT season, CASE WHEN CAST(user_guid AS BIGINT) % 101 = 5 THEN NULL
                   ELSE race_number END AS race_number, user_guid,
               CASE WHEN CAST(user_guid AS BIGINT) % 53 = 7 THEN NULL ELSE team_no END AS team_no,
               team_name, CASE WHEN race_rank % 29 = 3 THEN NULL ELSE race_points END
                   AS race_points, race_rank, recorded_asset_value,
               CASE WHEN race_rank % 41 = 3 THEN NULL ELSE remaining_budget END
                   AS remaining_budget, recorded_total_budget, transfers_made,
               free_transfers_remaining FROM {team_race}
        UNION ALL
        SELECT season, race_number, user_guid, team_no, team_name, race_points, race_rank,
               recorded_asset_value, remaining_budget, recorded_total_budget, transfers_made,
               free_transfers_remaining
        FROM {team_race} WHERE race_rank % 17 = 0""",
    "team_race_asset": """
        SELECT season, race_number, user_guid, team_no, team_name,
               CASE WHEN (asset_id + race_number) % 43 = 1 THEN asset_id + 100 ELSE asset_id END
                   AS asset_id, is_captain, is_mg_captain,
               CASE WHEN asset_id = 13 AND race_number = 6 THEN NULL ELSE player_position END
                   AS player_position, is_final FROM {team_race_asset}
        UNION ALL
        SELECT season, race_number, user_guid, team_no, team_name, asset_id, is_captain,
               is_mg_captain, player_position, is_final
        FROM {team_race_asset} WHERE CAST(user_guid AS BIGINT) % 71 = 2""",
    "team_chip_usage": """
        SELECT season, CASE WHEN CAST(user_guid AS BIGINT) % 31 = 4 THEN concat(user_guid, 'x')
                   ELSE user_guid END AS user_guid, team_no, team_name,
               CASE WHEN CAST(user_guid AS BIGINT) % 37 = 4 THEN chip_id + 10 ELSE chip_id END
                   AS chip_id,
               CASE WHEN CAST(user_guid AS BIGINT) % 47 = 6 THEN NULL
                    WHEN CAST(user_guid AS BIGINT) % 11 = 2 THEN 1 + race_used % 12
                    ELSE race_used END AS race_used FROM {team_chip_usage}""",
}

# The same tables as further views of the comparison SQL.
VIEWS = {f"p_{name}": text.replace("{", "").replace("}", "") for name, text in PLANTED.items()}


def planted_tables(league: StarLeague) -> dict:
    tables = league.tables
    changed = {
        name: league.spark.sql(text, **{name: tables[name]}) for name, text in PLANTED.items()
    }
    return {**tables, **changed}
