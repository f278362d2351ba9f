"""Declared schemas: nothing is inferred, neither on landing nor on load."""

from pyspark.sql import types as T

from pitlane import fixed_values as V

_string, _long, _double = T.StringType(), T.LongType(), T.DoubleType()


def _struct(fields, data_type=None):
    """A nullable struct from a {name: type} mapping, or from names that share one type."""
    pairs = fields.items() if isinstance(fields, dict) else ((f, data_type) for f in fields)
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_feed_time = _struct({"UTCTime": _string})

# Asset feed scalars land as text and are coerced later, so a malformed number costs one value
# and not the whole document.
ASSET_FEED = _struct({
    "Data": _struct({
        "Value": T.ArrayType(
            _struct(list(V.ASSET_COLUMNS), _string)
            .add("AdditionalStats", _struct(list(V.ASSET_STATISTICS), _string))
        ),
        "FeedTime": _feed_time,
    }),
})

STANDINGS = _struct({
    "Value": _struct({
        "leaderboard": T.ArrayType(_struct({
            "user_guid": _string, "team_no": _string, "cur_rank": _string,
            "cur_points": _string, "team_name": _string, "user_name": _string,
            "trend": _string, "user_team": T.ArrayType(_string),
        })),
    }),
    "FeedTime": _feed_time,
})

# So do the scalars of a team document: a feed writes 1, 1.0 and "1" for the same thing.
TEAM_DETAIL = _struct({
    "Data": _struct({
        "Value": _struct({
            "mdid": _string,
            "userTeam": T.ArrayType(_struct({
                "teamno": _string, "teamname": _string, "socialId": _string, "teamval": _string,
                "teambal": _string, "maxteambal": _string, "usersubs": _string,
                "usersubsleft": _string,
                "playerid": T.ArrayType(_struct(list(V.LINEUP_COLUMNS), _string)),
                **{field: _string for pair in V.CHIP_FIELDS.values() for field in pair},
            })),
        }),
    }),
})


def _asset_race():
    columns = [*V.ASSET_COLUMNS.values(), *V.ASSET_STATISTICS.values()]
    kept = [c for c in columns if c not in V.ASSET_DROPPED]
    kinds = {c: _long if c in V.ASSET_INTEGERS else _string if c in V.ASSET_TEXTS else _double
             for c in kept}
    return _struct({"season": _long, "race_number": _long, "feed_time_utc": T.TimestampType(),
                    "retrieved_at_utc": T.TimestampType(), **kinds})


ASSET_RACE = _asset_race()

TEAM_RACE = _struct({
    "season": _long, "race_number": _long, "feed_time_utc": T.TimestampType(),
    "retrieved_at_utc": T.TimestampType(), "user_guid": _string, "team_no": _long,
    "race_rank": _long, "race_points": _double, "team_name": _string, "trend": _long,
    "recorded_asset_value": _double, "remaining_budget": _double,
    "recorded_total_budget": _double, "transfers_made": _long,
    "free_transfers_remaining": _long,
})

TEAM_RACE_ASSET = _struct({
    "season": _long, "race_number": _long, "user_guid": _string, "team_no": _long,
    "team_name": _string, "asset_id": _long, "is_captain": _long, "is_mg_captain": _long,
    "player_position": _long, "is_final": _long,
})

TEAM_CHIP_USAGE = _struct({
    "season": _long, "user_guid": _string, "team_no": _long, "team_name": _string,
    "chip_id": _long, "race_used": _long,
})

RACES = _struct({
    "season": _long, "race_number": _long, "race_name": _string, "country": _string,
    "city_or_location": _string, "circuit_name": _string, "weekend_start_date": T.DateType(),
    "weekend_end_date": T.DateType(), "race_date": T.DateType(),
    "sprint_weekend": T.BooleanType(), "race_short_name": _string,
})

CHIPS = _struct({
    "chip_id": _long, "chip_key": _string, "api_name": _string, "display_name": _string,
    "available_first_race": _long, "chip_short_name": _string,
})

TABLES = {
    "asset_race": ASSET_RACE, "team_race": TEAM_RACE, "team_race_asset": TEAM_RACE_ASSET,
    "team_chip_usage": TEAM_CHIP_USAGE, "races": RACES, "chips": CHIPS,
}
