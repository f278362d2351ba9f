"""Quality checks over tables with planted violations, and over the clean ones."""

from checks.planted import VIEWS, planted_tables
from checks.registry import registered
from pitlane import fixed_values as V
from pitlane.operators import quality


def _view(table):
    return f"p_{table}" if f"p_{table}" in VIEWS else table


def _each(check, body, tables=V.KEYS):
    """One branch per table; `body` builds the count from the view and the table name."""
    return "\n    UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{t}' AS source, CAST(NULL AS VARCHAR) AS related, "
        f"CAST(({body(_view(t), t)}) AS BIGINT) AS n" for t in tables
    )


def _count_null(keys):
    return " OR ".join(f"{k} IS NULL" for k in keys)


@registered(_each("rows", lambda view, _: f"SELECT COUNT(*) FROM {view}"), **VIEWS)
def dq_row_counts(league):
    return quality.row_counts(planted_tables(league))


NULL_KEYS = _each("null key", lambda view, t:
                  f"SELECT COUNT(*) FROM {view} WHERE {_count_null(V.KEYS[t])}")


@registered(NULL_KEYS, **VIEWS)
def dq_null_keys(league):
    return quality.null_keys(planted_tables(league))


DUPLICATES = _each("duplicate key", lambda view, t:
                   f"SELECT COALESCE(SUM(c - 1), 0) FROM (SELECT COUNT(*) AS c FROM {view} "
                   f"GROUP BY {', '.join(V.KEYS[t])})")


@registered(DUPLICATES, **VIEWS)
def dq_duplicate_keys(league):
    return quality.duplicate_keys(planted_tables(league))


def _by_column(check, columns):
    return "\n    UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{t}' AS source, '{c}' AS related, "
        f"(SELECT COUNT(*) FROM {_view(t)} WHERE {c} IS NULL) AS n"
        for t, names in columns.items() for c in names
    )


@registered(_by_column("null measure", V.REQUIRED), **VIEWS)
def dq_null_measures(league):
    return quality.null_measures(planted_tables(league))


# The columns of the tables with planted defects.
COLUMNS = {
    "asset_race": [*V.KEYS["asset_race"], "asset_type", "value", "gameday_points"],
    "team_race": [
        *V.TEAM_RACE_KEY, "team_name", "race_points", "race_rank", "recorded_asset_value",
        "remaining_budget", "recorded_total_budget", "transfers_made", "free_transfers_remaining",
    ],
    "team_race_asset": [
        *V.TEAM_RACE_KEY, "team_name", "asset_id", "is_captain", "is_mg_captain",
        "player_position", "is_final",
    ],
    "team_chip_usage": [*V.TEAM_KEY, "team_name", "chip_id", "race_used"],
}


@registered(_by_column("nulls", COLUMNS), **VIEWS)
def null_counts(league):
    """Nulls of every column, required or not."""
    tables = planted_tables(league)
    return quality.null_counts({name: tables[name] for name in COLUMNS})


@registered(_by_column("optional gap", V.OPTIONAL), **VIEWS)
def dq_optional_gaps(league):
    return quality.optional_gaps(planted_tables(league))


def _violating(table):
    key = ", ".join(f"{k}: {k}" for k in V.KEYS[table])
    rules = [f"CASE WHEN {_count_null(V.KEYS[table])} THEN 'null key' END"] + [
        f"CASE WHEN {c} IS NULL THEN 'null measure {c}' END" for c in V.REQUIRED.get(table, [])]
    return (f"SELECT '{table}' AS source, CAST(to_json({{{key}}}) AS VARCHAR) AS key, "
            f"concat_ws(',', {', '.join(rules)}) AS broken FROM {_view(table)}")


@registered("SELECT * FROM (" + "\n    UNION ALL ".join(_violating(t) for t in V.KEYS)
            + ") WHERE broken <> ''", **VIEWS)
def dq_violating_rows(league):
    return quality.violating_rows(planted_tables(league))


def _references(view):
    """Rows whose key is not found in the related table; a key with a null is found nowhere."""
    return "\n    UNION ALL ".join(
        f"SELECT 'reference' AS \"check\", '{s}' AS source, '{r}' AS related, COUNT(*) AS n "
        f"FROM {view(s)} a WHERE NOT EXISTS (SELECT 1 FROM {view(r)} b WHERE "
        + " AND ".join(f"a.{mine} = b.{theirs}" for mine, theirs in on.items()) + ")"
        for s, r, on in V.RELATIONSHIPS
    )


@registered(_references(_view), **VIEWS)
def dq_referential(league):
    return quality.referential(planted_tables(league))


@registered(_references(lambda table: table))
def dq_referential_clean(league):
    return quality.referential(league.tables)


# A use is unmatched if its team has no row at the race where the chip is used.
UNMATCHED = """p_team_chip_usage u WHERE NOT EXISTS (
        SELECT 1 FROM p_team_race t WHERE t.season = u.season AND t.race_number = u.race_used
          AND t.user_guid = u.user_guid AND t.team_no = u.team_no)"""


# Uses in races after the season's last loaded one are to come and need no row.
@registered(f"""
    SELECT 'historical use' AS "check", 'team_chip_usage' AS source, 'team_race' AS related,
           COUNT(*) AS n
    FROM {UNMATCHED} AND u.race_used <= (
        SELECT MAX(x.race_number) FROM p_team_race x WHERE x.season = u.season)""", **VIEWS)
def dq_historical_chip_usage(league):
    return quality.historical_usage(planted_tables(league))


@registered(f"SELECT u.* FROM {UNMATCHED}", **VIEWS)
def dq_unmatched_chip_rows(league):
    tables = planted_tables(league)
    return quality.unmatched_chip_rows(tables["team_chip_usage"], tables["team_race"])
