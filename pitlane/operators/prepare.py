"""Preparation of source tables: snapshots, enrichment, coverage, column order."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.operators.joins import join_one_to_one
from pitlane.operators.ranking import latest_per_key
from pitlane.sources.tables import stack


def columns_first(df: DataFrame, front: list[str]) -> DataFrame:
    return df.select(*front, *[c for c in df.columns if c not in front])


def team_keys(rows: DataFrame, by: list[str] = V.TEAM_RACE_KEY) -> DataFrame:
    return rows.select(*by).distinct()


def latest_snapshots(team_race: DataFrame) -> DataFrame:
    """The last race in which each team stands, by season."""
    return latest_per_key(team_race.select(*V.TEAM_KEY, "race_number"), V.TEAM_KEY, "race_number")


def completed_races(races: DataFrame, as_of: date) -> DataFrame:
    """Races that were over before `as_of`, a day given by the caller."""
    return races.filter(F.col("race_date") < F.lit(as_of)).orderBy(*V.RACE_KEY)


def price_feed_coverage(races: DataFrame, as_of: date) -> DataFrame:
    """Feeds expected per season: race 1 to the one after the last completed race."""
    last = (
        races.filter(F.col("race_date") < F.lit(as_of))
        .groupBy("season").agg(F.max("race_number").alias("last"))
    )
    first = F.lit(1).cast("bigint")
    return last.select(
        "season", F.explode(F.sequence(first, F.col("last") + 1)).alias("race_number")
    )


def not_landed(expected: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Expected documents that have not been saved."""
    return expected.join(landed.select(*keys), keys, "left_anti")


def missing_documents(
    races: DataFrame, as_of: date, prices: DataFrame, standings: DataFrame, details: DataFrame,
    board: DataFrame,
) -> DataFrame:
    """What a season needs and has not landed: dataset, season, race_number, user_guid, team_no.

    Prices of every race up to the one after the last completed race, standings of every completed
    race, and a detail document of every team that stands on the board of a completed race. The
    other tables hold the keys of what is there.
    """
    done = completed_races(races, as_of).select(*V.RACE_KEY)
    stood = board.select(*V.TEAM_RACE_KEY).join(done, V.RACE_KEY, "left_semi")
    wanted = {
        "asset_snapshot": not_landed(price_feed_coverage(races, as_of), prices, V.RACE_KEY),
        "league_standings": not_landed(done, standings, V.RACE_KEY),
        "detailed_teams": not_landed(stood, details, V.TEAM_RACE_KEY),
    }
    none = {"user_guid": F.lit(None).cast("string"), "team_no": F.lit(None).cast("bigint")}
    return stack([
        (df if name == "detailed_teams" else df.withColumns(none))
        .select(F.lit(name).alias("dataset"), *V.TEAM_RACE_KEY)
        for name, df in wanted.items()
    ])


def _enrich(rows, details, key, columns, sentinel, what):
    """Left join of details one to one; earlier enrichment columns are replaced."""
    enriched = join_one_to_one(
        rows.drop(*columns), details.select(*key, *columns), key, what, sentinel
    )
    kept = [c for c in rows.columns if c not in columns]
    return enriched.select(*kept, *columns)


LINEUP_ADDED = ["is_captain", "is_mg_captain", "player_position", "is_final"]


def enrich_roster(roster: DataFrame, lineups: DataFrame) -> DataFrame:
    """Add captain flags, slot and swap status to roster rows of all races at once.

    The asset id is text in both feeds and is joined as text.
    """
    as_text = F.col("asset_id").cast("string")
    return _enrich(
        roster.withColumn("asset_id", as_text), lineups.withColumn("asset_id", as_text),
        V.KEYS["team_race_asset"], LINEUP_ADDED, "is_captain", "roster details",
    )


FINANCE_ADDED = list(V.FINANCE_COLUMNS.values())


def enrich_team_race(team_race: DataFrame, finance: DataFrame) -> DataFrame:
    """Add money and transfers to team rows of all races at once."""
    return _enrich(team_race, finance, V.TEAM_RACE_KEY, FINANCE_ADDED, "remaining_budget",
                   "team details")


def unmatched(rows: DataFrame, details: DataFrame, key: list[str]) -> DataFrame:
    """Rows that enrichment would leave without details."""
    return rows.join(details.select(*key), key, "left_anti")
