"""Nested JSON documents to typed tables: asset feeds, league standings, team details.

One scan reads the documents of all races and teams; nothing loops over files.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from pitlane import fixed_values as V
from pitlane import schemas
from pitlane.functions.columns import (
    coerce_double, coerce_integer, feed_timestamp, loses_fraction, percent_decode,
)

SCHEMAS = {
    "asset_snapshot": schemas.ASSET_FEED,
    "league_standings": schemas.STANDINGS,
    "detailed_teams": schemas.TEAM_DETAIL,
}
# Keys that only the file name holds, as (column, pattern, type).
_RACE_IN_NAME = ("race_number", r"_race_(\d+)\.json$", "bigint")
NAME_KEYS = {
    "asset_snapshot": [_RACE_IN_NAME],
    "league_standings": [_RACE_IN_NAME],
    "detailed_teams": [
        ("user_guid", r"([^/]+)_team_\d+_race_\d+\.json$", "string"),
        ("team_no", r"_team_(\d+)_race_\d+\.json$", "bigint"),
        _RACE_IN_NAME,
    ],
}


def keys_from_path(dataset: str) -> list[Column]:
    """What the file name holds; null where it doesn't."""
    path = F.col("_metadata.file_path")
    return [
        F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).try_cast(kind).alias(name)
        for name, pattern, kind in NAME_KEYS[dataset]
    ]


def scan(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """Every document of a data set with the keys of its file name."""
    documents = spark.read.schema(SCHEMAS[dataset]).option("multiLine", True).json(path)
    return documents.select(*keys_from_path(dataset), "*")


_RECORDS = {
    "asset_snapshot": "Data.Value", "league_standings": "Value.leaderboard",
    "detailed_teams": "Data.Value.userTeam",
}


def records_of(dataset: str) -> Column:
    """The array of records that a document is about."""
    return F.col(_RECORDS[dataset])


def stored_schema(dataset: str) -> StructType:
    """What is stored of a document: its declared schema without the personal fields."""
    personal = {"league_standings": V.STANDINGS_PERSONAL, "detailed_teams": V.TEAM_DETAIL_PERSONAL}

    def without(kind: DataType) -> DataType:
        if isinstance(kind, ArrayType):
            return ArrayType(without(kind.elementType))
        if isinstance(kind, StructType):
            return StructType([
                StructField(f.name, without(f.dataType)) for f in kind.fields
                if f.name != personal.get(dataset)
            ])
        return kind

    return without(SCHEMAS[dataset])


def without_personal_fields(documents: DataFrame, dataset: str) -> DataFrame:
    """Remove account identifiers before anything is stored."""
    if dataset == "league_standings":
        board = F.transform("Value.leaderboard", lambda row: row.dropFields(V.STANDINGS_PERSONAL))
        return documents.withColumn(
            "Value", F.col("Value").withField("leaderboard", board)
        )
    if dataset == "detailed_teams":
        teams = F.transform(
            "Data.Value.userTeam", lambda team: team.dropFields(V.TEAM_DETAIL_PERSONAL)
        )
        return documents.withColumn("Data", F.col("Data").withField("Value.userTeam", teams))
    return documents


def asset_records(documents: DataFrame, season: int, retrieved_at: Column) -> DataFrame:
    """One row per asset of each feed, with the feed time of its document."""
    return documents.select(
        "race_number", F.col("Data.FeedTime.UTCTime").alias("feed_time_utc"),
        F.explode("Data.Value").alias("v"),
    ).select(
        F.lit(season).cast("bigint").alias("season"), "race_number", "feed_time_utc",
        retrieved_at.alias("retrieved_at_utc"),
        *[F.col(f"v.{field}").alias(field) for field in V.ASSET_COLUMNS],
        *[F.col(f"v.AdditionalStats.{field}").alias(field) for field in V.ASSET_STATISTICS],
    )


def asset_race(documents: DataFrame, season: int, retrieved_at: Column) -> DataFrame:
    """Renamed and typed asset rows."""
    records = (
        asset_records(documents, season, retrieved_at)
        .withColumnsRenamed({**V.ASSET_COLUMNS, **V.ASSET_STATISTICS})
        .drop(*V.ASSET_DROPPED)
        .withColumn("feed_time_utc", feed_timestamp("feed_time_utc"))
    )
    return to_schema(records, schemas.ASSET_RACE)


def to_schema(records: DataFrame, schema) -> DataFrame:
    """Coerce text columns to a declared schema: junk becomes null, typed columns stay."""
    held = dict(records.dtypes)
    columns = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        column = F.col(field.name)
        if held[field.name] == "string" and kind == "bigint":
            column = coerce_integer(column)
        elif held[field.name] == "string" and kind == "double":
            column = coerce_double(column)
        elif held[field.name] != kind:
            column = column.cast(kind)
        columns.append(column.alias(field.name))
    return records.select(*columns)


def leaderboard_records(documents: DataFrame, season: int, retrieved_at: Column) -> DataFrame:
    """One row per team of each standings document."""
    return documents.select(
        F.lit(season).cast("bigint").alias("season"), "race_number",
        F.col("FeedTime.UTCTime").alias("feed_time_utc"),
        retrieved_at.alias("retrieved_at_utc"), F.explode("Value.leaderboard").alias("row"),
    ).select("season", "race_number", "feed_time_utc", "retrieved_at_utc", "row.*")


STANDINGS_SELECTED = [
    "season", "race_number", "feed_time_utc", "retrieved_at_utc", "user_guid", "team_no",
    "race_rank", "race_points", "team_name", "trend", "user_team",
]


def team_race_with_roster(leaderboard: DataFrame) -> DataFrame:
    """Decoded, renamed and typed standings rows that still hold the roster array."""
    return (
        leaderboard
        .withColumnsRenamed(V.STANDINGS_COLUMNS)
        .select(*STANDINGS_SELECTED)
        .withColumns({
            "team_name": percent_decode("team_name"),
            "feed_time_utc": feed_timestamp("feed_time_utc"),
            "user_guid": F.col("user_guid").cast("string"),
            "race_points": coerce_double("race_points"),
            **{c: coerce_integer(c)
               for c in ["season", "race_number", "team_no", "race_rank", "trend"]},
        })
    )


def roster_rows(team_race: DataFrame) -> DataFrame:
    """One row per roster entry. An empty roster keeps one row with a null asset."""
    return team_race.select(
        *V.TEAM_RACE_KEY, "team_name", F.explode_outer("user_team").alias("asset_id")
    )


def first_team(documents: DataFrame) -> DataFrame:
    """The team of each detail document beside its keys. A document without a team is an error."""
    return documents.select(
        "user_guid", coerce_integer("Data.Value.mdid").alias("race_number"),
        F.element_at("Data.Value.userTeam", 1).alias("team"),
    )


def _team_no() -> Column:
    return coerce_integer("team.teamno").alias("team_no")


def lineup_records(documents: DataFrame, season: int) -> DataFrame:
    """One row per asset of each lineup, with captain flags, slot and swap status."""
    return (
        first_team(documents)
        .select(F.lit(season).cast("bigint").alias("season"), "race_number", "user_guid",
                _team_no(), F.explode("team.playerid").alias("p"))
        .select(*V.TEAM_RACE_KEY,
                *[(F.col(f"p.{field}") if name == "asset_id" else coerce_integer(f"p.{field}"))
                  .alias(name) for field, name in V.LINEUP_COLUMNS.items()])
    )


def finance_records(documents: DataFrame, season: int) -> DataFrame:
    """One row of money and transfers per detail document.

    The money is cast strictly: an absent amount stays null, junk raises.
    """
    def column(field, name):
        money = field.endswith("val") or field.endswith("bal")
        value = F.col(f"team.{field}")
        return (value.cast("double") if money else coerce_integer(value)).alias(name)

    return first_team(documents).select(
        F.lit(season).cast("bigint").alias("season"), "race_number", "user_guid",
        _team_no(), *[column(field, name) for field, name in V.FINANCE_COLUMNS.items()],
    )


def used_chips(teams: DataFrame) -> DataFrame:
    """Unpivot six (flag, race) pairs into one row per used chip.

    `teams` holds season, user_guid, team_no, team_name and the twelve fields.
    """
    pairs = F.array(*[
        F.struct(F.lit(chip).cast("bigint").alias("chip_id"), coerce_integer(flag).alias("flag"),
                 coerce_integer(race).alias("race_used"))
        for chip, (flag, race) in V.CHIP_FIELDS.items()
    ])
    return (
        teams.select(*V.TEAM_KEY, "team_name", F.inline(pairs))
        .filter("flag = chip_id")
        .select(*V.TEAM_KEY, "team_name", "chip_id", F.col("race_used").cast("bigint"))
    )


def whole_number_texts(documents: DataFrame, dataset: str) -> DataFrame:
    """The texts of all fields that must hold whole numbers, a row per record, under their names.

    What `loses_fraction` finds among them is lost by coercion.
    """
    if dataset == "asset_snapshot":
        named = {**V.ASSET_COLUMNS}
        record = documents.select(F.explode(records_of(dataset)).alias("v"))
        return record.select(*[
            F.col(f"v.{field}").alias(name) for field, name in named.items()
            if name in V.ASSET_INTEGERS
        ])
    if dataset == "league_standings":
        record = documents.select(F.explode(records_of(dataset)).alias("v"))
        return record.select("v.team_no", F.col("v.cur_rank").alias("race_rank"), "v.trend")
    record = documents.select("Data.Value.mdid", F.explode(records_of(dataset)).alias("v"))
    lineup = [name for name in V.LINEUP_COLUMNS if name != "id"]
    chips = [field for pair in V.CHIP_FIELDS.values() for field in pair]
    # Of a lineup, the first value that isn't whole, so that a team stays one row.
    broken = lambda field: F.get(F.filter(
        F.col(f"v.playerid.{field}"), loses_fraction), F.lit(0)).alias(field)
    return record.select(
        "mdid", *[F.col(f"v.{f}").alias(f) for f in ("teamno", "usersubs", "usersubsleft", *chips)],
        *[broken(field) for field in lineup])


def chip_usage(documents: DataFrame, latest: DataFrame, season: int) -> DataFrame:
    """Chips used, read from each team's latest document only: chip fields cover the season.

    `latest` holds user_guid, team_no and race_number of each team's latest standings row.
    """
    teams = first_team(documents).select(
        "user_guid", "race_number", _team_no(), "team"
    ).join(latest, ["user_guid", "team_no", "race_number"], "left_semi")
    return used_chips(teams.select(
        F.lit(season).cast("bigint").alias("season"), "user_guid", "team_no",
        percent_decode("team.teamname").alias("team_name"), "team.*",
    ))
