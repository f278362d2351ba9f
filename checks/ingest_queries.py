"""Preparation steps, over league tables turned back into feed form and over the given tables."""

import uuid

from pyspark.sql import functions as F

from checks.registry import registered
from checks.star_league import AS_OF
from pitlane import fixed_values as V
from pitlane.functions import columns as C
from pitlane.operators import prepare, quality
from pitlane.sources import documents
from pitlane.sources.tables import shared_dir, stack

KEY = "season, race_number, user_guid, team_no"


# --- coverage ---------------------------------------------------------------------------------

@registered(f"""SELECT {KEY} FROM team_race JOIN races USING (season, race_number)
    WHERE race_date < DATE '{AS_OF}' AND recorded_asset_value IS NULL""")
def landing_new_documents(league):
    """Team documents expected for completed races and not saved yet.

    Those with a recorded value count as saved.
    """
    done = prepare.completed_races(league.races, AS_OF)
    expected = league.team_race.join(done, V.RACE_KEY, "left_semi").select(*V.TEAM_RACE_KEY)
    return prepare.not_landed(
        expected, league.team_race.filter("recorded_asset_value IS NOT NULL"), V.TEAM_RACE_KEY
    )


@registered(f"""
    SELECT 'asset_snapshot' AS dataset, season, race_number, CAST(NULL AS VARCHAR) AS user_guid,
           CAST(NULL AS BIGINT) AS team_no
    FROM (SELECT season, CAST(unnest(generate_series(1, race_number + 1)) AS BIGINT) AS race_number
          FROM completed)
    WHERE (season, race_number) NOT IN (
        SELECT (season, race_number) FROM asset_race WHERE (season + race_number) % 5 <> 0)
    UNION ALL
    SELECT 'league_standings', season, race_number, NULL, NULL FROM races
    WHERE race_date < DATE '{AS_OF}' AND (season, race_number) NOT IN (
        SELECT (season, race_number) FROM team_race WHERE race_number % 4 <> 1)
    UNION ALL
    SELECT 'detailed_teams', season, race_number, user_guid, team_no
    FROM team_race JOIN races USING (season, race_number)
    WHERE race_date < DATE '{AS_OF}' AND recorded_asset_value IS NULL""")
def missing_documents(league):
    """Of a league where some price feeds, standings and team documents have not landed."""
    team_race = league.team_race
    return prepare.missing_documents(
        league.races, AS_OF, league.asset_race.filter("(season + race_number) % 5 != 0"),
        team_race.filter("race_number % 4 != 1"),
        team_race.filter("recorded_asset_value IS NOT NULL"), team_race)


@registered(f"""SELECT season, race_number, race_name, race_short_name,
    CAST(race_date AS VARCHAR) AS race_date, sprint_weekend FROM races
    WHERE race_date < DATE '{AS_OF}'""")
def completed_races(league):
    return prepare.completed_races(league.races, AS_OF).withColumn(
        "race_date", F.col("race_date").cast("string")
    )


@registered("""SELECT season, CAST(unnest(generate_series(1, race_number + 1)) AS BIGINT)
    AS race_number FROM completed""")
def price_feed_coverage(league):
    return prepare.price_feed_coverage(league.races, AS_OF)


@registered(f"SELECT DISTINCT {KEY} FROM team_race_asset")
def distinct_team_keys(league):
    return prepare.team_keys(league.team_race_asset)


@registered("""SELECT season, user_guid, team_no, MAX(race_number) AS race_number FROM team_race
    GROUP BY 1, 2, 3""")
def latest_snapshot_per_team(league):
    return prepare.latest_snapshots(league.team_race)


# --- enrichment -------------------------------------------------------------------------------

def _plain_roster(league):
    return league.team_race_asset.select(
        *V.TEAM_RACE_KEY, "team_name", F.col("asset_id").cast("string").alias("asset_id")
    )


@registered("""SELECT season, race_number, user_guid, team_no, team_name,
    CAST(asset_id AS VARCHAR) AS asset_id, is_captain, is_mg_captain, player_position, is_final
    FROM team_race_asset""")
def enrich_roster(league):
    return prepare.enrich_roster(_plain_roster(league), league.team_race_asset)


@registered("SELECT * FROM team_race")
def enrich_team_race(league):
    """Rows without money get it from details that hold nothing but their key and the money."""
    details = league.team_race.select(*V.TEAM_RACE_KEY, *prepare.FINANCE_ADDED)
    return prepare.enrich_team_race(league.team_race.drop(*prepare.FINANCE_ADDED), details)


@registered(f"""SELECT {KEY}, team_name, CAST(asset_id AS VARCHAR) AS asset_id
    FROM team_race_asset WHERE (race_number*3 + asset_id) % 17 = 0""")
def enrich_unmatched_rows(league):
    details = league.team_race_asset.filter("(race_number*3 + asset_id) % 17 != 0")
    return prepare.unmatched(
        _plain_roster(league), details.withColumn("asset_id", F.col("asset_id").cast("string")),
        V.KEYS["team_race_asset"],
    )


@registered("""SELECT CAST(asset_id AS VARCHAR) AS asset_id, COUNT(*) AS roster_rows,
    COUNT(is_captain) AS detailed_rows FROM team_race_asset GROUP BY 1""")
def key_type_alignment(league):
    """Rosters with text ids get the details of lineups with whole-number ids."""
    enriched = prepare.enrich_roster(_plain_roster(league), league.team_race_asset)
    return enriched.groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("roster_rows"), F.count("is_captain").alias("detailed_rows"))


# --- feed rows --------------------------------------------------------------------------------

@registered(f"""SELECT {KEY}, race_rank, race_points, team_name, CAST(NULL AS BIGINT) AS trend
    FROM team_race""")
def team_race_prepare(league):
    """Standings rows in feed form: percent-encoded names, numbers as text."""
    feed = league.team_race.select(
        "season", "race_number", F.lit("3/8/2026 5:04:09 PM").alias("feed_time_utc"),
        F.current_timestamp().alias("retrieved_at_utc"), "user_guid",
        F.col("team_no").cast("string").alias("team_no"),
        F.concat(F.col("race_rank").cast("string"), F.lit(".0")).alias("cur_rank"),
        F.col("race_points").cast("string").alias("cur_points"),
        F.replace("team_name", F.lit(" "), F.lit("%20")).alias("team_name"),
        F.lit("n/a").alias("trend"), F.array().cast("array<string>").alias("user_team"),
    )
    return documents.team_race_with_roster(feed).drop(
        "feed_time_utc", "retrieved_at_utc", "user_team"
    )


@registered(f"""SELECT {KEY}, team_name, CASE WHEN (race_number + team_no) % 13 <> 0
    THEN CAST(asset_id AS VARCHAR) END AS asset_id FROM team_race_asset
    WHERE (race_number + team_no) % 13 <> 0 OR player_position = 1""")
def roster_explode(league):
    """Rosters as arrays, some of them empty, back to rows; an empty one keeps a null row."""
    # A roster has seven or eight assets.
    arrays = league.team_race_asset.groupBy(*V.TEAM_RACE_KEY, "team_name").agg(
        F.collect_list(F.col("asset_id").cast("string")).alias("assets")
    )
    empty = F.array().cast("array<string>")
    return documents.roster_rows(arrays.withColumn(
        "user_team",
        F.when((F.col("race_number") + F.col("team_no")) % 13 == 0, empty)
        .otherwise(F.col("assets")),
    ))


@registered("SELECT * FROM team_chip_usage")
def chip_unpivot(league):
    """Chip uses as the twelve wide fields of a team document, back to one row per use."""
    def of(chip, column):
        return F.max(F.when(F.col("chip_id") == chip, F.col(column)))

    wide = league.team_chip_usage.groupBy(*V.TEAM_KEY, "team_name").agg(*[
        of(chip, source).alias(field)
        for chip, pair in V.CHIP_FIELDS.items()
        for field, source in zip(pair, ("chip_id", "race_used"))
    ])
    return documents.used_chips(wide)


def _part_feed(league):
    """An asset feed document per part; every seventh one has a fraction in its points."""
    held = {
        "PlayerId": F.col("p_partkey"), "DisplayName": F.col("p_name"),
        "PositionName": F.col("p_brand"), "Value": F.col("p_retailprice"),
        "GamedayPoints": F.when(F.col("p_partkey") % 7 == 0, F.concat("p_size", F.lit(".5")))
        .otherwise(F.col("p_size").cast("string")),
        "old_Value": F.col("p_type"), "new_value": F.col("p_type"),
    }
    none = F.lit(None).cast("string")
    statistics = F.struct(*[none.alias(field) for field in V.ASSET_STATISTICS])
    record = F.struct(
        *[held.get(field, none).cast("string").alias(field) for field in V.ASSET_COLUMNS],
        statistics.alias("AdditionalStats"))
    time = F.struct(F.lit("3/8/2026 5:04:09 PM").alias("UTCTime"))
    return league.table("part").select(
        F.col("p_size").cast("bigint").alias("race_number"),
        F.struct(F.array(record).alias("Value"), time.alias("FeedTime")).alias("Data"))


def _part_assets(league):
    return documents.asset_race(_part_feed(league), 2026, F.current_timestamp())


@registered("""SELECT CAST(c_custkey AS VARCHAR) AS user_guid, '1' AS team_no,
    c_mktsegment AS cur_rank, c_name AS team_name FROM customer""", views=False)
def drop_personal_fields(league):
    """Customers as leaderboards of one row, with a personal field."""
    row = F.struct(
        F.col("c_custkey").cast("string").alias("user_guid"), F.lit("1").alias("team_no"),
        F.col("c_mktsegment").alias("cur_rank"), F.col("c_name").alias("team_name"),
        F.lit("secret").alias(V.STANDINGS_PERSONAL))
    boards = league.table("customer").select(
        F.struct(F.array(row).alias("leaderboard")).alias("Value"))
    clean = documents.without_personal_fields(boards, "league_standings")
    return clean.select(F.inline("Value.leaderboard"))


@registered("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events", views=False)
def json_field_extract(league):
    """Events written as feed documents, some hundred to a file, and scanned as documents."""
    events = league.table("events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"))
    record = F.struct(F.col("event_id").cast("string").alias("PlayerId"), F.col("k").alias("Value"))
    document = F.to_json(F.struct(F.struct(F.array(record).alias("Value")).alias("Data")))
    files = F.lit(1 + events.count() // 500)
    # Some hundred documents, as many as a file is meant to hold.
    arrays = events.groupBy(F.pmod(F.xxhash64("event_id"), files).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(document), ","), F.lit("]")).alias("text"))
    path = f"{shared_dir(league.spark)}/{league.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    arrays.write.partitionBy("file").text(path)
    found = documents.scan(league.spark, "asset_snapshot", path)
    return documents.asset_records(found, 2026, F.current_timestamp()).select(
        F.col("PlayerId").cast("bigint").alias("event_id"), C.coerce_integer("Value").alias("k"))


# --- columns ----------------------------------------------------------------------------------

@registered("SELECT s_name, s_nationkey, s_suppkey, s_acctbal FROM supplier", views=False)
def reorder_columns(league):
    return prepare.columns_first(league.table("supplier"), ["s_name", "s_nationkey"])


@registered("""SELECT p_partkey AS asset_id, p_name AS display_name, p_brand AS asset_type,
    p_retailprice AS value, CAST(p_size AS BIGINT) AS race_number FROM part""", views=False)
def rename_columns_map(league):
    return _part_assets(league).select(
        "asset_id", "display_name", "asset_type", "value", "race_number")


@registered("SELECT p_partkey AS asset_id, p_name AS display_name FROM part", views=False)
def drop_if_present(league):
    """Of four columns that the feed has, those that are left after preparation."""
    assets = _part_assets(league)
    some = ["asset_id", "display_name", *V.ASSET_DROPPED]
    return assets.select(*[c for c in some if c in assets.columns])


@registered("""SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
    c_mktsegment AS segment FROM customer UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""", views=False)
def union_by_name_all(league):
    names = {"key": "id", "custkey": "id", "suppkey": "id", "nationkey": "nation",
             "acctbal": "balance", "mktsegment": "segment"}

    def short(df):
        return df.select(*[F.col(c).alias(names.get(c[2:], c[2:])) for c in df.columns])

    return stack([short(league.table("customer")),
                  short(league.table("supplier")).select("balance", "nation", "name", "id")])


# --- values -----------------------------------------------------------------------------------

# Quantities as a feed might write them, chosen by arithmetic on the order key.
RAW = """CASE l_orderkey % 8
    WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN concat({q}, '.7') WHEN 3 THEN concat({q}, '.0')
    WHEN 4 THEN concat(' ', {q}) WHEN 5 THEN concat({q}, 'd') WHEN 6 THEN NULL
    ELSE {q} END""".replace("{q}", "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(20))")


def _raw(league):
    return league.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(RAW).alias("raw")
    )


@registered(f"""SELECT l_orderkey, l_linenumber, {RAW} AS raw,
    CASE WHEN l_orderkey % 8 IN (3, 4, 7) THEN CAST(l_quantity AS BIGINT) END AS value,
    l_orderkey % 8 = 2 AS loses_fraction FROM lineitem""", views=False)
def coerce_integer(league):
    return _raw(league).select(
        "*", C.coerce_integer("raw").alias("value"),
        C.loses_fraction("raw").alias("loses_fraction"),
    )


@registered("""
    SELECT 'lost fraction' AS "check", 'lineitem' AS source, 'raw' AS related, COUNT(*) AS n
    FROM lineitem WHERE l_orderkey % 8 = 2
    UNION ALL
    SELECT 'lost fraction', 'asset_snapshot', c,
           CASE WHEN c = 'gameday_points' THEN (SELECT COUNT(*) FROM part WHERE p_partkey % 7 = 0)
                ELSE 0 END
    FROM (SELECT unnest(""" + str(V.ASSET_INTEGERS) + ") AS c)", views=False)
def dq_lost_fractions(league):
    """Fractions among texts that must hold whole numbers, counted before they are coerced."""
    return quality.lost_fractions({
        "lineitem": _raw(league).select("raw"),
        "asset_snapshot": documents.whole_number_texts(_part_feed(league), "asset_snapshot"),
    })


@registered(f"""SELECT l_orderkey, l_linenumber, {RAW} AS raw,
    CASE WHEN l_orderkey % 8 = 2 THEN CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) + 0.7E0
         WHEN l_orderkey % 8 IN (3, 4, 7) THEN CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) END
         AS value FROM lineitem""", views=False)
def coerce_double(league):
    return _raw(league).select("*", C.coerce_double("raw").alias("value"))


@registered("""SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events""",
            views=False)
def parse_feed_timestamp(league):
    """Event times written in the feed's 12-hour form and read back as UTC seconds."""
    written = F.date_format(F.col("ts").cast("timestamp_ntz"), V.FEED_TIME_FORMAT)
    return league.table("events").select(
        "event_id", F.unix_seconds(C.feed_timestamp(written)).alias("seconds")
    )


@registered("SELECT p_partkey, concat(p_name, '+50%zz é') AS p_name FROM part", views=False)
def percent_decode_names(league):
    """Part names with encoded spaces, a plus, a broken sequence and an encoded two-byte letter."""
    encoded = F.concat(F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit("+50%zz%20%C3%A9"))
    return league.table("part").select(
        "p_partkey", C.percent_decode(encoded).alias("p_name")
    )


@registered("""SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1), '')
    AS BIGINT) AS number FROM pages""", views=False)
def extract_number_from_url(league):
    return league.table("pages").select(
        "page_id", C.number_in_url("url", "/[a-z]{2}/", "").alias("number")
    )
