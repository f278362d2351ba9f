"""The batch build: landed documents -> source tables -> checks -> marts -> published record.

A build is of one season. It first makes sure that every document of the season is there, then writes
everything below a folder of its own and checks it. Only then is one record published that names the
new parts beside those of the other seasons, see `sources.builds`. So a build that fails at any place
leaves all as it was, and a reader has one build or the next, never half of each.

A refresh builds what changed documents change: their races' sources, and the marts from the first
race that they bear on. What earlier races add up to comes out of the state after the race before.
"""

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane import schemas
from pitlane.functions.columns import coerce_integer
from pitlane.operators import prepare, quality
from pitlane.operators.joins import attach_small
from pitlane.plans import marts, names, profiles
from pitlane.sources import builds, csv_tables, documents
from pitlane.sources.builds import Published, Record, Table
from pitlane.sources.tables import drop_tables, stack, stage, stage_by, staging

#: Tables that have races but are small and published by season.
WHOLE = ["races", "loaded_races"]


def reference_tables(
    spark: SparkSession, folder: str, season: int | None = None,
) -> dict[str, DataFrame]:
    """The calendar and the chips, from CSV; of one season if given, the chips stamped with it."""
    races = csv_tables.scan(spark, f"{folder}/races_*.csv", schemas.RACES)
    chips = csv_tables.scan(spark, f"{folder}/chips_*.csv", schemas.CHIPS)
    if season is not None:
        races = races.filter(F.col("season") == season)
        chips = chips.withColumn("season", F.lit(season).cast("bigint"))
    return {"races": races, "chips": chips}


#: Missing documents that an error names; it gives the number of all.
NAMED = 20


@dataclass(frozen=True)
class Build:
    """What a build published, and the gaps of measures that may be absent."""

    published: Published
    optional_gaps: list[dict]

    @property
    def tables(self) -> dict[str, DataFrame]:
        return self.published.tables()


def missing_documents(
    landed: dict[str, DataFrame], races: DataFrame, season: int, as_of: date,
) -> DataFrame:
    """Documents that the season needs and that have not landed."""
    of_season = {name: df.filter(F.col("season") == season) for name, df in landed.items()}
    standings = of_season["league_standings"]
    board = standings.select("season", "race_number", F.explode("Value.leaderboard").alias("row"))
    return prepare.missing_documents(
        races.filter(F.col("season") == season), as_of, of_season["asset_snapshot"], standings,
        of_season["detailed_teams"],
        board.select("season", "race_number", F.col("row.user_guid").alias("user_guid"),
                     coerce_integer("row.team_no").alias("team_no")).distinct(),
    )


def require_documents(
    landed: dict[str, DataFrame], races: DataFrame, season: int, as_of: date,
    only: Iterable[int] | None = None,
) -> None:
    """Raise if a document of the season, or of some races, is absent, naming the first ones."""
    missing = missing_documents(landed, races, season, as_of)
    if only is not None:
        missing = missing.filter(F.col("race_number").isin(list(only)))
    absent = stage(missing, "missing")
    count = absent.count()
    if count:
        first = absent.orderBy("dataset", *V.TEAM_RACE_KEY).limit(NAMED).collect()
        raise quality.DataQualityError(
            f"{count} missing documents, such as {[tuple(row) for row in first]}")


def require_whole_numbers(landed: dict[str, DataFrame], season: int) -> None:
    """Raise if a field that must hold a whole number holds a fraction, with the counts."""
    texts = {
        name: documents.whole_number_texts(df.filter(F.col("season") == season), name)
        for name, df in landed.items()
    }
    # One row per declared field.
    found = quality.lost_fractions(texts).filter("n > 0").collect()
    if found:
        raise quality.DataQualityError(
            f"lost fractions (check, source, field, rows): {[tuple(row) for row in found]}")


def team_tables(
    landed: dict[str, DataFrame], season: int, retrieved_at: Column,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Standings, details, roster and team rows of the landed documents of one season.

    The parsed standings and details feed several tables each, so they are staged once.
    """
    board = stage(documents.team_race_with_roster(
        documents.leaderboard_records(landed["league_standings"], season, retrieved_at)
    ), "standings")
    wanted = prepare.team_keys(board).select("user_guid", "team_no", "race_number")
    details = stage(
        landed["detailed_teams"].join(wanted, ["user_guid", "team_no", "race_number"],
                                      "left_semi"), "details",
    )
    roster = prepare.enrich_roster(
        documents.roster_rows(board), documents.lineup_records(details, season)
    )
    team_race = prepare.enrich_team_race(
        board.drop("user_team"), documents.finance_records(details, season)
    )
    return board, details, documents.to_schema(
        roster.withColumn("asset_id", coerce_integer("asset_id")), schemas.TEAM_RACE_ASSET
    ), documents.to_schema(team_race, schemas.TEAM_RACE)


def _usage(details: DataFrame, latest: DataFrame, season: int) -> DataFrame:
    return documents.to_schema(
        documents.chip_usage(details, latest, season), schemas.TEAM_CHIP_USAGE)


def source_tables(
    landed: dict[str, DataFrame], reference: dict[str, DataFrame], season: int, as_of: date,
    retrieved_at: Column,
) -> dict[str, DataFrame]:
    """Typed and enriched source tables of one season from its landed documents."""
    calendar = reference["races"].filter(F.col("season") == season)
    landed = {name: df.filter(F.col("season") == season).drop("season")
              for name, df in landed.items()}
    done = prepare.completed_races(calendar, as_of).select("race_number")
    feeds = prepare.price_feed_coverage(calendar, as_of).select("race_number")
    wanted = landed | {
        "asset_snapshot": attach_small(landed["asset_snapshot"], feeds, ["race_number"], "left_semi"),
        "league_standings": attach_small(
            landed["league_standings"], done, ["race_number"], "left_semi"),
    }
    board, details, roster, team_race = team_tables(wanted, season, retrieved_at)
    return {
        "asset_race": documents.asset_race(wanted["asset_snapshot"], season, retrieved_at),
        "team_race": team_race,
        "team_race_asset": roster,
        "team_chip_usage": _usage(details, prepare.latest_snapshots(board).drop("season"), season),
        **reference,
    }


# --- writing ------------------------------------------------------------------------------------

class _Writer:
    """Writes the tables of a build of one season and keeps the record that it would make."""

    def __init__(self, spark: SparkSession, out: str, build_id: str, season: int):
        self.spark, self.season = spark, season
        self.start = self.record = builds.latest_record(spark, out)
        self.folder = f"{out}/{build_id}/{season}"
        self.made: dict[str, Table] = {}
        self.races: dict[str, set[int]] = {}
        self.found: dict[str, dict] = {}
        if any(f.startswith(f"{self.folder}/") for f in self.start.folders()):
            raise ValueError(f"build {build_id} of season {season} is published already")

    def write(
        self, name: str, df: DataFrame, races: Iterable[int] | None = None,
        measures: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Write a table of the season, or its rows of some races only, and read what was written.

        The values of `measures`, aggregates that the write takes, are in `found` then.
        """
        by = ["season"] if name in WHOLE else builds.by_of(df.columns)
        read, self.made[name], self.found[name] = builds.measured(
            df, f"{self.folder}/{name}", by, self.season, measures or {})
        if races is not None:
            self.races[name] = set(races)
        self.record = self._applied(self.start, {})
        return read

    def _applied(self, before: Record, notes: dict) -> Record:
        return before.with_parts(self.made, self.season, notes, self.races)

    def now(self, name: str, races: Iterable[int] | None = None) -> DataFrame:
        """A table of the season as it will be published."""
        return Published(self.spark, self.record).table(name, self.season, races)

    def loaded(self, name: str) -> list[int]:
        return self.record.races(name, self.season)

    def race_frame(self, races: Iterable[int]) -> DataFrame:
        return self.spark.createDataFrame(
            [(self.season, race) for race in races], "season BIGINT, race_number BIGINT")

    def changed(self, before: Record, notes: dict, rows: bool) -> Record:
        """The record to publish; it raises if it would lose what is published."""
        after = self._applied(before, notes)
        # A corrected race may bring no name any more that is new.
        builds.require_no_loss(before, after, rows, [*V.MAY_BE_EMPTY, "team_names"])
        return after


def _season_marts(writer: _Writer, as_of: date) -> None:
    """Write all marts of a season from its sources."""
    now, races = writer.now, writer.now("races")
    writer.write("mart_asset_value_changes_by_race", marts.asset_value_changes(now("asset_race")))
    writer.write("mart_assets_latest", marts.assets_latest(now("asset_race"), races, as_of))
    values = marts.roster_values(now("team_race_asset"), now("asset_race"), now("team_chip_usage"))
    # All that is by team comes out of these buckets without a shuffle by team.
    metrics = stage_by(marts.team_metrics(now("team_race"), values, races), "team_metrics", V.TEAM_KEY)
    usage = stage_by(now("team_chip_usage"), "usage_by_team", V.TEAM_KEY)
    mart = marts.team_race_mart(metrics, races, stage(marts.league_averages(metrics), "averages"))
    writer.write("mart_team_race", mart)
    loaded = writer.race_frame(writer.loaded("mart_team_race"))
    writer.write("team_state", marts.team_state(metrics, loaded))
    writer.write("mart_team_chips", marts.team_chips(metrics, usage, now("chips"), races, mart))
    writer.write("profile_team_race", profiles.profile(now("team_race")))
    writer.write("team_names", names.index(names.first_names(now("team_race"))))
    _latest_marts(writer)


def _latest_marts(writer: _Writer) -> None:
    """Write what comes of the last race alone, and the loaded races."""
    last = writer.loaded("team_race_asset")[-1:]
    writer.write("mart_team_assets_latest", marts.team_assets_latest(
        writer.now("team_race_asset", last), writer.now("team_race", last),
        writer.now("mart_assets_latest"), writer.now("races"), writer.race_frame(last)))
    writer.write("loaded_races", writer.race_frame(writer.loaded("mart_team_race")))


def _checked(writer: _Writer, source: dict[str, DataFrame]) -> DataFrame:
    """Write the sources, which counts the rules on single rows, and check them; gives the gaps.

    Rows that break a rule are kept beside the tables, in a folder that the error names.
    """
    def keep(rows: DataFrame) -> str:
        folder = f"{writer.folder}/violations"
        rows.write.mode("overwrite").parquet(folder)
        return folder

    quality.require_schemas(source)
    written = {name: writer.write(name, df, None, quality.measures(name))
               for name, df in source.items()}
    return quality.raise_on_counted(
        written, quality.counted_by_write(writer.spark, writer.found), keep)


def _notes(build_id: str, as_of: date, versions: dict | None) -> dict:
    return {"build": build_id, "as_of": as_of.isoformat(), "versions": versions or {}}


# --- builds -------------------------------------------------------------------------------------

def build(
    spark: SparkSession, landed: dict[str, DataFrame], reference_folder: str, out: str,
    season: int, as_of: date, build_id: str, retrieved_at: Column | None = None,
    versions: dict | None = None,
) -> Build:
    """Run the whole build of a season and publish it. What it staged is removed at the end.

    Other seasons stay as they are, in every table. Rows of a season may change and races may be
    added; a race that is published and would go raises `LostRowsError`. `versions` are those of the
    landed documents, for later refreshes.
    """
    with staging(spark):
        reference = reference_tables(spark, reference_folder, season)
        require_documents(landed, reference["races"], season, as_of)
        require_whole_numbers(landed, season)
        writer = _Writer(spark, out, build_id, season)
        source = source_tables(
            landed, reference, season, as_of,
            F.current_timestamp() if retrieved_at is None else retrieved_at)
        gaps = _checked(writer, source)
        # One row per optional measure.
        found = [row.asDict() for row in gaps.filter("n > 0").collect()]
        _season_marts(writer, as_of)
        notes = _notes(build_id, as_of, versions)
        done = builds.publish(spark, out, lambda before: writer.changed(before, notes, False))
        drop_tables(spark, V.RETIRED_MARTS)
    return Build(done, found)


def rebuild_marts(spark: SparkSession, out: str, as_of: date, build_id: str) -> Published:
    """Build the marts of all published seasons again, season by season, and publish them at once.

    A season, race or row that is published and would go raises `LostRowsError`.
    """
    start = builds.latest_record(spark, out)
    absent = [name for name in V.KEYS if name not in start.tables]
    if absent:
        raise quality.DataQualityError(f"missing tables: {absent}")
    writers = []
    with staging(spark):
        for season in start.seasons():
            writers.append(_Writer(spark, out, build_id, season))
            _season_marts(writers[-1], as_of)

        def change(before: Record) -> Record:
            after = before
            for w in writers:
                require_unchanged(start, before, w.season)
                notes = before.notes.get(w.season, {})
                after = w.changed(after, notes | {"build": build_id, "as_of": as_of.isoformat()}, True)
            return after

        done = builds.publish(spark, out, change)
        drop_tables(spark, V.RETIRED_MARTS)
    return done


def require_unchanged(start: Record, before: Record, season: int) -> None:
    """Raise if a season was published anew since work on it began."""
    def parts(record: Record) -> dict:
        return {(name, place): part for name, t in record.tables.items()
                for place, part in t.parts.items() if place[0] == season}

    if parts(start) != parts(before):
        raise RuntimeError(f"season {season} was published by another build meanwhile")


# --- refresh ------------------------------------------------------------------------------------

def changed_races(published: Published, season: int, versions: dict) -> list[int]:
    """Races of which a document landed, changed or went since the season's last build."""
    known = published.record.notes.get(season, {}).get("versions", {})
    return sorted({
        int(race) for dataset in {*known, *versions}
        for race in {*known.get(dataset, {}), *versions.get(dataset, {})}
        if known.get(dataset, {}).get(race) != versions.get(dataset, {}).get(race)})


def _require_same_reference(writer: _Writer, reference: dict[str, DataFrame]) -> None:
    for name, df in reference.items():
        old = writer.now(name)
        if not df.exceptAll(old.select(*df.columns)).isEmpty() or not old.select(
                *df.columns).exceptAll(df).isEmpty():
            raise ValueError(f"{name} changed: the season needs a whole build")


def _latest_races(later: DataFrame, state: DataFrame) -> DataFrame:
    """The last race in which each team stands: TEAM_KEY, race_number."""
    return prepare.latest_snapshots(
        later.select(*V.TEAM_RACE_KEY).unionByName(
            state.select(*V.TEAM_KEY, F.col("last_race").alias("race_number"))))


def _refreshed_usage(
    writer: _Writer, landed: DataFrame, latest: DataFrame, changed: list[int],
) -> DataFrame:
    """Chip use of all teams: from documents where a team's latest one changed, else as it was."""
    old = writer.start
    was = Published(writer.spark, old).table(
        "team_state", writer.season, old.races("team_state", writer.season)[-1:]
    ).select(*V.TEAM_KEY, F.col("last_race").alias("__was"))
    stays = F.coalesce(F.col("race_number") == F.col("__was"), F.lit(False)) & ~F.col(
        "race_number").isin(changed)
    teams = stage(latest.join(was, V.TEAM_KEY, "left").withColumn("__stays", stays), "latest")
    other = teams.filter(~F.col("__stays")).drop("__was", "__stays")
    # Races, at most those of the season.
    needed = [r.race_number for r in other.select("race_number").distinct().collect()]
    read = _usage(landed.filter(F.col("race_number").isin(needed)), other.drop("season"),
                  writer.season)
    kept = writer.now("team_chip_usage").join(
        teams.filter("__stays").select(*V.TEAM_KEY), V.TEAM_KEY, "left_semi")
    return read.unionByName(kept.select(*read.columns))


def refresh(
    spark: SparkSession, landed: dict[str, DataFrame], reference_folder: str, out: str,
    season: int, as_of: date, build_id: str, changed: Iterable[int],
    retrieved_at: Column | None = None, versions: dict | None = None,
) -> Build:
    """Bring a published season up to date with documents of `changed` races and newly due ones.

    The result equals a build of the whole season, but for the times of retrieval of rows that did
    not change. Documents of other races are read only where a team fell back to an earlier latest
    document. Of the marts, races from the first that a change bears on are written anew: a changed
    race, or one for which the use of the chip that takes a roster out of valuation changed.
    The calendar and the chips have to be those of the last build. If the season is published by
    another run meanwhile, this one raises and publishes nothing.
    """
    with staging(spark):
        writer = _Writer(spark, out, build_id, season)
        if season not in writer.start.seasons():
            raise ValueError(f"season {season} has no build to refresh")
        reference = reference_tables(spark, reference_folder, season)
        _require_same_reference(writer, reference)
        calendar = writer.now("races")
        # Race numbers of one season.
        done = [r.race_number for r in prepare.completed_races(calendar, as_of).collect()]
        feeds = [r.race_number for r in prepare.price_feed_coverage(calendar, as_of).collect()]
        due = {*changed, *(set(done) - set(writer.loaded("team_race"))),
               *(set(feeds) - set(writer.loaded("asset_race")))}
        prices, teams = sorted(due & set(feeds)), sorted(due & set(done))
        gaps = []
        if prices or teams:
            gaps = _refreshed(writer, landed, as_of, prices, teams, max(done, default=0),
                              F.current_timestamp() if retrieved_at is None else retrieved_at)
        notes = _notes(build_id, as_of, versions)

        def change(before: Record) -> Record:
            require_unchanged(writer.start, before, season)
            return writer.changed(before, notes, False)

        return Build(builds.publish(spark, out, change), gaps)


def _refreshed(
    writer: _Writer, landed: dict[str, DataFrame], as_of: date, prices: list[int],
    teams: list[int], last_done: int, retrieved_at: Column,
) -> list[dict]:
    """Write what changed documents of these races change; gives the optional gaps."""
    season, now, races = writer.season, writer.now, writer.now("races")
    of_season = {name: df.filter(F.col("season") == season) for name, df in landed.items()}
    read = {name: df.filter(F.col("race_number").isin(prices if name == "asset_snapshot" else teams))
            for name, df in of_season.items()}
    require_documents(read, races, season, as_of, [*prices, *teams])
    require_whole_numbers(read, season)
    read = {name: df.drop("season") for name, df in read.items()}

    # Sources of the changed races.
    writer.write("asset_race", documents.asset_race(read["asset_snapshot"], season, retrieved_at),
                 prices)
    affected: list[int] = []
    used: set[int] = set()
    if teams:
        _, _, roster, team_race = team_tables(read, season, retrieved_at)
        writer.write("team_race", team_race, teams)
        writer.write("team_race_asset", roster, teams)
        profiled = teams if "profile_team_race" in writer.start.tables else None
        writer.write("profile_team_race", profiles.profile(now("team_race", profiled)), profiled)
        _refresh_names(writer, teams[0])
        latest = _latest_races(now("team_race", _from(writer, teams[0])), _state(writer, teams[0]))
        before = stage(now("team_chip_usage"), "usage")
        usage = writer.write("team_chip_usage", _refreshed_usage(
            writer, of_season["detailed_teams"].drop("season"), latest, teams))
        key = [*V.TEAM_KEY, "chip_id", "race_used"]
        differing = usage.select(key).exceptAll(before.select(key)).unionByName(
            before.select(key).exceptAll(usage.select(key)))
        # Chips and races of one season.
        moved = differing.select("chip_id", "race_used").distinct().collect()
        used = {r.race_used for r in moved}
        unvalued = {r.race_used for r in moved if r.chip_id == V.LIMITLESS}
        affected = sorted({*teams, *unvalued} & set(writer.loaded("team_race")))

    # What changed, with the races that changed uses refer to. That every team of a use has a row is
    # so by the way uses are gathered; it would take all races to see here.
    last = writer.loaded("team_race")[-1:]
    checked = sorted({*(teams or last), *used})
    gaps = quality.raise_on_violation({
        "asset_race": now("asset_race", {*prices, *checked}), "team_race": now("team_race", checked),
        "team_race_asset": now("team_race_asset", teams or last),
        "team_chip_usage": now("team_chip_usage").filter(F.col("race_used").isin(checked)),
        "races": races, "chips": now("chips"),
    }, [r for r in V.RELATIONSHIPS if r[:2] != ("team_chip_usage", "team_race")])

    # Marts.
    writer.write("mart_asset_value_changes_by_race",
                 marts.asset_value_changes(now("asset_race", prices)), prices)
    newest = {*writer.loaded("asset_race")[-1:], last_done}
    writer.write("mart_assets_latest",
                 marts.assets_latest(now("asset_race", newest), races, as_of))
    if teams:
        _refreshed_marts(writer, affected, used)
    _latest_marts(writer)
    return [row.asDict() for row in gaps.filter("n > 0").collect()]


def _refresh_names(writer: _Writer, first: int) -> None:
    """Write the names that come first at a race or later ones; a build without an index gets all."""
    if "team_names" not in writer.start.tables:
        writer.write("team_names", names.index(names.first_names(writer.now("team_race"))))
        return
    held = writer.record.races("team_names", writer.season)
    known = names.names_in(writer.now("team_names", [race for race in held if race < first]))
    later = _from(writer, first)
    writer.write("team_names", names.index(names.first_names(
        writer.now("team_race", later), known)), {*later, *[r for r in held if r >= first]})


def _from(writer: _Writer, first: int) -> list[int]:
    return [race for race in writer.loaded("team_race") if race >= first]


def _state(writer: _Writer, first: int) -> DataFrame:
    """The state of all teams before a race; no rows if it is the first."""
    before = [race for race in writer.record.races("team_state", writer.season) if race < first]
    return writer.now("team_state", before[-1:])


def _refreshed_marts(writer: _Writer, affected: list[int], used: set[int]) -> None:
    """Write the team marts from the first affected race on, out of the state before it."""
    now, races, first = writer.now, writer.now("races"), affected[0]
    later = _from(writer, first)
    values = marts.roster_values(
        now("team_race_asset", affected), now("asset_race", affected), now("team_chip_usage"))
    rest = [race for race in later if race not in affected]
    old = now("mart_team_race", rest).select(*V.TEAM_RACE_KEY, "calculated_asset_value")
    carried = _state(writer, first)
    metrics = stage_by(marts.team_metrics(
        now("team_race", later), stack([values.select(*old.columns), old]), races, carried),
        "team_metrics", V.TEAM_KEY)
    replaced = {*later, *[r for r in writer.start.races("mart_team_race", writer.season) if r >= first]}
    writer.write("mart_team_race", marts.team_race_mart(
        metrics.filter(F.col("race_number") >= first), races), replaced)
    writer.write("team_state", marts.team_state(metrics, writer.race_frame(later)), replaced)

    # Scores of uses at earlier races, unless they are new, stand in the chip mart already.
    scored = sorted({*later, *used} & set(writer.loaded("mart_team_race")))
    score = [*V.TEAM_RACE_KEY, "race_points", "league_average_race_points"]
    known = now("mart_team_chips").filter(
        F.col("chip_race_points").isNotNull() & ~F.col("race_used").isin(scored)
    ).withColumnsRenamed({"race_used": "race_number", "chip_race_points": "race_points"})
    last = now("team_state", writer.loaded("team_state")[-1:])
    writer.write("mart_team_chips", marts.team_chips(
        last.select(*V.TEAM_KEY, F.col("last_race").alias("race_number"), "team_name"),
        now("team_chip_usage"), now("chips"), races,
        now("mart_team_race", scored).select(*score).unionByName(known.select(*score).distinct())))
