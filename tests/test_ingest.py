import json
import os
import random
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from conftest import (
    CHIP_FLAGS, TEAMS, asset_document, put, rows, standings_document, team_document, write_race,
    write_reference,
)
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane import schemas
from pitlane.functions import columns as C
from pitlane.operators import prepare, quality
from pitlane.operators.joins import CardinalityError, require_unique
from pitlane.plans import job, profiles
from pitlane.sources import builds, csv_tables, documents, tables
from pitlane.streaming import landing



def now():
    return F.lit("2026-03-09 10:00:00").cast("timestamp")



# --- scans --------------------------------------------------------------------------------------

def test_json_scan_reads_all_races_with_the_declared_schema(spark, raw):
    feeds = documents.scan(spark, "asset_snapshot", str(raw / "asset_snapshot"))
    assert rows(feeds, "race_number") == [(1,), (2,), (3,)]
    assert feeds.select("Data").schema["Data"].dataType == schemas.ASSET_FEED["Data"].dataType


def test_json_scan_keys_from_path(spark, raw):
    details = documents.scan(spark, "detailed_teams", str(raw / "detailed_teams"))
    expected = [(g, n, r) for g, n, _ in TEAMS for r in (1, 2)]
    assert rows(details, "user_guid", "team_no", "race_number") == sorted(expected)


def test_csv_scan_and_prefix_scan(spark, tmp_path):
    schema = "season BIGINT, race_number BIGINT, user_guid STRING"
    schema = spark.createDataFrame([], schema).schema
    for name, guid in [("team_race_1", "a"), ("team_race_2", "b"), ("team_race_asset_1", "no"),
                       ("team_race_1b", "no")]:
        (tmp_path / f"{name}.csv").write_text(f"season,race_number,user_guid\n2026,1,{guid}\n")
    folder = str(tmp_path)
    found = csv_tables.scan_prefix(spark, folder, "team_race_", schema)
    assert rows(found, "user_guid") == [("a",), ("b",)]
    assert csv_tables.scan_prefix(spark, folder, "asset_race_", schema) is None
    assert csv_tables.scan(spark, folder + "/team_race_1.csv", schema).dtypes[0] == (
        "season", "bigint")


def test_csv_scan_refuses_another_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("season,wrong\n1,2\n")
    schema = spark.createDataFrame([], "season BIGINT, race_number BIGINT").schema
    with pytest.raises(Exception, match="header"):
        csv_tables.scan(spark, str(tmp_path / "x.csv"), schema).collect()


# --- writes -------------------------------------------------------------------------------------

def test_bronze_write_has_no_personal_fields(spark, raw, tmp_path):
    for dataset, secret in [("league_standings", "user_name"), ("detailed_teams", "socialId")]:
        found = documents.without_personal_fields(
            documents.scan(spark, dataset, str(raw / dataset)), dataset
        )
        path = str(tmp_path / dataset)
        tables.overwrite_partitions(found.withColumn("season", F.lit(2026)), path,
                                    ["season", "race_number"])
        back = spark.read.parquet(path)
        assert secret not in back.schema.json()
        assert back.count() == found.count()
        assert not back.select(F.to_json(F.struct("*")).alias("j")).filter(
            "j LIKE '%4711%' OR j LIKE '%secret%'").count()


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "season INT, race INT, v STRING")
    tables.overwrite_partitions(first, path, ["season", "race"])
    again = spark.createDataFrame([(1, 2, "new")], "season INT, race INT, v STRING")
    tables.overwrite_partitions(again, path, ["season", "race"])
    tables.overwrite_partitions(again, path, ["season", "race"])
    assert rows(spark.read.parquet(path), "race", "v") == [(1, "a"), (2, "new")]


def test_table_replace_reports_rows_and_keeps_the_table_without_files(spark):
    assert tables.replace_table(spark.range(5), "replaced") == 5
    assert tables.replace_table(spark.range(3), "replaced") == 3
    assert tables.replace_table(None, "replaced") is None
    assert spark.table("replaced").count() == 3
    tables.drop_tables(spark, ["replaced", "never_there"])
    assert not spark.catalog.tableExists("replaced")


def test_shared_dir_is_the_one_the_session_names(spark):
    assert tables.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stack_aligns_by_name_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, v STRING")
    b = spark.createDataFrame([("x", 1)], "v STRING, id INT")
    c = spark.createDataFrame([(2,)], "id INT")
    assert rows(tables.stack([a, b, c])) == [(1, "x"), (1, "x"), (2, None)]
    assert tables.stack([]) is None


# --- asset feed ---------------------------------------------------------------------------------

def test_flatten_asset_feed(spark, raw):
    feeds = documents.scan(spark, "asset_snapshot", str(raw / "asset_snapshot"))
    assets = documents.asset_race(feeds, 2026, now())
    assert assets.dtypes == spark.createDataFrame([], schemas.ASSET_RACE).dtypes
    one = assets.filter("race_number = 2 AND asset_id = 8").first().asDict()
    assert (one["value"], one["old_asset_value"], one["gameday_points"]) == (18.2, 18.0, 16)
    assert (one["asset_type"], one["team_id"], one["qualifying_points"]) == (
        "CONSTRUCTOR", None, None)
    assert (one["fastest_lap_points"], one["value_for_money"]) == (10.0, 0.5)
    assert json.loads(one["all_session_points"]) == [{"sessiontype": "Race", "points": 3}]
    seconds = assets.filter("race_number = 2 AND asset_id = 8").select(
        F.unix_seconds("feed_time_utc")).first()[0]
    assert seconds == datetime(2026, 3, 2, 17, 4, 9, tzinfo=timezone.utc).timestamp()
    assert assets.count() == 27


def test_flatten_leaderboard_decodes_and_types(spark, raw):
    found = documents.scan(spark, "league_standings", str(raw / "league_standings"))
    board = documents.team_race_with_roster(documents.leaderboard_records(found, 2026, now()))
    assert board.columns == documents.STANDINGS_SELECTED
    names = rows(board.filter("race_number = 1"), "user_guid", "team_no", "team_name",
                 "race_rank", "race_points")
    assert names == [("ann", 1, "Ann One", 1, 101.0), ("bob", 1, "Bob+50%zz", 2, 91.0),
                     ("cat", 2, "Cat é", 3, 81.0)]


def test_empty_roster_keeps_a_null_row(spark):
    teams = spark.createDataFrame(
        [(2026, 1, "a", 1, "A", ["3", "3"]), (2026, 1, "b", 1, "B", [])],
        "season BIGINT, race_number BIGINT, user_guid STRING, team_no BIGINT, team_name STRING,"
        "user_team ARRAY<STRING>")
    assert rows(documents.roster_rows(teams), "user_guid", "asset_id") == [
        ("a", "3"), ("a", "3"), ("b", None)]


# --- team details -------------------------------------------------------------------------------

def details_of(spark, raw):
    return documents.scan(spark, "detailed_teams", str(raw / "detailed_teams"))


def test_roster_structs(spark, raw):
    lineups = documents.lineup_records(details_of(spark, raw), 2026)
    ann = lineups.filter("user_guid = 'ann' AND race_number = 1")
    assert ann.count() == 8
    assert rows(ann.filter("is_final > 0"), "player_position", "is_final") == [(7, 2), (8, 1)]
    assert rows(ann.filter("is_captain = 1"), "player_position") == [(1,)]


def test_detail_document_without_a_team_raises(spark, tmp_path):
    put(tmp_path, "x_team_1_race_1.json", {"Data": {"Value": {"mdid": 1, "userTeam": []}}})
    found = documents.scan(spark, "detailed_teams", str(tmp_path))
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        documents.first_team(found).collect()


def test_team_finance_record_keeps_missing_money_null(spark, raw):
    money = documents.finance_records(details_of(spark, raw), 2026)
    assert dict(money.dtypes)["recorded_asset_value"] == "double"
    assert rows(money.filter("race_number = 1"), "user_guid", "recorded_asset_value",
                "remaining_budget", "recorded_total_budget") == [
        ("ann", 99.0, 2.5, 101.5), ("bob", None, 2.5, 101.5), ("cat", 99.0, 2.5, 101.5)]


def test_strict_cast_raises_on_junk_money(spark, tmp_path):
    document = team_document(TEAMS[0], 1)
    document["Data"]["Value"]["userTeam"][0]["teamval"] = "lots"
    put(tmp_path, "ann_team_1_race_1.json", document)
    found = documents.scan(spark, "detailed_teams", str(tmp_path))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        documents.finance_records(found, 2026).collect()


def test_chip_usage_reads_only_the_latest_document(spark, raw):
    latest = spark.createDataFrame([("ann", 1, 2), ("bob", 1, 2), ("cat", 2, 2)],
                                   "user_guid STRING, team_no BIGINT, race_number BIGINT")
    usage = documents.chip_usage(details_of(spark, raw), latest, 2026)
    assert rows(usage) == [
        (2026, "ann", 1, "Ann One", 3, 1), (2026, "ann", 1, "Ann One", 6, 9),
        (2026, "bob", 1, "Bob+50%zz", 1, 2)]


# --- values -------------------------------------------------------------------------------------

def test_coercion(spark):
    texts = ["12", "12.0", "12.7", "", "x", None, " 7 ", "-3", "1e3", "12d", "NaN",
             "9007199254740993"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        "t", C.coerce_integer("t").alias("i"), C.coerce_double("t").alias("d"),
        C.loses_fraction("t").alias("lost"))
    got = {r.t: (r.i, r.d, r.lost) for r in df.collect()}
    assert got["12"] == got["12.0"] == (12, 12.0, False)
    assert got["12.7"] == (None, 12.7, True)
    for junk in ("", "x", None, "12d", "NaN"):
        assert got[junk] == (None, None, False)
    assert got[" 7 "][0] == 7 and got["-3"][0] == -3 and got["1e3"][0] == 1000
    assert got["9007199254740993"][0] == 9007199254740993


def test_percent_decode(spark):
    cases = {"a%20b": "a b", "a+b": "a+b", "50%zz%20a": "50%zz a", "100%": "100%",
             "%C3%A9": "é", "%25": "%", None: None}
    df = spark.createDataFrame([(c,) for c in cases], "t STRING")
    got = {r.t: r.x for r in df.select("t", C.percent_decode("t").alias("x")).collect()}
    assert got == cases


def test_feed_timestamp_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("3/8/2026 5:04:09 PM",), ("03/08/2026 05:04:09 AM",)],
                                   "t STRING")
        got = [r[0] for r in df.select(F.unix_seconds(C.feed_timestamp("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    day = datetime(2026, 3, 8, tzinfo=timezone.utc)
    assert got == [day.replace(hour=h, minute=4, second=9).timestamp() for h in (17, 5)]


def test_feed_timestamp_raises_on_another_format(spark):
    df = spark.createDataFrame([("2026-03-08",)], "t STRING")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(C.feed_timestamp("t")).collect()


# --- enrichment ---------------------------------------------------------------------------------

def test_guard_raises_on_duplicate_and_unmatched_details(spark, raw):
    details = documents.finance_records(details_of(spark, raw), 2026)
    teams = details.select("season", "race_number", "user_guid", "team_no")
    assert prepare.enrich_team_race(teams, details).count() == 6
    with pytest.raises(Exception, match="team details: duplicate keys"):
        prepare.enrich_team_race(teams, details.union(details)).count()
    with pytest.raises(Exception, match="team details: duplicate keys"):
        prepare.enrich_team_race(teams.union(teams), details).count()
    with pytest.raises(Exception, match="team details: rows without details"):
        prepare.enrich_team_race(teams, details.filter("user_guid != 'cat'")).count()
    # Details of a team that is not in the standings are left out, as in any left join.
    some = teams.filter("user_guid != 'cat'")
    assert prepare.enrich_team_race(some, details).count() == 4


def test_require_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k INT")
    with pytest.raises(CardinalityError):
        require_unique(df, ["k"], "chip usage")
    assert require_unique(df.distinct(), ["k"], "chip usage").count() == 2


def test_enrichment_idempotent(spark, raw):
    details = documents.finance_records(details_of(spark, raw), 2026)
    teams = details.select("season", "race_number", "user_guid", "team_no")
    once = prepare.enrich_team_race(teams, details)
    assert rows(prepare.enrich_team_race(once, details)) == rows(once)
    assert once.count() == teams.count()


def test_coverage(spark, raw):
    calendar = job.reference_tables(spark, str(raw / "reference"))["races"]
    assert rows(prepare.completed_races(calendar, date(2026, 2, 8)), "race_number") == [(1,)]
    assert rows(prepare.price_feed_coverage(calendar, date(2026, 2, 9))) == [
        (2026, 1), (2026, 2), (2026, 3)]


# --- landing ------------------------------------------------------------------------------------

def run(spark, dataset, raw, out, season=2026):
    landing.land(spark, dataset, str(raw / dataset), str(out / "bronze"),
                 str(out / "marks"), season).awaitTermination()


def test_landing_stream_lands_each_document_once(spark, raw, tmp_path):
    out = tmp_path / "out"
    run(spark, "league_standings", raw, out)
    landed = landing.read_bronze(spark, "league_standings", str(out / "bronze"))
    assert rows(landed, "race_number") == [(1,), (2,)]
    assert "user_name" not in landed.schema.json()
    # A second run finds nothing new.
    run(spark, "league_standings", raw, out)
    assert landing.read_bronze(spark, "league_standings", str(out / "bronze")).count() == 2
    # A new race lands; of a race that arrives again, the newest file counts.
    put(raw / "league_standings", "league_standings_race_3.json", standings_document(3))
    put(raw / "league_standings" / "again", "league_standings_race_1.json",
        standings_document(1, TEAMS[:1]))
    old = raw / "league_standings" / "old"
    put(old, "league_standings_race_2.json", standings_document(2, TEAMS[:2]))
    os.utime(old / "league_standings_race_2.json", (1_000_000_000, 1_000_000_000))
    run(spark, "league_standings", raw, out)
    landed = landing.read_bronze(spark, "league_standings", str(out / "bronze"))
    assert rows(landed, "race_number", F.size("Value.leaderboard")) == [(1, 1), (2, 3), (3, 3)]
    every = landing.read_all(spark, "league_standings", str(out / "bronze"))
    assert every.count() == 5 and set(every.columns) >= {"season", "race_number", "batch", "path"}


def test_compaction_leaves_one_batch_per_race_and_the_same_documents(spark, raw, tmp_path, monkeypatch):
    r = random.Random(2)
    bronze = str(tmp_path / "bronze")
    for n in range(4):
        for race in (1, 2):
            put(raw / "league_standings" / f"v{n}", f"league_standings_race_{race}.json",
                standings_document(race, TEAMS[:r.randint(1, 3)]))
        landing.land(spark, "league_standings", str(raw / "league_standings"), bronze,
                     str(tmp_path / "marks"), 2026, files_per_batch=1).awaitTermination()

    def folders():
        return sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "bronze").glob("*/season=2026/*/*"))

    def documents_now():
        return rows(landing.read_bronze(spark, "league_standings", bronze, 2026), "race_number",
                    F.to_json("Value"))

    before = documents_now()
    assert len(folders()) == 10 and len(before) == 2
    # Cut short after the write: both copies are there, and each document counts once.
    with monkeypatch.context() as patched:
        patched.setattr(landing, "delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            landing.compact(spark, "league_standings", bronze, 2026)
    assert len(folders()) == 12 and documents_now() == before
    assert landing.compact(spark, "league_standings", bronze, 2026) == 2
    assert len(folders()) == 2 and documents_now() == before
    assert landing.compact(spark, "league_standings", bronze, 2026) == 0
    # What lands later still replaces what was compacted.
    put(raw / "league_standings" / "late", "league_standings_race_1.json", standings_document(1, TEAMS[:1]))
    run(spark, "league_standings", raw, tmp_path)
    assert rows(landing.read_bronze(spark, "league_standings", bronze, 2026), "race_number",
                F.size("Value.leaderboard"))[0] == (1, 1)
    assert landing.compact(spark, "league_standings", bronze, 2026) == 1
    assert len(folders()) == 2


def cut(path, length):
    path.write_text(path.read_text()[:length])


def test_a_damaged_document_is_set_aside_and_its_correction_lands(spark, raw, tmp_path):
    feeds = raw / "asset_snapshot"
    cut(feeds / "asset_snapshot_race_2.json", 400)
    put(feeds, "asset_snapshot_race_7.json", {"Data": {"Value": []}})
    put(feeds, "asset_snapshot_latest.json", asset_document(1))
    run(spark, "asset_snapshot", raw, tmp_path)
    bronze = str(tmp_path / "bronze")
    landed = landing.read_bronze(spark, "asset_snapshot", bronze, 2026)
    assert rows(landed, "race_number") == [(1,), (3,)]
    rejects = landing.read_rejects(spark, "asset_snapshot", bronze)
    found = {r.path.rsplit("/", 1)[1]: r.reason for r in rejects.collect()}
    assert found == {"asset_snapshot_race_2.json": "unreadable",
                     "asset_snapshot_race_7.json": "no records",
                     "asset_snapshot_latest.json": "no key in the name"}
    put(feeds / "corrected", "asset_snapshot_race_2.json", asset_document(2))
    run(spark, "asset_snapshot", raw, tmp_path)
    landed = landing.read_bronze(spark, "asset_snapshot", bronze, 2026)
    assert rows(landed, "race_number", F.size("Data.Value")) == [(1, 9), (2, 9), (3, 9)]


def test_landed_documents_equal_a_batch_scan(spark, raw, tmp_path):
    run(spark, "detailed_teams", raw, tmp_path)
    landed = landing.read_bronze(spark, "detailed_teams", str(tmp_path / "bronze"))
    batch = documents.without_personal_fields(details_of(spark, raw), "detailed_teams")
    assert rows(documents.lineup_records(landed, 2026)) == rows(
        documents.lineup_records(batch, 2026))


# --- the whole job ------------------------------------------------------------------------------

def land_all(spark, raw, out, season=2026):
    for dataset in documents.SCHEMAS:
        run(spark, dataset, raw, out, season)
    return {d: landing.read_bronze(spark, d, str(out / "bronze")) for d in documents.SCHEMAS}


def test_end_to_end_build_and_mart_refresh(spark, raw, tmp_path):
    out = tmp_path / "out"
    write_race(raw, 5)  # not completed yet: must not be read
    landed = land_all(spark, raw, out)
    spark.sql("CREATE TABLE mart_team_values_latest (x INT) USING parquet")
    staged = Path(tables.shared_dir(spark)) / spark.sparkContext.applicationId
    before = sorted(staged.glob("*"))
    built = job.build(
        spark, landed, str(raw / "reference"), str(out), 2026, date(2026, 3, 1), "b1", now())
    assert {(g["source"], g["related"]): g["n"] for g in built.optional_gaps} == {
        ("team_race", "recorded_asset_value"): 2}
    assert sorted(staged.glob("*")) == before
    assert not spark.catalog.tableExists("mart_team_values_latest")
    assert built.tables["asset_race"].count() == 27
    mart = built.tables["mart_team_race"]
    assert mart.schema["season"].dataType.simpleString() == "bigint"
    got = {(r.user_guid, r.race_number): r for r in mart.collect()}
    assert len(got) == 6
    # Ann: recorded value; Bob: priced roster in race 1, Limitless in race 2.
    assert got["ann", 1].valuation_source == "recorded"
    ids = [(1 + 1 + k) % 9 + 1 for k in range(7)]
    assert got["bob", 1].calculated_asset_value == round(sum(10 + a + 0.1 for a in ids), 1)
    assert got["bob", 1].valuation_source == "calculated"
    assert got["bob", 2].valuation_source == "unavailable"
    assert got["bob", 2].total_wealth == 101.5
    assert got["ann", 2].cumulative_points == 101.0 + 102.0
    assert got["ann", 1].league_average_race_points == 91.0
    # The swap: the incoming asset is not priced, the outgoing one is.
    ann = [(0 + 1 + k) % 9 + 1 for k in range(7)]
    assert got["ann", 1].calculated_asset_value == round(sum(10 + a + 0.1 for a in ann), 1)
    chips = {(r.user_guid, r.chip_id): r.chip_status
             for r in built.tables["mart_team_chips"].collect()}
    assert len(chips) == 18
    assert (chips["ann", 3], chips["ann", 6], chips["bob", 1], chips["cat", 1]) == (
        "used", "upcoming", "used", "unused")
    latest = built.tables["mart_assets_latest"].filter("asset_id = 1").first()
    assert (latest.points_race_number, latest.price_feed_race_number) == (2, 3)
    # A refresh of the marts gives the same rows.
    before = {name: rows(df.drop("sketch")) for name, df in built.tables.items()}
    again = job.rebuild_marts(spark, str(out), date(2026, 3, 1), "b2")
    assert {name: rows(df.drop("sketch")) for name, df in again.tables().items()} == before
    assert set(before) == {*V.KEYS, *MARTS}
    # For SQL, a session names the tables of one record.
    again.as_views()
    assert spark.sql("SELECT count(*) FROM mart_team_race JOIN races USING (season, race_number)"
                     ).first()[0] == 6
    for name in again.names():
        spark.catalog.dropTempView(name)


def test_failed_build_publishes_nothing(spark, raw, tmp_path):
    broken = asset_document(2)
    broken["Data"]["Value"][0]["Value"] = "junk"
    put(raw / "asset_snapshot", "asset_snapshot_race_2.json", broken)
    landed = land_all(spark, raw, tmp_path)
    with pytest.raises(quality.DataQualityError, match="null measure"):
        job.build(spark, landed, str(raw / "reference"), str(tmp_path), 2026, date(2026, 3, 1),
                  "bad", now())
    assert builds.published(spark, str(tmp_path)).names() == []
    # The rows that broke a rule lie beside the tables of the failed build.
    listed = spark.read.parquet(str(tmp_path / "bad" / "2026" / "violations")).collect()
    assert [(r.source, json.loads(r.key)["race_number"], r.broken) for r in listed] == [
        ("asset_race", 2, "null measure value")]


def test_the_write_counts_what_a_scan_counts(spark, tmp_path):
    """Row rules from the write equal those of a scan, over tables with nulls and an empty one."""
    made = {}
    for i, name in enumerate(V.KEYS):
        columns = dict.fromkeys(
            ["season", *V.KEYS[name], *V.REQUIRED.get(name, []), *V.OPTIONAL.get(name, [])])
        made[name] = spark.range(0 if name == "team_chip_usage" else 60, numPartitions=4).select(*[
            F.lit(2026).cast("bigint").alias(c) if c == "season" else
            F.when(F.pmod(F.hash("id", F.lit(c)), F.lit(7)) != 0, F.col("id") % (3 + i)).alias(c)
            for c in columns])
    found, read = {}, {}
    for name, df in made.items():
        read[name], _, found[name] = builds.measured(
            df, str(tmp_path / name), ["season"], 2026, quality.measures(name))
    counted = quality.counted_by_write(spark, found)
    parts = [quality.row_counts(made), quality.null_keys(made), quality.null_measures(made),
             quality.optional_gaps(made)]
    assert rows(counted) == rows(tables.stack(parts))
    assert counted.filter("source = 'team_chip_usage' AND n > 0").count() == 0
    broken = quality.violating_rows(read)
    null_keys = {r["source"]: r["n"] for r in quality.null_keys(made).collect() if r["n"]}
    assert {r["source"]: r["count"] for r in broken.filter("broken LIKE '%null key%'").groupBy(
        "source").count().collect()} == null_keys


def test_files_are_sorted_though_the_season_is_a_constant(spark, tmp_path):
    df = spark.range(20_000).select(
        F.lit(2026).cast("bigint").alias("season"), (F.col("id") % 2).alias("race_number"),
        F.md5(F.col("id").cast("string")).alias("user_guid"))
    read, _ = builds.written(df, str(tmp_path / "t"), V.RACE_KEY, 2026)
    seen = [r.users for r in read.groupBy(F.input_file_name(), "race_number").agg(
        F.collect_list("user_guid").alias("users")).collect()]
    assert sum(map(len, seen)) == 20_000
    files = [p for p in (tmp_path / "t").rglob("*.parquet")]
    for path in files:
        users = [r.user_guid for r in spark.read.parquet(str(path)).coalesce(1).collect()]
        assert users == sorted(users)


def built(spark, raw, out, landed, season=2026, name="b1"):
    return job.build(spark, landed, str(raw / "reference"), str(out), season,
                     date(season, 3, 1), name, now())


def test_a_build_stops_when_a_document_is_absent(spark, raw, tmp_path):
    cut(raw / "league_standings" / "league_standings_race_2.json", 300)
    (raw / "asset_snapshot" / "asset_snapshot_race_3.json").unlink()
    (raw / "detailed_teams" / "cat_team_2_race_1.json").unlink()
    landed = land_all(spark, raw, tmp_path)
    with pytest.raises(quality.DataQualityError) as stopped:
        built(spark, raw, tmp_path, landed)
    said = str(stopped.value)
    assert said.startswith("3 missing documents")
    for part in ("('asset_snapshot', 2026, 3", "('league_standings', 2026, 2",
                 "('detailed_teams', 2026, 1, 'cat', 2)"):
        assert part in said
    assert builds.published(spark, str(tmp_path)).names() == []
    # The corrections alone are enough to go on.
    write_race(raw / "again", 2)
    for dataset in ("league_standings", "detailed_teams"):
        for file in (raw / "again" / dataset).iterdir():
            put(raw / dataset / "again", file.name, json.loads(file.read_text()))
    put(raw / "asset_snapshot", "asset_snapshot_race_3.json", asset_document(3))
    put(raw / "detailed_teams", "cat_team_2_race_1.json", team_document(TEAMS[2], 1))
    done = built(spark, raw, tmp_path, land_all(spark, raw, tmp_path))
    assert done.tables["mart_team_race"].count() == 6


MARTS = ["mart_asset_value_changes_by_race", "mart_assets_latest", "mart_team_assets_latest",
         "mart_team_race", "mart_team_chips", "team_state", "loaded_races", "profile_team_race",
         "team_names"]


def seasons(spark, out, name):
    found = builds.published(spark, str(out)).table(name).groupBy("season").count().collect()
    return {r.season: r["count"] for r in found}


def test_seasons_do_not_replace_each_other(spark, raw, tmp_path):
    # Each season has a calendar of its own, in a folder of its own.
    calendar = (raw / "reference" / "races_2026.csv").read_text()
    reference = raw / "next"
    write_reference(reference / "reference")
    (reference / "reference" / "races_2027.csv").write_text(calendar.replace("2026", "2027"))
    (reference / "reference" / "races_2026.csv").unlink()
    landed = land_all(spark, raw, tmp_path)
    built(spark, raw, tmp_path, landed, 2026, "first")
    write_race(raw / "next", 1)
    write_race(raw / "next", 2)
    put(raw / "next" / "asset_snapshot", "asset_snapshot_race_3.json", asset_document(3))
    landed = land_all(spark, raw / "next", tmp_path, 2027)
    assert rows(landed["league_standings"], "season", "race_number") == [
        (2026, 1), (2026, 2), (2027, 1), (2027, 2)]
    built(spark, reference, tmp_path, landed, 2027, "second")
    for name in [*V.KEYS, *MARTS]:
        assert set(seasons(spark, tmp_path, name)) == {2026, 2027}, name
    assert seasons(spark, tmp_path, "mart_team_race") == {2026: 6, 2027: 6}
    before = rows(builds.published(spark, str(tmp_path)).table("mart_team_chips", 2027))
    # A repeat of one season, with another result, leaves the other alone.
    put(raw / "league_standings" / "again", "league_standings_race_2.json",
        standings_document(2, TEAMS[:2]))
    landed = land_all(spark, raw, tmp_path)
    built(spark, raw, tmp_path, landed, 2026, "third")
    job.rebuild_marts(spark, str(tmp_path), date(2027, 3, 1), "fourth")
    assert seasons(spark, tmp_path, "mart_team_race") == {2026: 5, 2027: 6}
    assert seasons(spark, tmp_path, "races") == {2026: 9, 2027: 9}
    assert rows(builds.published(spark, str(tmp_path)).table("mart_team_chips", 2027)) == before


def test_a_rebuild_that_loses_rows_is_refused(spark, raw, tmp_path):
    landed = land_all(spark, raw, tmp_path)
    built(spark, raw, tmp_path, landed)
    before = builds.latest_record(spark, str(tmp_path))
    # The calendar of the published season loses a race.
    calendar = before.tables["races"]
    part = calendar.parts[2026, builds.NO_RACE]
    fewer = builds.read_table(spark, calendar).filter("race_number != 2")
    _, table = builds.written(fewer, str(tmp_path / "less"), ["season"], 2026)
    assert part.rows == 9

    def shorten(record):
        return record.with_parts({"races": table}, 2026, {})

    builds.publish(spark, str(tmp_path), shorten)
    with pytest.raises(builds.LostRowsError, match="mart_team_race"):
        job.rebuild_marts(spark, str(tmp_path), date(2026, 3, 1), "b2")
    assert seasons(spark, tmp_path, "mart_team_race") == {2026: 6}
    # So is a build whose calendar lacks a race that is published.
    lines = (raw / "reference" / "races_2026.csv").read_text().splitlines()
    (raw / "reference" / "races_2026.csv").write_text(
        "\n".join(line for line in lines if not line.startswith("2026,2,")) + "\n")
    with pytest.raises((builds.LostRowsError, quality.DataQualityError)):
        built(spark, raw, tmp_path, landed, name="b3")


def test_a_reader_keeps_one_build_and_a_failure_publishes_nothing(spark, raw, tmp_path, monkeypatch):
    landed = land_all(spark, raw, tmp_path)
    built(spark, raw, tmp_path, landed, name="first")
    reader = builds.published(spark, str(tmp_path))
    put(raw / "league_standings" / "again", "league_standings_race_2.json",
        standings_document(2, TEAMS[:2]))
    landed = land_all(spark, raw, tmp_path)

    def failing(*_):
        raise OSError("the store is gone")

    with monkeypatch.context() as patched:
        patched.setattr(builds, "_appears", failing)
        with pytest.raises(OSError, match="store"):
            builds.publish(spark, str(tmp_path), lambda record: record)
    assert builds.latest_record(spark, str(tmp_path)) == reader.record
    built(spark, raw, tmp_path, landed, name="third")
    counts = {name: (reader.table(name).count(), builds.published(spark, str(tmp_path)).table(name).count())
              for name in ("team_race", "mart_team_race", "mart_team_chips")}
    assert counts == {"team_race": (6, 5), "mart_team_race": (6, 5), "mart_team_chips": (18, 18)}
    with pytest.raises(ValueError, match="published already"):
        built(spark, raw, tmp_path, landed, name="third")
    # Old folders go when no reader holds them.
    gone = builds.remove_old(spark, str(tmp_path), keep=1)
    assert gone and all("/first/" in folder for folder in gone)
    assert builds.published(spark, str(tmp_path)).table("mart_team_race").count() == 5


def test_two_that_publish_at_once_keep_both_changes(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    made = {}
    for season in (1, 2):
        df = spark.range(3).select(F.lit(season).cast("bigint").alias("season"), "id")
        made[season] = builds.written(df, f"{out}/t{season}", ["season"], season)[1]
    other = []

    def change(record):
        if not other:
            other.append(builds.publish(spark, out, lambda r: r.with_parts({"t": made[2]}, 2, {})))
        return record.with_parts({"t": made[1]}, 1, {"build": "a"})

    done = builds.publish(spark, out, change)
    assert done.record.number == 2 and done.record.seasons() == [1, 2]
    assert builds.latest_record(spark, out) == done.record
    assert builds.published(spark, out).table("t", 2).count() == 3


# --- refresh ------------------------------------------------------------------------------------

def write_season(raw, last, r, teams=TEAMS):
    """Races up to `last`, each with some of the teams and other scores."""
    for race in range(1, last + 1):
        write_race(raw, race)
        correct(raw, race, r, teams)
    put(raw / "asset_snapshot", f"asset_snapshot_race_{last + 1}.json", asset_document(last + 1))


def correct(raw, race, r, teams=TEAMS):
    """New standings, prices and details of a race, as later files."""
    there = [t for t in teams if r.random() < 0.8] or [teams[0]]
    board = standings_document(race, there)
    for row in board["Value"]["leaderboard"]:
        row["cur_points"] = r.randint(0, 300) / 4
    folder = f"v{r.random()}"
    put(raw / "league_standings" / folder, f"league_standings_race_{race}.json", board)
    prices = asset_document(race)
    for asset in prices["Data"]["Value"]:
        asset["Value"] = str(r.randint(50, 300) / 10)
    put(raw / "asset_snapshot" / folder, f"asset_snapshot_race_{race}.json", prices)
    for team in there:
        document = team_document(team, race)
        own = document["Data"]["Value"]["userTeam"][0]
        own["teambal"] = r.randint(0, 50) / 10
        if r.random() < 0.6:
            own.pop("teamval", None)
        if r.random() < 0.5:
            own["maxteambal"] = None
        # Uses at races where the team may or may not stand, and at races to come.
        stood = [n for n in range(1, race + 1)]
        for chip, (flag, at) in V.CHIP_FIELDS.items():
            own[flag], own[at] = 0, None
            if chip in (2, 4) and r.random() < 0.5:
                own[flag], own[at] = chip, 9
        if r.random() < 0.7:
            own["islimitlesstaken"], own["limitlesstakengd"] = 1, race
        own["playerid"] = [p for p in own["playerid"] if p["isfinal"] != 1]
        for row in board["Value"]["leaderboard"]:
            if row["user_guid"] == team[0]:
                row["user_team"] = [p["id"] for p in own["playerid"]]
        put(raw / "detailed_teams" / folder, f"{team[0]}_team_{team[1]}_race_{race}.json", document)
    put(raw / "league_standings" / folder, f"league_standings_race_{race}.json", board)


def everything(published):
    # Sketches of equal values may differ in their bytes; what they say is compared by itself.
    dropped = ("retrieved_at_utc", "sketch")
    return {name: rows(df.drop(*dropped)) for name, df in published.tables().items()}


def test_a_refresh_equals_a_whole_build(spark, raw, tmp_path, monkeypatch):
    r = random.Random(11)
    out = tmp_path / "out"
    write_season(raw, 5, r)
    reference, live = str(raw / "reference"), str(out / "live")
    landed = land_all(spark, raw, out)
    versions = landing.versions(spark, str(out / "bronze"), 2026)
    with pytest.raises(ValueError, match="no build"):
        job.refresh(spark, landed, reference, live, 2026, date(2026, 5, 20), "r", [1], now())
    job.build(spark, landed, reference, live, 2026, date(2026, 5, 20), "b0", now(), versions)
    read = []
    real = builds.read_table

    def noted(spark, table, season=None, races=None):
        df = real(spark, table, season, races)
        read.extend(f.split("/out/live/")[-1] for f in df.inputFiles())
        return df

    # Race 4 is corrected, race 6 is new.
    write_race(raw, 6)
    put(raw / "asset_snapshot", "asset_snapshot_race_7.json", asset_document(7))
    for race in (4, 6):
        correct(raw, race, r)
    landed = land_all(spark, raw, out)
    versions = landing.versions(spark, str(out / "bronze"), 2026)
    changed = job.changed_races(builds.published(spark, live), 2026, versions)
    assert set(changed) == {4, 6, 7}
    day = date(2026, 6, 20)
    whole = job.build(spark, landed, reference, str(out / "whole"), 2026, day, "w", now(),
                      versions).published
    with monkeypatch.context() as patched:
        patched.setattr(builds, "read_table", noted)
        fresh = job.refresh(spark, landed, reference, live, 2026, day, "r", changed, now(),
                            versions).published
    assert everything(fresh) == everything(whole)
    said = [rows(profiles.summed(p.table("profile_team_race"), V.RACE_KEY)) for p in (fresh, whole)]
    assert said[0] == said[1] and len(said[0]) == 6 * (len(fresh.table("team_race").columns) - 2)
    assert job.changed_races(fresh, 2026, versions) == []
    # Of the marts by race, only the state before race 4 and what follows it was read.
    by_race = [f for f in read if f.startswith("b0/") and "race_number=" in f
               and f.split("/")[2] in ("mart_team_race", "team_state", "team_race")]
    assert {f.split("race_number=")[1][0] for f in by_race} <= {"3", "4", "5"}
    parts = builds.latest_record(spark, live).tables["mart_team_race"].parts
    assert [parts[2026, k].folder.split("/")[-3] for k in range(1, 7)] == [
        "b0", "b0", "b0", "r", "r", "r"]
    text = (raw / "reference" / "races_2026.csv").read_text()
    (raw / "reference" / "races_2026.csv").write_text(text.replace("Race 2", "Another"))
    with pytest.raises(ValueError, match="races changed"):
        job.refresh(spark, landed, reference, live, 2026, date(2026, 6, 20), "r2", [1], now())


@pytest.mark.parametrize("write", [str, int, float], ids=["text", "whole", "decimal"])
def test_feed_numbers_of_any_type_are_equal(spark, tmp_path, write):
    document = team_document(TEAMS[0], 1)
    team = document["Data"]["Value"]["userTeam"][0]
    plain = json.loads(json.dumps(document))
    for field in ("teamno", "usersubs", "usersubsleft", *CHIP_FLAGS):
        team[field] = write(team[field])
    team["finalfixtakengd"] = write(1)
    for player in team["playerid"]:
        for field in ("iscaptain", "ismgcaptain", "playerpostion", "isfinal"):
            player[field] = write(player[field])
    latest = spark.createDataFrame([("ann", 1, 1)], "user_guid STRING, team_no BIGINT, race_number BIGINT")

    def prepared(document, folder):
        put(folder, "ann_team_1_race_1.json", document)
        found = documents.scan(spark, "detailed_teams", str(folder))
        return [rows(documents.lineup_records(found, 2026)), rows(documents.finance_records(found, 2026)),
                rows(documents.chip_usage(found, latest, 2026))]

    assert prepared(document, tmp_path / "a") == prepared(plain, tmp_path / "b")
    assert len(prepared(document, tmp_path / "a")[2]) == 2


def test_a_fraction_in_a_whole_number_field_stops_the_build(spark, raw, tmp_path):
    feed = asset_document(2)
    feed["Data"]["Value"][0]["GamedayPoints"] = "7.5"
    put(raw / "asset_snapshot", "asset_snapshot_race_2.json", feed)
    team = team_document(TEAMS[1], 1)
    team["Data"]["Value"]["userTeam"][0]["playerid"][3]["isfinal"] = 0.5
    put(raw / "detailed_teams", "bob_team_1_race_1.json", team)
    landed = land_all(spark, raw, tmp_path)
    with pytest.raises(quality.DataQualityError, match="lost fractions") as stopped:
        built(spark, raw, tmp_path, landed)
    assert "gameday_points" in str(stopped.value) and "isfinal" in str(stopped.value)
