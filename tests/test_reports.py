"""Branches of the views, reports and quality checks that the derived league does not reach."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane import schemas
from pitlane.functions import columns as C
from pitlane.operators import quality
from pitlane.plans import audits, chips, evolution, overview, views

CHIP_SCHEMA = (
    "season BIGINT, user_guid STRING, team_no BIGINT, team_name STRING, last_observed_race BIGINT,"
    "chip_id BIGINT, chip_name STRING, chip_short_name STRING, available_first_race BIGINT,"
    "race_used BIGINT, chip_status STRING, race_used_name STRING, race_used_short_name STRING,"
    "chip_race_points DOUBLE, league_average_race_points DOUBLE")


def chip_mart(spark, records):
    """Records: guid, chip id, status, race used, place, points, average."""
    return spark.createDataFrame(
        [(2026, g, 1, f"Team {g}", 3, k, f"Chip {k}", f"C{k}", 1, race, status, place, place,
          points, mean) for g, k, status, race, place, points, mean in records], CHIP_SCHEMA)


@pytest.fixture(scope="module")
def some_chips(spark):
    return chip_mart(spark, [
        ("a", 1, "used", 2, "Spa", 50.0, 40.5), ("a", 2, "used", 2, "Spa", 50.0, 40.5),
        ("a", 3, "upcoming", 9, "Rio", None, None), ("b", 1, "used", 3, None, None, 30.0),
        ("b", 2, "upcoming", 8, None, None, None), ("b", 3, "unused", None, None, None, None),
        ("c", 1, "unused", None, None, None, None), ("c", 2, "unused", None, None, None, None),
        ("c", 3, "unused", None, None, None, None)])


def standings_of(spark, records):
    return spark.createDataFrame(records, "season BIGINT, race_number BIGINT, user_guid STRING,"
                                 "team_no BIGINT, team_name STRING, cumulative_points DOUBLE,"
                                 "race_points DOUBLE")


# --- chips --------------------------------------------------------------------------------------

def test_chip_matrix_labels_order_and_guard(spark, some_chips):
    ranked = spark.createDataFrame([(2026, "b", 1, 1), (2026, "a", 1, 2)],
                                   "season BIGINT, user_guid STRING, team_no BIGINT,"
                                   "league_rank BIGINT")
    order = chips.team_order(some_chips, ranked)
    assert rows(order, "display_order", "user_guid", "league_rank") == [
        (0, "b", 1), (1, "a", 2), (2, "c", None)]
    matrix = chips.chip_matrix(some_chips, order, [1, 2, 3, 4])
    assert [r[:] for r in matrix.select("user_guid", "chip_1", "chip_2", "chip_3", "chip_4")
            .collect()] == [("b", "Used", "Upcoming", "✕", None),
                            ("a", "Spa", "Spa", "Upcoming · Rio", None),
                            ("c", "✕", "✕", "✕", None)]
    with pytest.raises(Exception, match="duplicate chip rows"):
        chips.chip_matrix(some_chips.union(some_chips), order, [1, 2, 3]).collect()
    # Columns come from the data, a seventh chip too; given ones must hold every chip.
    assert [c for c in chips.chip_matrix(some_chips, order).columns if c.startswith("chip_")] == [
        "chip_1", "chip_2", "chip_3"]
    seventh = some_chips.union(some_chips.filter("chip_id = 3").withColumn(
        "chip_id", F.lit(7).cast("bigint")).select(some_chips.columns))
    assert "chip_7" in chips.chip_matrix(seventh, order).columns
    with pytest.raises(Exception, match="chips outside the columns"):
        chips.chip_matrix(seventh, order, [1, 2, 3]).collect()
    with pytest.raises(Exception, match="display order: duplicate keys"):
        chips.chip_matrix(some_chips, order.union(order)).collect()
    with pytest.raises(Exception, match="duplicate keys"):
        chips.team_order(some_chips, ranked.union(ranked))


def test_chip_timing_headers_and_blank_columns(spark, some_chips):
    matrix = chips.chip_timing_matrix(some_chips, [1, 2, 3])
    assert rows(matrix, "user_guid", "r1", "r2", "r3") == [
        ("a", "", "C1 / C2", ""), ("b", "", "", "C1"), ("c", "", "", "")]
    named = chips.timing_headers(matrix, some_chips, [1, 2, 3])
    assert named.columns[4:] == ["R1", "R2 · Spa", "R3"]
    shown = chips.without_blank_columns(named, chips.TEAM)
    assert shown.columns[4:] == ["R2 · Spa", "R3"]
    # Races 1 to the latest one by default; a use elsewhere is no reason to lose it.
    assert chips.chip_timing_matrix(some_chips).columns[4:] == [
        f"r{n}" for n in chips.races_so_far(some_chips)]
    with pytest.raises(Exception, match="races outside the columns"):
        chips.chip_timing_matrix(some_chips, [1, 2]).collect()
    # Without any used chip every team still has its blank row.
    none = chips.chip_timing_matrix(some_chips.filter("user_guid = 'c'"), [1, 2])
    assert rows(none, "user_guid", "r1", "r2") == [("c", "", "")]
    assert chips.without_blank_columns(none, chips.TEAM).columns == chips.TEAM


def test_chip_performance_needs_both_scores(spark, some_chips):
    assert rows(chips.chip_performance(some_chips), "user_guid", "chip_id",
                "points_vs_average") == [("a", 1, 9.5), ("a", 2, 9.5)]


# --- standings ----------------------------------------------------------------------------------

def test_rank_movement(spark):
    mart = standings_of(spark, [
        (2026, 1, "a", 1, "A", 10.0, 10.0), (2026, 1, "b", 1, "B", 20.0, 20.0),
        (2026, 1, "c", 1, "C", 30.0, 30.0), (2026, 1, "gone", 1, "G", 5.0, 5.0),
        (2026, 4, "a", 1, "A", 90.0, 80.0), (2026, 4, "b", 1, "B", 50.0, 30.0),
        (2026, 4, "c", 1, "C", 60.0, 30.0), (2026, 4, "new", 1, "N", 1.0, 1.0)])
    races = mart.select("season", "race_number").distinct()
    got = {r.user_guid: r for r in overview.rank_movement(mart, races).collect()}
    assert set(got) == {"a", "b", "c", "new"}
    assert (got["a"].league_rank, got["a"].season_rank_change, got["a"].season_label) == (
        1, 2, "+2 places")
    assert (got["c"].league_rank, got["c"].season_label) == (2, "-1 place")
    assert (got["b"].season_rank_change, got["b"].league_race_rank) == (-1, 2)
    assert (got["b"].race_rank_change, got["b"].race_label) == (0, None)
    assert (got["new"].season_rank_change, got["new"].season_label) == (None, None)


def test_ranks_come_before_the_name_filter(spark):
    mart = standings_of(spark, [(2026, 1, "a", 1, "Alpha", 9.0, 1.0),
                                (2026, 1, "b", 1, "Beta", 7.0, 1.0),
                                (2026, 1, "c", 1, "Beth", 7.0, 1.0)])
    mart = mart.withColumns({c: F.lit(None).cast("double") for c in views.TEAMS_LATEST
                             if c not in mart.columns and c != "league_rank"})
    races = mart.select("season", "race_number").distinct()
    assert rows(views.teams_latest(mart, races, 2026, "BET"), "user_guid", "league_rank") == [
        ("b", 2), ("c", 2)]
    assert views.teams_latest(mart, races, season=1999).isEmpty()


def test_team_directory_puts_present_teams_first(spark):
    history = standings_of(spark, [
        (2026, 1, "a", 1, "Old", 99.0, 1.0), (2026, 2, "b", 1, "B", 5.0, 1.0),
        (2026, 1, "b", 1, "Before", 4.0, 1.0), (2026, 2, "c", 2, "A", 5.0, 1.0)])
    found = evolution.team_directory(history, history.select("season", "race_number"))
    assert [(r.team_key, r.team_name, r.in_latest_snapshot) for r in found.collect()] == [
        ("c_2", "A", True), ("b_1", "B", True), ("a_1", "Old", False)]


def test_change_sign(spark):
    df = spark.createDataFrame([(1.0,), (-0.5,), (0.0,), (None,)], "x DOUBLE")
    assert [r[0] for r in df.select(C.change_sign("x")).collect()] == [
        "positive", "negative", "zero", "missing"]


# --- views --------------------------------------------------------------------------------------

def test_contains_has_wildcards_and_literal_backslashes(spark):
    df = spark.createDataFrame([("a\\q",), ("A_B",), ("AxB",), ("50%",)], "t STRING")

    def found(text):
        return [r.t for r in df.filter(C.contains_fold("t", text)).collect()]

    assert found("a_b") == ["A_B", "AxB"]
    assert found("\\Q") == ["a\\q"]
    assert found("%") == ["a\\q", "A_B", "AxB", "50%"]


def test_filters_combine_and_empty_text_is_no_filter(spark, some_chips):
    assert views.team_chips(some_chips, team_name="").count() == 9
    assert rows(views.team_chips(some_chips, season=2026, team_name="TEAM A", chip_id=2,
                                 chip_status="Used"), "user_guid", "chip_id") == [("a", 2)]
    assert views.team_chips(some_chips, chip_id=0).isEmpty()


def test_topk_ties_and_limit(spark):
    mart = spark.createDataFrame(
        [(2026, r, a, "DRIVER", "D", 1.0, 1.0, change, 0, 0.0, 0.0)
         for r, a, change in [(1, 2, 0.5), (1, 1, 0.5), (2, 1, None), (2, 2, -0.1)]],
        "season INT, race_number INT, asset_id INT, asset_type STRING, display_name STRING,"
        "value DOUBLE, old_asset_value DOUBLE, value_change DOUBLE, gameday_points INT,"
        "overall_points DOUBLE, selected_percentage DOUBLE")
    top = views.asset_value_changes(mart, limit=3)
    assert [(r.race_number, r.asset_id) for r in top.collect()] == [(1, 1), (1, 2), (2, 2)]
    assert views.asset_value_changes(mart, race_number=2).count() == 2
    with pytest.raises(ValueError):
        views.asset_value_changes(mart, limit=-1)


def test_lineup_detail_of_one_team(spark, league):
    team = league.team_race_asset.select(*V.TEAM_RACE_KEY).first().asDict()
    lineup = audits.lineup_detail(league.team_race_asset, league.asset_race, **team)
    slots = [r.player_position for r in lineup.collect()]
    assert 0 < len(slots) <= 8 and slots == sorted(slots)


# --- quality ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def good(spark):
    """One valid row per table."""
    def table(name, **values):
        schema = schemas.TABLES[name]
        row = {f.name: values.get(f.name) for f in schema.fields}
        return spark.createDataFrame([tuple(row.values())], schema)

    team = {"season": 2026, "race_number": 1, "user_guid": "a", "team_no": 1, "team_name": "A"}
    return {
        "asset_race": table("asset_race", season=2026, race_number=1, asset_id=5,
                            asset_type="DRIVER", value=1.0, gameday_points=1),
        "team_race": table("team_race", **team, race_points=1.0, race_rank=1,
                           remaining_budget=1.0, transfers_made=0, free_transfers_remaining=2),
        "team_race_asset": table("team_race_asset", **team, asset_id=5, is_captain=1,
                                 is_mg_captain=0, player_position=1, is_final=0),
        "team_chip_usage": table("team_chip_usage", season=2026, user_guid="a", team_no=1,
                                 chip_id=1, race_used=1),
        "races": table("races", season=2026, race_number=1),
        "chips": table("chips", chip_id=1),
    }


def test_valid_tables_pass_and_report_gaps(good):
    gaps = quality.raise_on_violation(good)
    assert rows(gaps, "related", "n") == [("recorded_asset_value", 1),
                                          ("recorded_total_budget", 1)]


def broken(good, table, change):
    return {**good, table: change(good[table])}


@pytest.mark.parametrize("table, change, message", [
    ("asset_race", lambda df: df.withColumn("asset_id", F.lit(None).cast("bigint")), "null key"),
    ("team_race", lambda df: df.union(df), "duplicate key"),
    ("team_race", lambda df: df.withColumn("race_points", F.lit(None).cast("double")),
     "null measure.*race_points"),
    ("team_race_asset", lambda df: df.withColumn("asset_id", F.lit(6).cast("bigint")),
     "reference.*team_race_asset.*asset_race"),
    ("team_chip_usage", lambda df: df.withColumn("chip_id", F.lit(9).cast("bigint")),
     "reference.*team_chip_usage.*chips"),
    ("team_chip_usage", lambda df: df.withColumn("race_used", F.lit(0).cast("bigint")),
     "historical use"),
    ("races", lambda df: df.limit(0), "empty table"),
    ("team_race", lambda df: df.drop("transfers_made"), "missing columns.*transfers_made"),
    ("team_race", lambda df: df.drop("recorded_asset_value"), "missing columns"),
])
def test_guard_raises(good, table, change, message):
    with pytest.raises(quality.DataQualityError, match=message):
        quality.raise_on_violation(broken(good, table, change))


def test_missing_table_raises(spark, good):
    with pytest.raises(quality.DataQualityError, match="missing tables.*chips"):
        quality.raise_on_violation({k: v for k, v in good.items() if k != "chips"})
    assert quality.missing_tables(spark, ["surely_absent"]) == ["surely_absent"]


def test_chip_usage_may_be_empty_and_upcoming_chips_are_exempt(good):
    quality.raise_on_violation(broken(good, "team_chip_usage", lambda df: df.limit(0)))
    later = broken(good, "team_chip_usage",
                   lambda df: df.withColumn("race_used", F.lit(2).cast("bigint")))
    calendar = good["races"].union(good["races"].withColumn("race_number", F.lit(2).cast("bigint")))
    quality.raise_on_violation({**later, "races": calendar})
    # Listed all the same.
    assert quality.unmatched_chip_rows(later["team_chip_usage"], good["team_race"]).count() == 1
