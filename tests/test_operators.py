"""Operators against brute force, on small rows and on skewed ones."""

import random
from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import contains_fold
from pitlane.operators import joins, ranking
from pitlane.plans import marts, names, profiles, views
from pitlane.sources import builds
from pitlane.sources.tables import stage, stage_by, staging


def brute_ranks(records):
    """(group, score) -> 1 + scores above it; null scores come last."""
    out = []
    for key, group, score in records:
        peers = [s for _, g, s in records if g == group]
        if score is None:
            place = 1 + sum(s is not None for s in peers)
        else:
            place = 1 + sum(s is not None and s > score for s in peers)
        out.append((key, place))
    return sorted(out)


def skewed_records(n=600):
    """A third of the rows share one group and one score; some scores and groups are null."""
    pick = random.Random(5)
    records = []
    for key in range(n):
        if key % 3 == 0:
            records.append((key, 1, 50.0))
        else:
            score = pick.choice([None, *map(float, range(40))])
            records.append((key, pick.choice([1, 2, 3, None]), score))
    return records


@pytest.fixture
def tiny_bound(monkeypatch):
    """Every side counts as too large to broadcast."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)


def check_ranks(spark):
    records = skewed_records()
    df = spark.createDataFrame(records, "key INT, grp INT, score DOUBLE")
    ranked = ranking.competition_rank(df, ["grp"], "score", "place")
    assert ranked.columns == ["key", "grp", "score", "place"]
    assert sorted((r.key, r.place) for r in ranked.collect()) == brute_ranks(records)


def test_competition_rank(spark):
    check_ranks(spark)


def test_score_buckets_never_fall(spark):
    r = random.Random(1)
    scores = [0.0, -0.0, 1.0, 2.0, 4.0, 1e-300, 1e300, 8.0, 7.999999999999999, 0.1, 0.3]
    scores += [r.uniform(-5, 5) * 10 ** r.randint(-8, 8) for _ in range(2000)]
    scores += [2.0**k * (1 + d) for k in range(-30, 30) for d in (-1e-16, 0.0, 1e-15)]
    df = spark.createDataFrame([(s,) for s in scores], "score DOUBLE")
    found = sorted(tuple(x) for x in df.select("score", ranking.score_bucket(F.col("score"))).collect())
    buckets = [b for _, b in found]
    assert buckets == sorted(buckets)
    near = df.sparkSession.range(2000).select((F.col("id") / 2000.0 + 100.0).alias("score"))
    assert near.select(ranking.score_bucket(F.col("score"))).distinct().count() > 20


def test_ranks_of_one_season_of_fractions_are_spread(spark, tmp_path):
    """All scores distinct: the window over a group's scores runs in many parts."""
    df = spark.range(4000).select(
        F.lit(2026).alias("season"), "id", (F.col("id") * 0.37 + 1000.123).alias("score"))
    ranked = ranking.competition_rank(df, ["season"], "score", "place")
    expected = [(i, 4000 - i) for i in range(4000)]
    assert rows(ranked, "id", "place") == sorted(expected, key=repr)
    parts = df.select(ranking.score_bucket(F.col("score")).alias("b")).groupBy("b").count()
    largest = parts.agg(F.max("count")).first()[0]
    assert largest < 4000 / 100
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_views_write_nothing(spark, league):
    """Building the views, twice, leaves the shared folder as it is."""
    from pitlane.plans import overview, views

    mart, races, loaded = league.mart_team_race, league.races, league.loaded_races
    league.mart_team_chips, league.mart_team_assets_latest

    def folders():
        base = Path(spark.conf.get("spark.checkpoint.dir")) / spark.sparkContext.applicationId
        return sorted(p.name for p in base.iterdir())

    before = folders()
    for _ in range(2):
        views.teams_latest(mart, races, loaded=loaded).count()
        views.standings(mart, races).count()
        overview.rank_movement(mart, races, loaded).count()
        overview.latest_race_rank(mart, races, loaded).count()
        league.build_team_chips().count()
        league.build_team_assets_latest().count()
    assert folders() == before


def test_the_latest_race_is_read_alone(spark, league):
    from pitlane.plans import overview, views

    def scan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    latest = scan(views.teams_latest(league.mart_team_race, league.races, loaded=league.loaded_races))
    assert "PartitionFilters: [" in latest and "race_number" in latest.split("PartitionFilters: [")[1]
    moved = scan(overview.rank_movement(league.mart_team_race, league.races, league.loaded_races))
    read = [part.split("]")[0] for part in moved.split("PartitionFilters: [")[1:]]
    assert read and all("race_number" in part for part in read)
    unknown = scan(views.latest_race_rows(league.mart_team_race, league.races))
    assert "dynamicpruning" in unknown


def test_two_ranks_at_once(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0), (3, 9.0, 2.0)],
                               "k INT, a DOUBLE, b DOUBLE").withColumn("g", F.lit(0))
    both = ranking.competition_ranks(df, ["g"], {"a": "ra", "b": "rb"})
    assert rows(both, "k", "ra", "rb") == [(1, 2, 3), (2, 2, 1), (3, 1, 2)]


def test_sequential_position_numbers_every_group_in_order(spark):
    records = [(g, s, k) for k, (_, g, s) in enumerate(skewed_records(900))]
    df = spark.createDataFrame(records, "grp INT, score DOUBLE, key INT").repartition(7)
    placed = ranking.sequential_position(
        df, ["grp"], [F.asc_nulls_last("score"), "key"], "position"
    )
    expected = []
    for group in {g for g, _, _ in records}:
        mine = sorted((r for r in records if r[0] == group),
                      key=lambda r: (r[1] is None, r[1] or 0.0, r[2]))
        expected += [(group, r[2], i) for i, r in enumerate(mine)]
    assert rows(placed, "grp", "key", "position") == sorted(expected, key=repr)


def test_sequential_position_spreads_a_hot_group(spark, monkeypatch):
    """One group with all rows is sorted by several tasks."""
    df = spark.range(40_000).select(F.lit(1).alias("g"), F.hash("id").alias("h"), "id")
    written = []

    def recorded(frame, name):
        written.append(stage(frame, name))
        return written[-1]

    monkeypatch.setattr(ranking, "stage", recorded)
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(adaptive, "false")
    try:
        placed = ranking.sequential_position(df, ["g"], ["h", "id"], "p")
    finally:
        spark.conf.unset(adaptive)
    assert placed.agg(F.min("p"), F.max("p"), F.count_distinct("p")).first()[:] == (
        0, 39_999, 40_000)
    parts = written[0].groupBy(F.shiftright("__place", 33)).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 20_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_join(spark, how):
    records = skewed_records(300)
    big = spark.createDataFrame(records, "key INT, grp INT, score DOUBLE")
    small = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], "grp INT, v STRING")
    plain = big.join(small, ["grp"], how)
    assert rows(joins.salted_join(big, small, ["grp"], how), *plain.columns) == rows(plain)
    assert rows(joins.attach_small(big, small, ["grp"], how, max_rows=3), *plain.columns) == rows(
        plain)
    assert rows(joins.attach_small(big, small, ["grp"], how), *plain.columns) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_copies_are_never_broadcast(spark, how, null_safe, tmp_path):
    # Small by its file, so the planner would broadcast it with all its copies.
    spark.range(50).write.parquet(str(tmp_path / "small"))
    big, small = spark.range(100), spark.read.parquet(str(tmp_path / "small"))
    joined = joins.attach_small(big, small, ["id"], how, max_rows=49, null_safe=null_safe)
    assert len(joined.collect()) == (100 if how == "left" else 50)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_salted_join_refuses_a_full_join(spark):
    with pytest.raises(ValueError):
        joins.salted_join(spark.range(1), spark.range(1), ["id"], "full")


def test_attach_small_broadcasts_only_within_the_bound(spark):
    big, small = spark.range(100), spark.range(50)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.attach_small(big, small, ["id"]))
        assert "BroadcastHashJoin" not in plan(
            joins.attach_small(big, spark.range(50), ["id"], max_rows=49))
        # A bounded table vouches for what is derived from it.
        assert "BroadcastHashJoin" in plan(
            joins.attach_small(big, small, ["id"], proof=spark.range(3), max_rows=5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("b", 2, "only")],
                               "k STRING, r INT, name STRING")
    assert rows(ranking.latest_per_key(df, ["k"], "r")) == [("a", 3, "new"), ("b", 2, "only")]


# --- marts --------------------------------------------------------------------------------------

def roster_of(spark, entries):
    return spark.createDataFrame(
        [(2026, 1, guid, 1, asset, final) for guid, assets in entries.items()
         for asset, final in assets],
        "season BIGINT, race_number BIGINT, user_guid STRING, team_no BIGINT, asset_id BIGINT,"
        "is_final BIGINT")


def values_of(spark, entries, usage=(), price=None):
    prices = spark.createDataFrame(
        [(2026, 1, a, (price or {}).get(a, 10.0 + a)) for a in range(1, 10)],
        "season BIGINT, race_number BIGINT, asset_id BIGINT, value DOUBLE")
    uses = spark.createDataFrame(
        list(usage), "season BIGINT, user_guid STRING, team_no BIGINT, chip_id BIGINT,"
                     "race_used BIGINT")
    found = marts.roster_values(roster_of(spark, entries), prices, uses)
    return {r.user_guid: r.calculated_asset_value for r in found.collect()}


SEVEN = [(a, 0) for a in range(1, 8)]


@pytest.mark.parametrize("salted", [False, True])
def test_roster_values(spark, salted, request):
    if salted:
        request.getfixturevalue("tiny_bound")
    total = float(sum(10 + a for a in range(1, 8)))
    entries = {
        "plain": SEVEN, "short": SEVEN[:6], "long": SEVEN + [(8, 0)],
        # An incoming eighth asset is not priced; the outgoing one is.
        "swap": SEVEN[:6] + [(7, 2), (9, 1)],
        # A null status drops the row, so the roster is short.
        "unknown": SEVEN[:6] + [(7, None)],
        "limitless": SEVEN, "wildcard": SEVEN, "elsewhere": SEVEN,
        "unpriced": SEVEN[:6] + [(77, 0)],
    }
    usage = [(2026, "limitless", 1, 1, 1), (2026, "wildcard", 1, 2, 1),
             (2026, "elsewhere", 1, 1, 2)]
    assert values_of(spark, entries, usage) == {
        "plain": total, "short": None, "long": None, "swap": total, "unknown": None,
        "wildcard": total, "elsewhere": total, "unpriced": None}
    assert values_of(spark, {"a": SEVEN}, price={3: None}) == {"a": None}


def metrics_of(spark, records, values=()):
    columns = ("season BIGINT, race_number BIGINT, user_guid STRING, team_no BIGINT, team_name "
               "STRING, race_points DOUBLE, race_rank BIGINT, recorded_asset_value DOUBLE, "
               "remaining_budget DOUBLE, recorded_total_budget DOUBLE")
    teams = spark.createDataFrame(
        [(2026, race, guid, 1, guid, points, 1, value, cash, budget)
         for guid, race, points, value, cash, budget in records], columns)
    races = spark.createDataFrame([(2026, r, f"R{r}") for r in (1, 2, 3, 4)],
                                  "season BIGINT, race_number BIGINT, race_name STRING")
    calculated = spark.createDataFrame(
        [(2026, race, guid, 1, value) for guid, race, value in values],
        "season BIGINT, race_number BIGINT, user_guid STRING, team_no BIGINT, "
        "calculated_asset_value DOUBLE")
    found = marts.team_race_mart(marts.team_metrics(teams, calculated, races), races)
    return {(r.user_guid, r.race_number): r for r in found.collect()}


def test_wealth_provenance_and_change(spark):
    got = metrics_of(
        spark,
        [("a", 1, 10.0, 90.0, 1.0, None), ("a", 3, 20.0, None, 2.0, None),
         ("a", 4, 5.0, None, 2.0, 95.5), ("b", 1, 11.0, None, 3.0, None),
         ("b", 9, 1.0, 1.0, 1.0, 1.0)],
        [("a", 1, 50.0), ("a", 3, 91.3)],
    )
    assert ("b", 9) not in got  # no such race in the calendar
    one, three, four = (got["a", r] for r in (1, 3, 4))
    assert (one.valuation_source, one.asset_value, one.total_wealth) == ("recorded", 90.0, 91.0)
    assert (three.valuation_source, three.total_wealth) == ("calculated", 93.3)
    # Wealth without an asset value: the recorded budget alone.
    assert (four.valuation_source, four.asset_value, four.total_wealth) == (
        "unavailable", None, 95.5)
    # Race 2 is missing: the change is against the team's own previous race.
    assert (one.wealth_change, three.wealth_change, four.wealth_change) == (None, 2.3, 2.2)
    assert [got["a", r].cumulative_points for r in (1, 3, 4)] == [10.0, 30.0, 35.0]
    # Missing money stays missing and does not enter the average.
    assert got["b", 1].total_wealth is None and got["b", 1].valuation_source == "unavailable"
    assert one.league_average_total_wealth == 91.0
    assert one.league_average_race_points == 10.5


def test_average_of_money_on_a_rounding_boundary(spark):
    """98.6 and 98.7 average to 98.65, which as a double is slightly less."""
    got = metrics_of(spark, [("a", 1, 1.0, 98.6, 0.0, None), ("b", 1, 1.0, 98.7, 0.0, None)])
    assert got["a", 1].league_average_total_wealth == 98.7


def test_assets_latest_takes_points_and_prices_from_different_races(spark):
    assets = spark.createDataFrame(
        [(2026, r, a, "DRIVER", f"A{a}", 10.0 + r, 9.5 + r, float(r), 3 * r)
         for r in (1, 2, 3) for a in (1, 2) if (r, a) != (2, 2)],
        "season BIGINT, race_number BIGINT, asset_id BIGINT, asset_type STRING, display_name "
        "STRING, value DOUBLE, old_asset_value DOUBLE, overall_points DOUBLE, gameday_points "
        "BIGINT").withColumns({"selected_percentage": F.lit(1.0),
                               "retrieved_at_utc": F.lit(None), "feed_time_utc": F.lit(None)})
    races = spark.createDataFrame([(2026, r, date(2026, 3, r)) for r in (1, 2, 3)],
                                  "season BIGINT, race_number BIGINT, race_date DATE")
    found = marts.assets_latest(assets, races, date(2026, 3, 3))
    assert rows(found, "asset_id", "points_race_number", "price_feed_race_number",
                "race_causing_change", "current_value", "latest_value_change",
                "gameday_points") == [(1, 2, 3, 2, 13.0, 0.5, 6), (2, None, 3, 2, 13.0, 0.5, None)]


# --- properties on the derived league -----------------------------------------------------------

def test_properties_of_the_team_race_mart(league):
    mart = league.mart_team_race
    assert mart.count() == league.team_race.count()
    totals = league.team_race.groupBy("season", "user_guid").agg(F.sum("race_points").alias("t"))
    last = mart.groupBy("season", "user_guid").agg(
        F.max_by("cumulative_points", "race_number").alias("c"),
        F.max_by("total_wealth", "race_number").alias("last"),
        F.min_by("total_wealth", "race_number").alias("first"),
        F.sum("wealth_change").alias("moved"),
        F.count_if(F.col("total_wealth").isNull()).alias("gaps"))
    assert last.join(totals, ["season", "user_guid"]).filter("c != t").isEmpty()
    whole = last.filter("gaps = 0 AND moved IS NOT NULL")
    assert whole.count() > 0
    assert whole.filter("abs(last - first - moved) > 0.01").isEmpty()


def test_properties_of_the_chip_mart(league):
    chips = league.mart_team_chips
    teams = league.team_race.select("season", "user_guid", "team_no").distinct().count()
    assert chips.count() == teams * 6
    assert chips.filter("(race_used IS NULL) != (chip_status = 'unused')").isEmpty()


# --- buckets by team ----------------------------------------------------------------------------

def final_plan(df):
    """The plan that ran, without what adaptive execution started from."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_small_sides(spark):
    """Joins without a hint take no side for small, as with tables of a real size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chips_and_state_of_bucketed_teams_move_no_row(spark, league, no_small_sides):
    loaded = league.loaded_races
    chips = league.build_team_chips()
    plain = marts.team_chips(league.team_race, league.team_chip_usage, league.chips, league.races,
                             league.mart_team_race)
    assert rows(chips) == rows(plain)
    by_team = "hashpartitioning(season"
    assert "user_guid" in final_plan(plain).split(by_team)[1][:60]
    assert by_team not in final_plan(chips) and "SinglePartition" not in final_plan(chips)
    assert "SortMergeJoin" in final_plan(chips)
    state = marts.team_state(league.team_metrics, loaded)
    # The races of a season are gathered; teams stay where they are.
    assert "user_guid" not in "".join(
        part[:60] for part in final_plan(state).split("hashpartitioning(")[1:])
    assert rows(state) == rows(marts.team_state(league.mart_team_race, loaded))


def test_buckets_are_written_with_one_shuffle_and_one_file_each(spark, league):
    values = marts.roster_values(league.team_race_asset, league.asset_race, league.team_chip_usage)
    metrics = marts.team_metrics(league.team_race, values, league.races)
    with staging(spark):
        staged = stage_by(metrics, "team_metrics", V.TEAM_KEY)
        assert rows(staged) == rows(metrics)
        files = staged.inputFiles()
        assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        names = [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_team_metrics")]
    left = [t.name for t in spark.catalog.listTables()]
    # The name and the folder of what was staged inside are gone.
    assert len([n for n in names if n not in left]) == 1
    assert not Path(files[0].removeprefix("file:")).exists()


def test_an_empty_table_in_buckets(spark):
    with staging(spark):
        empty = stage_by(spark.createDataFrame([], "season BIGINT, user_guid STRING, team_no BIGINT"),
                         "none", V.TEAM_KEY)
        assert empty.count() == 0 and empty.groupBy(*V.TEAM_KEY).count().count() == 0


# --- a few teams out of many --------------------------------------------------------------------

def rows_scanned(df):
    """Rows that came out of the files of a plan without a shuffle."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_user_is_found_without_reading_the_race(spark, tmp_path):
    users = spark.range(300_000).select(
        F.lit(2026).cast("bigint").alias("season"), F.lit(1).cast("bigint").alias("race_number"),
        F.md5(F.col("id").cast("string")).alias("user_guid"), (F.col("id") % 7).alias("points"))
    read, table = builds.written(users, str(tmp_path / "mart"), V.RACE_KEY, 2026)
    assert table.parts[2026, 1].rows == 300_000
    wanted = [r.user_guid for r in users.filter("id IN (5, 77777)").collect()]
    found = views.of_users(read, wanted)
    assert rows(found) == rows(users.filter(F.col("user_guid").isin(wanted)))
    # Pages hold 20,000 rows at most.
    assert 2 <= rows_scanned(found) <= 80_000
    # A user that isn't there, between those that are, is ruled out by the filters of the files.
    assert rows_scanned(views.of_users(read, [wanted[0][:-1] + "x"])) == 0
    assert views.of_users(read, []).count() == 0


# --- names --------------------------------------------------------------------------------------

NAME_ROWS = "season BIGINT, race_number BIGINT, user_guid STRING, team_no BIGINT, team_name STRING"


def test_names_through_the_index_equal_a_scan(spark):
    """10,000 names, and texts cut out of them with other case, wildcards, and letters that fold oddly."""
    r = random.Random(7)
    letters = "abcABC %_\\'ßẞİıΣσςéÉ🏁😀\n"
    made = ["".join(r.choice(letters) for _ in range(r.randint(0, 9))) for _ in range(10_000)]
    rows_ = [(2026, 1 + i % 3, f"u{i // 2}", i % 2, name) for i, name in enumerate(made)]
    rows_ += [(2026, 1, "none", 1, None), (2026, 2, "u1", 1, "x" * 5000), (2026, 3, "u2", 0, made[4])]
    table = stage(spark.createDataFrame(rows_, NAME_ROWS), "name_rows")
    indexed = stage(names.index(names.first_names(table)), "name_index")
    assert rows(names.names_in(indexed).select("user_guid", "team_no", "team_name")) == rows(
        table.filter("team_name IS NOT NULL").select("user_guid", "team_no", "team_name").distinct())
    texts = ["", "%", "_", "xxxx", "a_b%c", "\\", "ΑΣ", "nobody has this"]
    for name in r.sample([n for n in made if len(n) > 4], 12):
        start = r.randint(0, 2)
        texts.append(r.choice([str.upper, str.lower, str])(name[start:start + r.randint(3, 5)]))
    for text in texts:
        plain = table.filter(contains_fold("team_name", text))
        assert rows(names.named(table, indexed, text)) == rows(plain), text
        assert rows(names.named(table, indexed, text, most=0)) == rows(plain), text


def test_a_name_is_kept_at_its_first_race(spark):
    table = spark.createDataFrame(
        [(1, 2, "a", 1, "One"), (1, 3, "a", 1, "One"), (1, 4, "a", 1, "Two"), (1, 5, "a", 1, "One"),
         (1, 3, "a", 2, "One"), (2, 1, "a", 1, "One"), (2, 2, "a", 1, None)], NAME_ROWS)
    assert rows(names.first_names(table).select("season", "team_no", "team_name", "race_number")) == [
        (1, 1, "One", 2), (1, 1, "Two", 4), (1, 2, "One", 3), (2, 1, "One", 1)]
    early, late = table.filter("race_number < 4"), table.filter("race_number >= 4")
    known = names.names_in(names.index(names.first_names(early)))
    assert rows(names.first_names(late, known).select("team_name", "race_number")) == [("Two", 4)]
    assert names.index(names.first_names(table.limit(0))).count() == 0


def test_a_name_is_found_without_reading_the_others(spark, tmp_path):
    table = spark.range(200_000).select(
        F.lit(2026).cast("bigint").alias("season"), F.lit(1).cast("bigint").alias("race_number"),
        F.md5(F.col("id").cast("string")).alias("user_guid"), F.lit(1).cast("bigint").alias("team_no"),
        F.concat(F.lit("Team "), F.col("id").cast("string")).alias("team_name"))
    mart, _ = builds.written(table, str(tmp_path / "mart"), V.RACE_KEY, 2026)
    indexed, _ = builds.written(
        names.index(names.first_names(table)), str(tmp_path / "names"), V.RACE_KEY, 2026)
    found = names.containing(indexed, "TEAM 123456")
    assert rows(found.select("team_name")) == [("Team 123456",)]
    # All names have "tea"; few have the rarest run of the text. The whole index has 1.7 million rows.
    assert rows_scanned(found) <= 100_000
    of_team = names.named(mart, indexed, "team 123456")
    assert rows(of_team.select("team_name")) == [("Team 123456",)]
    assert rows_scanned(of_team) <= 60_000


# --- profiles -----------------------------------------------------------------------------------

def test_profiles_of_parts_add_up(spark):
    many = spark.range(60_000).select(
        (F.col("id") % 3 + 2024).alias("season"), (F.col("id") % 5 + 1).alias("race_number"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("key"), (F.col("id") % 9).alias("few"),
        F.lit(None).cast("string").alias("none"), (F.col("id") % 2000 / 7).alias("share"))
    parts = profiles.profile(many)
    assert parts.count() == 15 * 4
    exact = {"key": 45_000, "few": 9, "none": 0, "share": 2000}
    for by in ([], ["season"], V.RACE_KEY):
        seen = {}
        for r in profiles.summed(parts, by).collect():
            seen.setdefault(r["column"], []).append(r)
        groups = {0: 1, 1: 3, 2: 15}[len(by)]
        assert {c: len(found) for c, found in seen.items()} == dict.fromkeys(exact, groups)
        assert sum(r.rows for r in seen["few"]) == 60_000
        assert sum(r.nulls for r in seen["key"]) == 15_000
        assert all(r.nulls == r.rows and r.distinct_estimate == 0 for r in seen["none"])
        assert all(r.distinct_estimate <= 9 for r in seen["few"])
    whole = {r["column"]: r.distinct_estimate for r in profiles.summed(parts).collect()}
    for column, number in exact.items():
        assert abs(whole[column] - number) <= 1 + profiles.SKETCH_ERROR * number
    assert profiles.summed(profiles.profile(many.limit(0))).count() == 0
