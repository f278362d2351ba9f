"""Rows that a task holds don't grow with the tables, and nothing spread out is shuffled."""

import pytest
from conftest import TESTDATA, rows
from pyspark.sql import functions as F

from checks import star_league
from pitlane import fixed_values as V
from pitlane.operators import joins, quality
from pitlane.plans import audits, chips, marts

SKEWED = "season BIGINT, race_number BIGINT, user_guid STRING, team_no BIGINT"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def groups_after_dealing(df):
    """The rows of every exchange by number come from no aggregate, and there is one at least."""
    lines = plan_of(df).splitlines()
    below = [next(x for x in lines[i + 1:] if "Project" in x or "Scan" in x or "Aggregate" in x)
             for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line]
    return bool(below) and not any("Aggregate" in x for x in below)


@pytest.fixture
def many_parts(monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 40)
    monkeypatch.setattr(joins.parts_for, "__defaults__", (40,))
    monkeypatch.setattr(star_league, "TASK_ROWS", 800)


@pytest.fixture
def staged_frames(monkeypatch):
    frames, stage = {}, star_league.stage

    def keep(df, name, *rest, **more):
        frames[name] = df
        return stage(df, name, *rest, **more)

    monkeypatch.setattr(star_league, "stage", keep)
    return frames


def test_parts_follow_the_rows(spark):
    assert joins.parts_for(spark.range(10), 5) == 3
    assert joins.parts_for(spark.range(0)) == 1
    assert joins.parts_for(spark.range(10_000), 5) == joins.MOST_PARTS
    dealt = joins.deal_out(spark.range(600_000).withColumn("k", F.col("id") % 1000), ["k"])
    assert dealt.rdd.getNumPartitions() == 3
    assert dealt.groupBy("k", F.spark_partition_id()).count().count() == 1000


def health_rows(spark):
    """Repeated and null keys, gaps, and one key that a third of the rows share."""
    made = [(2026, 1 + i % 4, f"u{i % 60}", 1, None if i % 7 == 0 else 1.0,
             None if i % 5 == 0 else 1.0) for i in range(200)]
    made += [(2026, 2, "hot", 1, 1.0, None)] * 100
    made += [(2026, None, None, 1, None, None)] * 3
    return made, spark.createDataFrame(made, f"{SKEWED}, total_wealth DOUBLE, wealth_change DOUBLE")


def test_health_is_grouped_after_the_rows_are_dealt_out(spark, many_parts):
    made, mart = health_rows(spark)
    health = audits.mart_health(mart)
    assert tuple(health.first()) == (
        len(made), len(made) - len({r[:4] for r in made}), sum(r[4] is None for r in made),
        sum(r[1] is not None and r[1] > 1 and r[5] is None for r in made))
    assert groups_after_dealing(health)


def test_rosters_are_spread_out_after_the_shuffle(spark, league, many_parts, staged_frames):
    small = star_league.StarLeague(spark, TESTDATA)
    assert rows(small.team_race_asset) == rows(league.team_race_asset)
    plan = plan_of(staged_frames["team_race_asset"])
    assert plan.index("Generate explode") < plan.index("rangepartitioning")
    assert staged_frames["team_race_asset"].rdd.getNumPartitions() > 4


def test_metrics_are_sorted_in_all_parts_of_a_shuffle(spark, league):
    values = marts.roster_values(league.team_race_asset, league.asset_race, league.team_chip_usage)
    metrics = marts.team_metrics(league.team_race, values, league.races)
    assert plan_of(metrics).count("REPARTITION_BY_NUM") == 2
    assert rows(metrics) == rows(league.team_metrics)


def test_the_mart_is_dealt_out_before_the_averages_are_attached(
        spark, league, many_parts, staged_frames):
    small = star_league.StarLeague(spark, TESTDATA)
    assert rows(small.mart_team_race) == rows(league.mart_team_race)
    plan = plan_of(staged_frames["mart_team_race"])
    assert plan.index("BroadcastHashJoin") < plan.index("rangepartitioning")
    assert staged_frames["mart_team_race"].rdd.getNumPartitions() > 4
    folders = {f.rsplit("/", 1)[0] for f in small.mart_team_race.inputFiles()}
    assert len(folders) == small.mart_team_race.select(*V.RACE_KEY).distinct().count()


def test_the_timing_matrix_is_grouped_after_dealing_and_made_once(spark, league, many_parts):
    matrix = chips.chip_timing_matrix(league.mart_team_chips, list(range(1, 15)))
    assert groups_after_dealing(matrix)
    shown = chips.without_blank_columns(matrix, chips.TEAM)
    assert "Aggregate" not in plan_of(shown) and "Exchange" not in plan_of(shown)
    assert rows(shown) == rows(matrix, *shown.columns)
    gone = [c for c in matrix.columns if c not in shown.columns]
    assert {"r13", "r14"} <= set(gone)
    assert {v for r in rows(matrix, *gone) for v in r} == {""}


def test_repeated_keys_are_counted_after_the_rows_are_dealt_out(spark, many_parts):
    made = [(2026, 1 + i % 3, f"u{i % 50}", 1, i % 4) for i in range(900)]
    made += [(2026, 1, "hot", 1, 1)] * 300 + [(None, None, None, None, None)] * 5
    roster = spark.createDataFrame(made, f"{SKEWED}, asset_id BIGINT")
    few = spark.createDataFrame([(1,), (1,), (None,), (2,)], "chip_id BIGINT")
    found = quality.duplicate_keys({"team_race_asset": roster, "chips": few})
    assert rows(found, "source", "n") == [
        ("chips", 1), ("team_race_asset", len(made) - len(set(made)))]
    assert groups_after_dealing(found)
    assert "hashpartitioning(season" in plan_of(found)
    assert not any("asset_id" in x.split("REPARTITION")[0] for x in plan_of(found).splitlines()
                   if "REPARTITION_BY_NUM" in x)
