"""The five analytical tables.

Facts are keyed by team and race. Everything per team (running points, change of wealth, chips)
is shuffled by team, whose rows are bounded by the races of a season. Everything per race (prices,
calendar, league averages) is a table bounded by the calendar and is joined without moving the
fact.
"""

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import exact_mean
from pitlane.operators.joins import attach_small, fits
from pitlane.operators.prepare import completed_races
from pitlane.plans.views import rows_of_last_races

ASSET_KEY = V.KEYS["asset_race"]
#: Chips that a season may have.
MOST_CHIPS = 1000


# --- assets -----------------------------------------------------------------------------------

def asset_value_changes(asset_race: DataFrame) -> DataFrame:
    return asset_race.select(
        "season", "race_number", "asset_id", "asset_type", "display_name", "value",
        "old_asset_value",
        F.round(F.col("value") - F.col("old_asset_value"), 2).alias("value_change"),
        "gameday_points", "overall_points", "selected_percentage", "retrieved_at_utc",
        "feed_time_utc",
    )


def latest_completed_race(races: DataFrame, as_of: date) -> DataFrame:
    """The last race of each season that was over before `as_of`."""
    return completed_races(races, as_of).groupBy("season").agg(
        F.max("race_number").alias("race_number")
    )


def latest_price_feed(asset_race: DataFrame) -> DataFrame:
    return asset_race.groupBy("season").agg(F.max("race_number").alias("race_number"))


def assets_latest(asset_race: DataFrame, races: DataFrame, as_of: date) -> DataFrame:
    """Prices of the latest feed beside points of the latest completed race, by season."""
    points = attach_small(
        asset_race, latest_completed_race(races, as_of), V.RACE_KEY, proof=races
    ).select(
        "season", "asset_id", "asset_type", F.col("race_number").alias("points_race_number"),
        "overall_points", "gameday_points", "selected_percentage",
    )
    prices = attach_small(
        asset_race, latest_price_feed(asset_race), V.RACE_KEY, proof=races
    ).select(
        "season", "asset_id", "asset_type", "display_name",
        F.col("race_number").alias("price_feed_race_number"),
        (F.col("race_number") - 1).alias("race_causing_change"),
        F.col("value").alias("current_value"), F.col("old_asset_value").alias("previous_value"),
        F.round(F.col("value") - F.col("old_asset_value"), 1).alias("latest_value_change"),
        "retrieved_at_utc", "feed_time_utc",
    )
    return prices.join(points, ["season", "asset_id", "asset_type"], "left").select(
        "season", "asset_id", "asset_type", "display_name", "points_race_number",
        "price_feed_race_number", "race_causing_change", "current_value", "previous_value",
        "latest_value_change", "overall_points", "gameday_points", "selected_percentage",
        "retrieved_at_utc", "feed_time_utc",
    )


def team_assets_latest(
    roster: DataFrame, team_race: DataFrame, assets: DataFrame, races: DataFrame,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Every roster entry of each season's latest roster race, with the asset's latest figures.

    Both rows of a swap stay. `assets` is the latest-asset mart, `loaded` the races that the roster has
    rows of: with it, one race of rosters and of standings is read.
    """
    current = rows_of_last_races(
        roster.select(*V.TEAM_RACE_KEY, "asset_id"), races, 1, loaded
    ).drop("recency")
    # The standings row decides what is shown: without one, team number and name are null.
    named = team_race.select(*V.TEAM_RACE_KEY, "team_name", F.lit(True).alias("__stands"))
    if loaded is not None:
        named = rows_of_last_races(named, races, 1, loaded).drop("recency")
    with_team = current.join(named, V.TEAM_RACE_KEY, "left")
    figures = assets.select(
        "season", "asset_id", "asset_type", "display_name", "current_value",
        "latest_value_change", "overall_points", "gameday_points", "points_race_number",
        "price_feed_race_number",
    )
    return attach_small(with_team, figures, ["season", "asset_id"], "left", proof=assets).select(
        "season", F.col("race_number").alias("team_snapshot_race_number"), "user_guid",
        F.when(F.col("__stands"), F.col("team_no")).alias("team_no"), "team_name", "asset_id",
        "asset_type", "display_name", "current_value", "latest_value_change", "overall_points",
        F.col("gameday_points").alias("latest_completed_race_points"), "points_race_number",
        "price_feed_race_number",
    )


# --- teams by race ----------------------------------------------------------------------------

def roster_values(
    roster: DataFrame, asset_race: DataFrame, usage: DataFrame, size: int = V.ROSTER_SIZE,
) -> DataFrame:
    """Reconstructed value of each complete, fully priced original roster.

    Incoming swaps are left out. Prices are attached before the shuffle, so rows combine to one per
    team and race on the map side. Limitless races are removed after that, from the smaller side.
    """
    priced = attach_small(
        roster.filter(F.col("is_final") != V.INCOMING).select(*V.TEAM_RACE_KEY, "asset_id"),
        asset_race.select(*ASSET_KEY, "value"), ASSET_KEY, "left", proof=asset_race,
    )
    complete = (F.count(F.lit(1)) == size) & (F.count("value") == size)
    values = priced.groupBy(*V.TEAM_RACE_KEY).agg(
        F.when(complete, F.round(F.sum("value"), 1)).alias("calculated_asset_value")
    )
    limitless = usage.filter(F.col("chip_id") == V.LIMITLESS).select(
        "season", F.col("race_used").alias("race_number"), "user_guid", "team_no"
    )
    return values.join(limitless, V.TEAM_RACE_KEY, "left_anti")


def _team_history() -> Window:
    return Window.partitionBy(*V.TEAM_KEY).orderBy("race_number")


def with_cumulative_points(team_race: DataFrame) -> DataFrame:
    """Running points of each team, race after race."""
    so_far = _team_history().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return team_race.withColumn("cumulative_points", F.sum("race_points").over(so_far))


def with_wealth_change(metrics: DataFrame) -> DataFrame:
    """Change since the team's own previous snapshot, whichever race that was."""
    before = F.lag("total_wealth").over(_team_history())
    return metrics.withColumn("wealth_change", F.round(F.col("total_wealth") - before, 1))


def team_metrics(
    team_race: DataFrame, values: DataFrame, races: DataFrame, carried: DataFrame | None = None,
) -> DataFrame:
    """Performance and finances of each team and race, without the league averages.

    Running points and wealth change share one window, so one shuffle and one sort by team. If
    `team_race` begins in the middle of a season, `carried` is the state of all teams before it, see
    `team_state`. It comes back as a row of each team's last race, with points so far for its points.

    The wide rows are sorted in as many tasks as a shuffle has partitions. The runtime planner would
    merge these until a task spills.
    """
    parts = int(team_race.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    recorded = F.col("recorded_asset_value")
    calculated = F.col("calculated_asset_value")
    asset_value = F.coalesce(recorded, calculated)
    wealth = F.coalesce("recorded_total_budget", asset_value + F.col("remaining_budget"))
    rows = (
        attach_small(team_race, races.select(*V.RACE_KEY, "race_name"), V.RACE_KEY, proof=races)
        .repartition(parts, *V.TEAM_RACE_KEY).join(values, V.TEAM_RACE_KEY, "left")
        .select(
            "season", "race_number", "race_name", "user_guid", "team_no", "team_name",
            "race_points", "race_rank", "recorded_asset_value", "remaining_budget",
            "recorded_total_budget", "calculated_asset_value",
            asset_value.alias("asset_value"), F.round(wealth, 1).alias("total_wealth"),
            F.when(recorded.isNotNull(), "recorded").when(calculated.isNotNull(), "calculated")
            .otherwise("unavailable").alias("valuation_source"),
        )
    )
    if carried is not None:
        rows = rows.unionByName(carried.select(
            "season", F.col("last_race").alias("race_number"), "user_guid", "team_no", "team_name",
            F.col("cumulative_points").alias("race_points"), "total_wealth",
        ), allowMissingColumns=True)
    return with_wealth_change(with_cumulative_points(rows.repartition(parts, *V.TEAM_KEY)))


#: What the races after one need to know of each team.
STATE = [*V.TEAM_RACE_KEY, "last_race", "team_name", "cumulative_points", "total_wealth"]


def team_state(metrics: DataFrame, loaded: DataFrame) -> DataFrame:
    """Each team's last row as of every race of `loaded`: race_number is the race it holds after.

    A team that is not on the board of a race keeps the row of the race before.
    """
    after = F.lead("race_number").over(_team_history())
    known = loaded.groupBy("season").agg(F.collect_list("race_number").alias("__loaded"))
    rows = attach_small(
        metrics.select(*V.TEAM_RACE_KEY, "team_name", "cumulative_points", "total_wealth",
                       after.alias("__next")), known, ["season"], proof=loaded)
    holds = F.filter("__loaded", lambda r: (r >= F.col("race_number")) & (
        F.col("__next").isNull() | (r < F.col("__next"))))
    return rows.select(
        "season", F.explode(holds).alias("race_number"), "user_guid", "team_no",
        F.col("race_number").alias("last_race"), "team_name", "cumulative_points", "total_wealth")


def league_averages(metrics: DataFrame) -> DataFrame:
    """One row per race: the values a whole-race window average would repeat on every row.

    As a grouped aggregate it combines on the map side, so the largest race costs no more than the
    others. Means are taken over decimals, which add up alike in any order.
    """
    return metrics.groupBy(*V.RACE_KEY).agg(
        F.round(exact_mean("race_points", 4), 2).cast("double")
        .alias("league_average_race_points"),
        F.round(exact_mean("cumulative_points", 4), 2).cast("double")
        .alias("league_average_cumulative_points"),
        F.round(exact_mean("total_wealth", 1), 1).cast("double")
        .alias("league_average_total_wealth"),
    )


TEAM_RACE_MART = [
    "season", "race_number", "race_name", "user_guid", "team_no", "team_name", "race_points",
    "race_rank", "cumulative_points", "league_average_race_points", "recorded_asset_value",
    "remaining_budget", "recorded_total_budget", "calculated_asset_value", "asset_value",
    "total_wealth", "valuation_source", "wealth_change", "league_average_cumulative_points",
    "league_average_total_wealth",
]


def team_race_mart(
    metrics: DataFrame, races: DataFrame, averages: DataFrame | None = None,
) -> DataFrame:
    """Metrics with the league averages of their race, which are computed here if not given.

    The metrics are read twice, so a caller with large facts stages them first. There are at most
    as many averages as races in the calendar, which is what the broadcast is checked against. The
    rows stay where they lie, so what comes of metrics in buckets is in buckets.
    """
    averages = league_averages(metrics) if averages is None else averages
    return attach_small(metrics, averages, V.RACE_KEY, proof=races).select(*TEAM_RACE_MART)


# --- chips ------------------------------------------------------------------------------------

def team_chips(
    team_race: DataFrame, usage: DataFrame, chips: DataFrame, races: DataFrame, mart: DataFrame,
) -> DataFrame:
    """Every chip of every team with its status, race, score and league average.

    A team's uses, one per chip at most, and its scores, one per race at most, are gathered by team
    and meet its row there. Only then are the chips spread out, so the grid is never moved. Of tables
    that lie in buckets by team (`stage_by`) no row moves at all. The chips are a declared dimension;
    its size is checked before its rows become part of the plan.
    """
    if not fits(chips, MOST_CHIPS):
        raise ValueError(f"more than {MOST_CHIPS} chips")
    every_chip = F.array(*[
        F.struct(F.lit(c.chip_id).cast("bigint").alias("chip_id"),
                 F.lit(c.display_name).cast("string").alias("chip_name"),
                 F.lit(c.chip_short_name).cast("string").alias("chip_short_name"),
                 F.lit(c.available_first_race).cast("bigint").alias("available_first_race"))
        for c in chips.collect()
    ])
    teams = team_race.groupBy(*V.TEAM_KEY).agg(
        F.max_by("team_name", "race_number").alias("team_name"),
        F.max("race_number").alias("last_observed_race"),
    )
    places = races.select(
        "season", F.col("race_number").alias("race_used"),
        F.col("race_name").alias("race_used_name"),
        F.col("race_short_name").alias("race_used_short_name"),
    )
    uses = attach_small(
        usage.select(*V.TEAM_KEY, "chip_id", "race_used"), places, ["season", "race_used"], "left",
        proof=races,
    ).groupBy(*V.TEAM_KEY).agg(F.collect_list(F.struct(
        "chip_id", "race_used", "race_used_name", "race_used_short_name")).alias("uses"))
    scores = mart.groupBy(*V.TEAM_KEY).agg(F.collect_list(F.struct(
        "race_number", "race_points", "league_average_race_points")).alias("scores"))
    status = (
        F.when(F.col("race_used").isNull(), "unused")
        .when(F.col("race_used") > F.col("last_observed_race"), "upcoming").otherwise("used")
    )
    first = lambda found: F.get(found, F.lit(0))
    grid = (
        teams.join(uses, V.TEAM_KEY, "left").join(scores, V.TEAM_KEY, "left")
        .withColumn("chip", F.explode(every_chip))
        .withColumn("use", first(F.filter("uses", lambda u: u.chip_id == F.col("chip.chip_id"))))
        .withColumn("score", first(F.filter(
            "scores", lambda s: s.race_number == F.col("use.race_used"))))
        .select(*teams.columns, "chip.*", "use.race_used", "use.race_used_name",
                "use.race_used_short_name", F.col("score.race_points").alias("chip_race_points"),
                "score.league_average_race_points")
    )
    return grid.select(
        "season", "user_guid", "team_no", "team_name", "last_observed_race", "chip_id",
        "chip_name", "chip_short_name", "available_first_race", "race_used",
        status.alias("chip_status"), "race_used_name", "race_used_short_name",
        "chip_race_points", "league_average_race_points",
    )
