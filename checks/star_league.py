"""A fantasy league read out of the star-schema test tables.

Season = year, race = month, team = customer, asset = part brand. The league tables are derived
by Spark from the whole of orders, lineitem and part, written once per session to the shared
folder, and then read by the queries like any prepared table. FIXTURES.md states the rules.
"""

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.operators.joins import TASK_ROWS, attach_small, parts_for
from pitlane.operators.ranking import competition_rank
from pitlane.plans import marts, names, profiles
from pitlane.plans.views import loaded_races
from pitlane.sources.tables import stage, stage_by

AS_OF = date(2001, 9, 1)

# The six chips.
CHIP_ROWS = """
    (1, 'Limitless', 2, 'LL'), (2, 'Wildcard', 2, 'WC'), (3, 'Final Fix', 2, 'FF'),
    (4, 'Auto Pilot', 1, 'AP'), (5, 'No Negative', 1, 'NN'), (6, 'x3 Boost', 1, 'X3')
"""

# Column rules that Spark and the comparison SQL share as text.
ASSET_TYPE = "CASE WHEN asset_id > 17 THEN 'CONSTRUCTOR' ELSE 'DRIVER' END"
ASSET_VALUE = ("CASE WHEN (asset_id*7+race_number*3+season) % 61 = 0 THEN NULL "
               "ELSE tenths/10.0E0 END")
SELECTED = "CAST((asset_id*37+race_number) % 1000 AS BIGINT)/10.0E0"
RECORDED_VALUE = ("CASE WHEN (cust+race_number) % 3 = 0 "
                  "THEN 900+(cust*13+race_number*17) % 300 END/10.0E0")
REMAINING = "((cust*7+race_number) % 50)/10.0E0"
RECORDED_BUDGET = ("CASE WHEN (cust+race_number) % 6 = 0 OR (cust+race_number) % 7 = 1 "
                   "THEN 900+(cust*13+race_number*17) % 300+(cust*7+race_number) % 50 END/10.0E0")
TEAM_NO = "CAST(1 + cust % 3 AS BIGINT)"
RACE_DATE = ("CAST(concat(CAST(season AS VARCHAR(20)),'-',"
             "lpad(CAST(race_number AS VARCHAR(20)),2,'0'),'-28') AS DATE)")


def _year(c):
    return F.year(c).cast("bigint")


def _month(c):
    return F.month(c).cast("bigint")


class StarLeague:
    """League tables and marts of one folder of star-schema tables, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- league tables ------------------------------------------------------------------------

    @cached_property
    def chips(self) -> DataFrame:
        return self.spark.sql(
            "SELECT CAST(chip_id AS BIGINT) chip_id, display_name, "
            "CAST(available_first_race AS BIGINT) available_first_race, chip_short_name "
            f"FROM VALUES {CHIP_ROWS} AS c(chip_id, display_name, available_first_race, "
            "chip_short_name)"
        )

    @cached_property
    def _asset_sums(self) -> DataFrame:
        sold = self.table("lineitem").join(
            self.table("part"), F.col("l_partkey") == F.col("p_partkey")
        ).select(
            _year("l_shipdate").alias("season"), _month("l_shipdate").alias("race_number"),
            F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint").alias("asset_id"),
            F.round("l_extendedprice").cast("bigint").alias("price"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
        )
        return stage(sold.groupBy("season", "race_number", "asset_id").agg(
            F.floor(F.sum("price") / (F.count(F.lit(1)) * 500)).cast("bigint").alias("tenths"),
            F.sum("quantity").alias("gameday_points"),
        ), "asset_sums")

    @cached_property
    def asset_race(self) -> DataFrame:
        history = Window.partitionBy("season", "asset_id").orderBy("race_number")
        so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return stage(self._asset_sums.select(
            "season", "race_number", "asset_id", F.expr(ASSET_TYPE).alias("asset_type"),
            F.concat(F.lit("Asset "), F.col("asset_id").cast("string")).alias("display_name"),
            F.expr(ASSET_VALUE).alias("value"),
            (F.lag("tenths").over(history) / F.lit(10.0)).alias("old_asset_value"),
            "gameday_points",
            F.sum("gameday_points").over(so_far).cast("double").alias("overall_points"),
            F.expr(SELECTED).alias("selected_percentage"),
            F.lit(None).cast("timestamp").alias("retrieved_at_utc"),
            F.lit(None).cast("timestamp").alias("feed_time_utc"),
        ), "asset_race", V.RACE_KEY)

    @cached_property
    def _team_sums(self) -> DataFrame:
        return stage(self.table("orders").groupBy(
            _year("o_orderdate").alias("season"), _month("o_orderdate").alias("race_number"),
            F.col("o_custkey").alias("cust"),
        ).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.floor(F.col("o_totalprice") / 1000).cast("bigint")).cast("double")
            .alias("race_points"),
        ), "team_sums")

    @cached_property
    def races(self) -> DataFrame:
        keys = self._team_sums.select("season", "race_number").union(
            self._asset_sums.select("season", "race_number")
        ).distinct()
        number = F.col("race_number").cast("string")
        return stage(keys.select(
            "season", "race_number", F.concat(F.lit("Round "), number).alias("race_name"),
            F.concat(F.lit("R"), number).alias("race_short_name"),
            F.expr(RACE_DATE).alias("race_date"),
            (F.col("race_number") % 4 == 0).alias("sprint_weekend"),
        ).coalesce(1), "races")

    @cached_property
    def team_race(self) -> DataFrame:
        ranked = competition_rank(
            self._team_sums, ["season", "race_number"], "race_points", "race_rank"
        )
        return stage(ranked.select(
            "season", "race_number", F.col("cust").cast("string").alias("user_guid"),
            F.expr(TEAM_NO).alias("team_no"),
            F.concat(F.lit("Team "), F.col("cust").cast("string")).alias("team_name"),
            "race_points", "race_rank", F.expr(RECORDED_VALUE).alias("recorded_asset_value"),
            F.expr(REMAINING).alias("remaining_budget"),
            F.expr(RECORDED_BUDGET).alias("recorded_total_budget"),
            F.col("n").alias("transfers_made"), (2 - F.col("n")).alias("free_transfers_remaining"),
        ), "team_race")

    @cached_property
    def _uses(self) -> DataFrame:
        """Chip uses by customer: a use is kept in a race that is to come or was played."""
        last = self._team_sums.groupBy("season").agg(F.max("race_number").alias("last"))
        # At most twelve months per customer and year.
        seasons = self._team_sums.groupBy("season", "cust").agg(
            F.collect_set("race_number").alias("played")
        )
        chip = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(6).cast("bigint")))
        planned = seasons.withColumn("chip_id", chip).filter("(cust+chip_id) % 2 = 0").withColumn(
            "race_used", F.expr("1+(cust*5+chip_id*3+season) % 12")
        )
        known = self.races.select("season", F.col("race_number").alias("race_used"))
        dated = attach_small(planned, known, ["season", "race_used"], proof=self.races)
        return stage(
            attach_small(dated, last, ["season"], proof=self.races)
            .filter((F.col("race_used") > F.col("last"))
                    | F.array_contains("played", F.col("race_used")))
            .select("season", "cust", "chip_id", "race_used"), "uses")

    @cached_property
    def team_chip_usage(self) -> DataFrame:
        return self._uses.select(
            "season", F.col("cust").cast("string").alias("user_guid"),
            F.expr(TEAM_NO).alias("team_no"),
            F.concat(F.lit("Team "), F.col("cust").cast("string")).alias("team_name"),
            "chip_id", "race_used",
        )

    @cached_property
    def team_race_asset(self) -> DataFrame:
        active = self._uses.filter("chip_id IN (3, 6)").groupBy(
            "season", "cust", F.col("race_used").alias("race_number")
        ).agg(F.max(F.col("chip_id") == 3).alias("fix"), F.max(F.col("chip_id") == 6).alias("x3"))
        zero = F.lit(0).cast("bigint")
        # Teams are dealt out by race before their seven or eight rows are spread out. Ranges split a
        # race that very many teams share.
        rows = (
            self._team_sums.join(active, ["season", "cust", "race_number"], "left")
            .na.fill(False, ["fix", "x3"])
            .repartitionByRange(parts_for(self._team_sums, TASK_ROWS // 8), *V.RACE_KEY, "cust")
            .withColumn("k", F.explode(F.sequence(zero, F.when(F.col("fix"), zero + 7)
                                                  .otherwise(zero + 6))))
        )
        return stage(rows.select(
            "season", "race_number", F.col("cust").cast("string").alias("user_guid"),
            F.expr(TEAM_NO).alias("team_no"),
            F.concat(F.lit("Team "), F.col("cust").cast("string")).alias("team_name"),
            F.expr("1+(cust*11+season+race_number*5+k*4) % 25").alias("asset_id"),
            F.when(F.col("k") == 0, 1).otherwise(0).cast("bigint").alias("is_captain"),
            F.when((F.col("k") == 0) & F.col("x3"), 1).otherwise(0).cast("bigint")
            .alias("is_mg_captain"),
            (F.col("k") + 1).alias("player_position"),
            F.when(~F.col("fix"), 0).when(F.col("k") == 6, 2).when(F.col("k") == 7, 1)
            .otherwise(0).cast("bigint").alias("is_final"),
        ), "team_race_asset", V.RACE_KEY, dealt=True)

    # --- marts --------------------------------------------------------------------------------

    def build_team_metrics(self) -> DataFrame:
        values = marts.roster_values(self.team_race_asset, self.asset_race, self.team_chip_usage)
        return stage_by(marts.team_metrics(self.team_race, values, self.races), "team_metrics",
                        V.TEAM_KEY)

    def build_team_race_mart(self) -> DataFrame:
        return marts.team_race_mart(self.build_team_metrics(), self.races)

    @cached_property
    def team_metrics(self) -> DataFrame:
        return self.build_team_metrics()

    @cached_property
    def usage_by_team(self) -> DataFrame:
        return stage_by(self.team_chip_usage, "usage_by_team", V.TEAM_KEY)

    @cached_property
    def averages(self) -> DataFrame:
        return stage(marts.league_averages(self.team_metrics), "averages")

    @cached_property
    def mart_team_race(self) -> DataFrame:
        dealt = self.team_metrics.repartitionByRange(
            parts_for(self.team_metrics, TASK_ROWS // 4), *V.RACE_KEY, "user_guid")
        return stage(marts.team_race_mart(dealt, self.races, self.averages), "mart_team_race",
                     V.RACE_KEY, dealt=True)

    @cached_property
    def profile_team_race(self) -> DataFrame:
        return stage(profiles.profile(self.team_race), "profile_team_race", V.RACE_KEY)

    @cached_property
    def team_names(self) -> DataFrame:
        return stage(names.index(names.first_names(self.team_race)), "team_names", V.RACE_KEY)

    @cached_property
    def loaded_races(self) -> DataFrame:
        return stage(loaded_races(self.mart_team_race).coalesce(1), "loaded_races")

    def build_team_chips(self) -> DataFrame:
        return marts.team_chips(
            self.team_metrics, self.usage_by_team, self.chips, self.races,
            marts.team_race_mart(self.team_metrics, self.races, self.averages))

    @cached_property
    def mart_team_chips(self) -> DataFrame:
        return stage(self.build_team_chips(), "mart_team_chips")

    @cached_property
    def mart_assets_latest(self) -> DataFrame:
        return stage(marts.assets_latest(self.asset_race, self.races, AS_OF), "assets_latest")

    @cached_property
    def loaded_rosters(self) -> DataFrame:
        return stage(loaded_races(self.team_race_asset).coalesce(1), "loaded_rosters")

    def build_team_assets_latest(self) -> DataFrame:
        return marts.team_assets_latest(
            self.team_race_asset, self.team_race, self.mart_assets_latest, self.races,
            self.loaded_rosters,
        )

    @cached_property
    def mart_team_assets_latest(self) -> DataFrame:
        return stage(self.build_team_assets_latest(), "team_assets_latest")

    @cached_property
    def mart_asset_value_changes(self) -> DataFrame:
        return marts.asset_value_changes(self.asset_race)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "asset_race": self.asset_race, "team_race": self.team_race,
            "team_race_asset": self.team_race_asset, "team_chip_usage": self.team_chip_usage,
            "races": self.races, "chips": self.chips,
        }


_leagues: dict[tuple[str, str], StarLeague] = {}


def star_league(spark: SparkSession, folder: str) -> StarLeague:
    """The league of a folder, kept for the running application so its tables are written once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _leagues:
        _leagues[key] = StarLeague(spark, folder)
    return _leagues[key]
