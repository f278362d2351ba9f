"""Exploratory checks of rosters, valuations and transfers, each a query someone needs to ask."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import exact_mean
from pitlane.operators.joins import attach_small, deal_out
from pitlane.sources.tables import stack

PRICE_KEY = V.KEYS["asset_race"]


def _rows():
    return F.count(F.lit(1))


def _uses(usage: DataFrame, *columns: str) -> DataFrame:
    """Chip uses keyed like a team race."""
    return usage.select(
        "season", F.col("race_used").alias("race_number"), "user_guid", "team_no", *columns
    )


# --- valuation --------------------------------------------------------------------------------

def valuation_backtest(
    team_race: DataFrame, roster: DataFrame, asset_race: DataFrame, usage: DataFrame,
    size: int = V.ROSTER_SIZE,
) -> DataFrame:
    """Roster value at the prices of race N and of race N+1 against the recorded value.

    Only complete rosters priced in both feeds, and only races without a chip.
    """
    here = asset_race.select(*PRICE_KEY, F.col("value").alias("price_n"))
    after = asset_race.select(
        "season", (F.col("race_number") - 1).alias("race_number"), "asset_id",
        F.col("value").alias("price_next"),
    )
    priced = attach_small(
        attach_small(roster.select(*V.TEAM_RACE_KEY, "asset_id"), here, PRICE_KEY, "left",
                     proof=asset_race),
        after, PRICE_KEY, "left", proof=asset_race,
    )
    values = priced.groupBy(*V.TEAM_RACE_KEY).agg(
        _rows().alias("assets"), F.count("price_n").alias("found_n"),
        F.count("price_next").alias("found_next"),
        F.round(F.sum("price_n"), 1).alias("value_feed_n"),
        F.round(F.sum("price_next"), 1).alias("value_feed_next"),
    ).filter((F.col("assets") == size) & (F.col("found_n") == size)
             & (F.col("found_next") == size))
    recorded = F.col("recorded_asset_value")
    return (
        team_race.filter(recorded.isNotNull())
        .select(*V.TEAM_RACE_KEY, "team_name", "recorded_asset_value")
        .join(values, V.TEAM_RACE_KEY)
        .join(_uses(usage), V.TEAM_RACE_KEY, "left_anti")
        .select(
            *V.TEAM_RACE_KEY, "team_name", "recorded_asset_value", "value_feed_n",
            "value_feed_next",
            F.round(F.col("value_feed_n") - recorded, 2).alias("difference_n"),
            F.round(F.col("value_feed_next") - recorded, 2).alias("difference_next"),
        ).orderBy("race_number", "team_name", *V.TEAM_KEY)
    )


def valuation_backtest_summary(backtest: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Records, matches and mean absolute difference of each price feed."""
    gap = F.abs("difference")
    return (
        backtest.select(F.col("difference_n").alias("Race N"),
                        F.col("difference_next").alias("Race N+1"))
        .unpivot([], ["Race N", "Race N+1"], "price_feed", "difference")
        .groupBy("price_feed").agg(
            _rows().alias("records_compared"),
            F.count_if(gap <= tolerance).alias("matching_records"),
            exact_mean(gap, 2).cast("double").alias("mean_absolute_difference"),
        )
    )


def chip_race_valuations(
    team_race: DataFrame, usage: DataFrame, chips: DataFrame,
) -> DataFrame:
    """Recorded money of each team in the races where it used a chip."""
    names = chips.select("chip_id", F.col("display_name").alias("chip"))
    uses = attach_small(_uses(usage, "chip_id"), names, ["chip_id"], proof=chips)
    return team_race.join(uses, V.TEAM_RACE_KEY).select(
        *V.TEAM_RACE_KEY, "team_name", "chip", "recorded_asset_value", "remaining_budget",
        "recorded_total_budget",
    ).orderBy("chip", "race_number", *V.TEAM_KEY)


def chip_roster_values(
    team_race: DataFrame, usage: DataFrame, chips: DataFrame, roster: DataFrame,
    asset_race: DataFrame,
) -> DataFrame:
    """Value of all, the original and the replacement roster in each chip race.

    A roster is summed once per team and race, however many chips were used there; assets without
    a price row are left out, and a roster without any such asset as well.
    """
    price = F.col("value")

    def without(status):
        return F.round(F.sum(F.when(F.col("is_final") != status, price).otherwise(0.0)), 1)

    sums = (
        attach_small(roster.select(*V.TEAM_RACE_KEY, "asset_id", "is_final"),
                     asset_race.select(*PRICE_KEY, "value"), PRICE_KEY, proof=asset_race)
        .groupBy(*V.TEAM_RACE_KEY).agg(
            F.round(F.sum(price), 1).alias("all_asset_value"),
            without(V.INCOMING).alias("original_roster_value"),
            without(V.OUTGOING).alias("replacement_roster_value"),
        )
    )
    names = chips.select("chip_id", F.col("display_name").alias("chip"))
    uses = attach_small(_uses(usage, "chip_id"), names, ["chip_id"], proof=chips).drop("chip_id")
    recorded = team_race.select(*V.TEAM_RACE_KEY, "team_name", "recorded_asset_value")
    return uses.join(recorded, V.TEAM_RACE_KEY).join(sums, V.TEAM_RACE_KEY).select(
        *V.TEAM_RACE_KEY, "team_name", "chip", "recorded_asset_value", "all_asset_value",
        "original_roster_value", "replacement_roster_value",
    ).orderBy("chip", "race_number", *V.TEAM_KEY)


# --- marts ------------------------------------------------------------------------------------

def mart_preview(mart: DataFrame, limit: int = 15) -> DataFrame:
    return mart.orderBy("user_guid", "team_no", "race_number", "season").limit(limit)


def valuation_source_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("valuation_source").agg(
        _rows().alias("rows"), F.count_if(F.col("total_wealth").isNull()).alias("missing_wealth")
    )


def mart_health(mart: DataFrame) -> DataFrame:
    """Rows, repeated keys and missing measures, in one pass grouped by key."""
    late_gap = (F.col("race_number") > 1) & F.col("wealth_change").isNull()
    gaps = mart.select(*V.TEAM_RACE_KEY, F.col("total_wealth").isNull().alias("no_wealth"),
                       late_gap.alias("no_change"))
    by_key = deal_out(gaps, V.TEAM_RACE_KEY, mart).groupBy(*V.TEAM_RACE_KEY).agg(
        _rows().alias("n"), F.count_if("no_wealth").alias("no_wealth"),
        F.count_if("no_change").alias("no_change"),
    )
    return by_key.agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_keys"),
        F.sum("no_wealth").alias("missing_wealth"),
        F.sum("no_change").alias("missing_wealth_change_after_race_1"),
    )


def chip_status_counts(chips: DataFrame) -> DataFrame:
    return chips.groupBy("chip_status").agg(_rows().alias("rows"))


# --- coverage ---------------------------------------------------------------------------------

def season_coverage(team_race: DataFrame) -> DataFrame:
    """First, latest and number of loaded races. The rows are reduced to races first."""
    return team_race.select(*V.RACE_KEY).distinct().groupBy("season").agg(
        F.min("race_number").alias("first_race"), F.max("race_number").alias("latest_race"),
        _rows().alias("races_loaded"),
    )


def valuation_coverage(team_race: DataFrame) -> DataFrame:
    """Present and missing recorded money by race, and rows where only one of the two is missing."""
    value, budget = F.col("recorded_asset_value"), F.col("recorded_total_budget")
    return team_race.groupBy(*V.RACE_KEY).agg(
        _rows().alias("team_count"),
        F.count(value).alias("asset_value_available"),
        F.count(budget).alias("total_budget_available"),
        F.count_if(value.isNull()).alias("missing_asset_value"),
        F.count_if(budget.isNull()).alias("missing_total_budget"),
        F.count_if(value.isNull() != budget.isNull()).alias("mismatched_missingness"),
    ).orderBy(*V.RACE_KEY)


def teams_departed(team_race: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Teams of one race that are absent from another; both given as (season, race_number)."""
    def at(races):
        return attach_small(team_race, races, V.RACE_KEY, "left_semi")

    return at(first).select(*V.TEAM_KEY, "team_name").join(
        at(second).select(*V.TEAM_KEY), V.TEAM_KEY, "left_anti"
    )


def cardinality_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct non-null values of each column.

    Values are made distinct as (column, value) pairs first, so the shuffle is spread over values
    and not over the few columns.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], columns, "column", "value").distinct()
        .groupBy("column").agg(F.count("value").alias("distinct_values"))
    )


# --- rosters ----------------------------------------------------------------------------------

def unusual_rosters(roster: DataFrame, size: int = V.ROSTER_SIZE) -> DataFrame:
    return roster.groupBy(*V.TEAM_RACE_KEY, "team_name").agg(_rows().alias("asset_count")).filter(
        F.col("asset_count") != size
    ).orderBy("race_number", "team_no", "season", "user_guid")


def lineup_detail(roster: DataFrame, asset_race: DataFrame, **team: object) -> DataFrame:
    """Lineups with asset names, in slot order; `team` narrows any key column to a value."""
    chosen = roster
    for column, value in team.items():
        chosen = chosen.filter(F.col(column) == value)
    named = asset_race.select(*PRICE_KEY, "display_name", "asset_type")
    return attach_small(chosen, named, PRICE_KEY, proof=asset_race).select(
        *V.TEAM_RACE_KEY, "asset_id", "display_name", "asset_type", "is_final",
        "player_position", "is_captain", "is_mg_captain",
    ).orderBy(*V.TEAM_RACE_KEY, "player_position", "is_final")


def code_frequencies(roster: DataFrame, asset_race: DataFrame) -> DataFrame:
    """Rows per swap status, per asset type and per pair of captain flags."""
    def counted(df, name, code):
        return df.groupBy(code.alias("code")).agg(_rows().alias("rows")).select(
            F.lit(name).alias("field"), "code", "rows"
        )

    flags = F.concat_ws(",", F.col("is_captain").cast("string"),
                        F.col("is_mg_captain").cast("string"))
    return stack([
        counted(roster, "is_final", F.col("is_final").cast("string")),
        counted(asset_race, "asset_type", F.col("asset_type")),
        counted(roster, "is_captain,is_mg_captain", flags),
    ])


def captain_anomalies(roster: DataFrame) -> DataFrame:
    """Rosters without exactly one captain, or with more than one triple-boosted asset."""
    return roster.groupBy(*V.TEAM_RACE_KEY).agg(
        F.sum("is_captain").alias("captain_count"), F.sum("is_mg_captain").alias("x3_count")
    ).filter("captain_count != 1 OR x3_count > 1")


def boosted_constructors(roster: DataFrame, asset_race: DataFrame) -> DataFrame:
    """Roster rows that boost something other than a driver."""
    boosted = roster.filter("is_captain = 1 OR is_mg_captain = 1")
    others = asset_race.filter(F.col("asset_type") != "DRIVER").select(*PRICE_KEY)
    found = attach_small(boosted, others, PRICE_KEY, "left_semi", proof=asset_race)
    return found.select(*roster.columns)


# --- money ------------------------------------------------------------------------------------

def budget_mismatches(team_race: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Rows whose recorded value and cash do not add up to the recorded budget."""
    gap = (F.col("recorded_asset_value") + F.col("remaining_budget")
           - F.col("recorded_total_budget"))
    return team_race.filter(F.abs(gap) > tolerance).select(
        *V.TEAM_RACE_KEY, "team_name", "recorded_asset_value", "remaining_budget",
        "recorded_total_budget", F.round(gap, 4).alias("difference"),
    ).orderBy("race_number", "team_name", *V.TEAM_KEY)


RANGES = [
    "race_rank", "remaining_budget", "transfers_made", "free_transfers_remaining",
]


def numeric_ranges(team_race: DataFrame, asset_race: DataFrame) -> DataFrame:
    """Least and greatest value of the measures, one row each."""
    def ranges(df, columns):
        doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return doubles.unpivot([], columns, "measure", "value").groupBy("measure").agg(
            F.min("value").alias("least"), F.max("value").alias("greatest")
        )

    return stack([ranges(team_race, RANGES), ranges(asset_race, ["value"])])


def negative_free_transfers(team_race: DataFrame) -> DataFrame:
    return team_race.filter("free_transfers_remaining < 0").select(
        *V.TEAM_RACE_KEY, "team_name", "transfers_made", "free_transfers_remaining"
    ).orderBy("race_number", "team_name", *V.TEAM_KEY)


def assets_by_type(asset_race: DataFrame) -> dict[str, DataFrame]:
    """Drivers and constructors apart."""
    return {kind: asset_race.filter(F.col("asset_type") == kind)
            for kind in ("DRIVER", "CONSTRUCTOR")}
