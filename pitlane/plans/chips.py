"""Reports on chip use. `chips` is the chip mart: six rows per team."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.operators.joins import deal_out, join_one_to_one
from pitlane.operators.ranking import sequential_position
from pitlane.sources.tables import stage

TEAM = [*V.TEAM_KEY, "team_name"]


def _name() -> Column:
    """A team's name, the same in all of its rows, kept out of the shuffle key."""
    return F.max("team_name").alias("team_name")


def team_order(chips: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    """Teams numbered 0, 1, ... within their season.

    By championship rank, absent teams last, where `ranked` holds league_rank; else by name.
    """
    teams = chips.groupBy(*V.TEAM_KEY).agg(_name())
    if ranked is None:
        return sequential_position(
            teams, ["season"], ["team_name", "user_guid", "team_no"], "display_order"
        )
    ranks = ranked.select(*V.TEAM_KEY, "league_rank")
    return sequential_position(
        join_one_to_one(teams, ranks, V.TEAM_KEY, "league ranks"),
        ["season"],
        [F.asc_nulls_last("league_rank"), "team_name", "user_guid", "team_no"], "display_order",
    )


def chip_label() -> Column:
    """What a chip cell shows."""
    place = F.col("race_used_short_name")
    upcoming = F.col("chip_status") == "upcoming"
    return (
        F.when(F.col("chip_status") == "unused", V.UNUSED_MARK)
        .when(upcoming & place.isNull(), "Upcoming")
        .when(upcoming, F.concat(F.lit("Upcoming" + V.PLACE_SEPARATOR), place))
        .when(place.isNull(), "Used").otherwise(place)
    )


def known_chips(chips: DataFrame) -> list[int]:
    """The chips of the mart in order: one row per chip."""
    return [r.chip_id for r in chips.select("chip_id").distinct().orderBy("chip_id").collect()]


def races_so_far(chips: DataFrame) -> list[int]:
    """1 to the latest observed race."""
    return list(range(1, (latest_observed_race(chips).first().latest_race or 0) + 1))


def _all_within(found: Column, wanted: list[int], what: str) -> Column:
    """True, or an error if an array of numbers holds one that isn't wanted."""
    outside = F.array_except(found, F.array(*[F.lit(n).cast("bigint") for n in wanted]))
    fail = F.raise_error(F.concat(F.lit(f"{what} outside the columns: "), F.to_json(outside)))
    return F.when(F.size(outside) > 0, fail.cast("boolean")).otherwise(F.lit(True))


def chip_matrix(
    chips: DataFrame, order: DataFrame, chip_ids: list[int] | None = None,
) -> DataFrame:
    """One row per team, one column per chip: those given, or those of the mart.

    A chip that occurs twice in a team or has no column raises, and so does a team that occurs twice
    in the order. The labels of a team, one per chip, are gathered once and the columns are read out
    of the list.
    """
    chip_ids = known_chips(chips) if chip_ids is None else chip_ids
    label = F.struct("chip_id", chip_label().alias("label"))
    teams = chips.groupBy(*V.TEAM_KEY).agg(
        _name(), F.max("last_observed_race").alias("last_observed_race"),
        F.collect_list(label).alias("cells"),
    )
    twice = F.raise_error(F.lit("duplicate chip rows for a team")).cast("string")

    def cell(chip):
        found = F.filter("cells", lambda c: c.chip_id == chip)
        return F.when(F.size(found) > 1, twice).otherwise(F.get(found, F.lit(0))["label"]).alias(
            f"chip_{chip}")

    numbered = order.select(*V.TEAM_KEY, "display_order")
    whole = teams.filter(_all_within(F.col("cells.chip_id"), chip_ids, "chips"))
    return join_one_to_one(
        whole.select(*TEAM, "last_observed_race", *[cell(chip) for chip in chip_ids]), numbered,
        V.TEAM_KEY, "display order",
    ).select(
        *TEAM, "last_observed_race", *[f"chip_{chip}" for chip in chip_ids], "display_order"
    ).orderBy("season", "display_order")


def chip_timing_matrix(chips: DataFrame, race_numbers: list[int] | None = None) -> DataFrame:
    """One row per team, one column per race, holding the chips used there in chip order.

    The races are those given, or all up to the latest one; a use in another race raises. Every team
    has a row per chip in the mart, so one aggregate by team gives blank rows as well; the list it
    gathers holds those at most. The race columns are then read out of the list.
    """
    race_numbers = races_so_far(chips) if race_numbers is None else race_numbers
    use = F.struct("chip_id", "race_used", "chip_short_name")
    rows = chips.select(*TEAM, F.when(F.col("chip_status") == "used", use).alias("use"))
    teams = deal_out(rows, V.TEAM_KEY, chips).groupBy(*V.TEAM_KEY).agg(
        _name(), F.sort_array(F.collect_list("use")).alias("uses"))

    def used_at(race):
        there = F.filter("uses", lambda u: u.race_used == race)
        names = F.transform(there, lambda u: u.chip_short_name)
        return F.array_join(names, V.CHIP_SEPARATOR).alias(f"r{race}")

    whole = teams.filter(_all_within(F.col("uses.race_used"), race_numbers, "races"))
    return whole.select(*TEAM, *[used_at(race) for race in race_numbers])


def latest_observed_race(chips: DataFrame) -> DataFrame:
    return chips.agg(F.max("last_observed_race").alias("latest_race"))


def timing_headers(matrix: DataFrame, chips: DataFrame, race_numbers: list[int]) -> DataFrame:
    """Rename the race columns of one season to 'R3 · Place'; without a known place to 'R3'.

    What is collected is one row per race column.
    """
    lookup = dict(
        chips.filter((F.col("chip_status") == "used") & F.col("race_used").isin(race_numbers))
        .groupBy("race_used").agg(F.max("race_used_short_name")).collect()
    )
    return matrix.withColumnsRenamed({
        f"r{race}": f"R{race}" + (V.PLACE_SEPARATOR + lookup[race] if lookup.get(race) else "")
        for race in race_numbers
    })


def without_blank_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Drop text columns that are blank in every row, found by one aggregate over all of them.

    The rows are read twice, for the test and for the result, so they are staged.
    """
    tested = [c for c in df.columns if c not in keep]
    rows = stage(df, "tested_for_blanks")
    filled = rows.agg(*[
        F.max(F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) != "").alias(c)
        for c in tested
    ]).first()
    return rows.select(*[f"`{c}`" for c in df.columns if c in keep or filled[c]])


def races_with_chip_use(chips: DataFrame) -> DataFrame:
    """The races a timing table shows, with the number of chips used there."""
    return (
        chips.filter("chip_status = 'used'").groupBy("season", "race_used")
        .agg(F.count(F.lit(1)).alias("chips_used")).orderBy("season", "race_used")
    )


def chip_performance(chips: DataFrame) -> DataFrame:
    """Points above or below the league average in the race where a chip was used."""
    return (
        chips.filter("chip_status = 'used'")
        .dropna(subset=["chip_race_points", "league_average_race_points"])
        .select(*TEAM,
                (F.col("chip_race_points") - F.col("league_average_race_points"))
                .alias("points_vs_average"),
                "chip_id", "chip_name", "race_used_short_name", "chip_race_points",
                "league_average_race_points")
        .orderBy(F.desc("points_vs_average"), *V.TEAM_KEY, "chip_id")
    )
