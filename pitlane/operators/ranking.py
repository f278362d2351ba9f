"""Ranks, positions and latest rows that do not sort a whole league in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.operators.joins import null_safe_join
from pitlane.sources.tables import stage

_TALLY = "__tally"
#: Buckets for the scores between a number and its double.
_FINENESS = 4096


def score_bucket(score: Column) -> Column:
    """A whole number that never falls as the score rises; null for null.

    The scores between a number and its double share some thousand buckets, wherever they lie, so
    fractions spread as well as large scores do.
    """
    size = F.abs(score)
    power = F.floor(F.log2(size))
    part = F.floor(size / F.pow(F.lit(2.0), power) * _FINENESS) - _FINENESS
    bucket = (power + 1100) * _FINENESS + part
    return F.when(score == 0, F.lit(0)).otherwise(F.signum(score) * bucket).cast("bigint")


def competition_ranks(df: DataFrame, group: list[str], scores: dict[str, str]) -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY score DESC NULLS LAST) for {score: out}, skew-safe.

    A window would put a whole league into one task. Instead equal scores of all kinds are tallied in
    one aggregate, which combines before its shuffle. Those ahead of a score are the ones in higher
    buckets, summed over the buckets of a group, and the higher ones in its own bucket. The places
    are joined back by a plain join, in which the runtime planner can split a score that very many
    share. Nothing is written.
    """
    kinds = list(scores)
    pairs = F.array(*[
        F.struct(F.lit(i).alias("__kind"), F.col(c).cast("double").alias("__score"))
        for i, c in enumerate(kinds)
    ])
    tallies = (
        df.select(*group, F.inline(pairs)).groupBy(*group, "__kind", "__score")
        .agg(F.count(F.lit(1)).alias(_TALLY))
        .withColumn("__bucket", score_bucket(F.col("__score")))
    )
    of = [*group, "__kind"]
    above = Window.partitionBy(*of).orderBy(F.col("__bucket").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    higher = tallies.groupBy(*of, "__bucket").agg(F.sum(_TALLY).alias("__rows")).select(
        *of, "__bucket", F.coalesce(F.sum("__rows").over(above), F.lit(0)).alias("__above"))
    within = Window.partitionBy(*of, "__bucket").orderBy(
        F.col("__score").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    counted = tallies.withColumn("__ahead", F.coalesce(F.sum(_TALLY).over(within), F.lit(0)))
    places = null_safe_join(counted, higher, [*of, "__bucket"], "inner").select(
        *of, "__score", (F.col("__above") + F.col("__ahead") + 1).cast("bigint").alias("__place"))
    ranked = df
    for i, (score, out) in enumerate(scores.items()):
        own = places.filter(F.col("__kind") == i).select(
            *group, F.col("__score").alias("__value"), F.col("__place").alias(out))
        ranked = null_safe_join(
            ranked.withColumn("__value", F.col(score).cast("double")), own, [*group, "__value"],
            "inner").drop("__value")
    return ranked


def competition_rank(df: DataFrame, group: list[str], score: str, out: str) -> DataFrame:
    return competition_ranks(df, group, {score: out})


def latest_per_key(df: DataFrame, key: list[str], by: str) -> DataFrame:
    """The row with the greatest `by` for each key, as an aggregate with partial combine."""
    rest = [c for c in df.columns if c not in key]
    latest = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(by)).alias("__row"))
    return latest.select(*key, "__row.*").select(*df.columns)


def sequential_position(df: DataFrame, group: list[str], order: list, out: str) -> DataFrame:
    """0, 1, 2, ... within each group in the given order, without one task per group.

    One range-partitioned sort by (group, order) splits large groups over tasks. The sorted rows are
    written with their partition and place in it; per-partition counts, one row per partition and
    group, then give each partition its offset. The order must be total, so pass a unique key last.
    """
    place = "__place"
    ordered = df.orderBy(*group, *order).withColumn(place, F.monotonically_increasing_id())
    written = stage(ordered, "positions")
    # The upper bits of the id are the partition, the lower 33 the place in it.
    part = F.shiftright(F.col(place), 33)
    pieces = written.groupBy(*group, part.alias("__part")).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(place).alias("__first")
    )
    before = (
        Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = pieces.select(
        *group, "__part",
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    # No key of this join has more rows than one sorted partition, so it needs no salt.
    return (
        null_safe_join(written.withColumn("__part", part), offsets, [*group, "__part"], "inner")
        .withColumn(out, (F.col(place) + F.col("__shift")).cast("bigint"))
        .select(*df.columns, out)
    )
