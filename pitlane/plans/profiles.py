"""Profiles of tables that add up: counts and sketches of each part, merged without its rows.

A profile has a row per part and column, with the rows, the nulls and a sketch of the different
values. Counts add up and sketches unite, so a season, or all of them, costs as many rows as there
are parts and columns, however large the table is. Numbers of different values are estimates;
`audits.cardinality_profile` has them exactly.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane import fixed_values as V

#: Registers of a sketch as a power of two: at most 4 KB each.
SKETCH_POWER = 12
#: An estimate's relative error, as 2.6 standard errors (1.04 / sqrt(2 ** 12)): 99 of 100 are nearer.
#: Each column is one such estimate, and small counts are as good as exact.
SKETCH_ERROR = 2.6 * 1.04 / 2 ** (SKETCH_POWER / 2)


def profile(df: DataFrame, by: list[str] = V.RACE_KEY) -> DataFrame:
    """Rows, nulls and a sketch of every column by part: *by, column, rows, nulls, sketch.

    All columns are sketched in one aggregate that combines on the map side. Values count as they
    read as text, nulls not at all; a column of nulls has an empty sketch.
    """
    columns = [c for c in df.columns if c not in by]
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(f"`{c}`").alias(f"filled_{i}") for i, c in enumerate(columns)],
        *[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), SKETCH_POWER).alias(f"sketch_{i}")
          for i, c in enumerate(columns)],
    )
    return counted.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("rows"),
                 (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
                 F.col(f"sketch_{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ])))


def summed(profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profiles of parts as one of each group of `by`, or of all: rows, nulls, distinct_estimate."""
    return profiles.groupBy(*by or [], "column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )


def near(estimate: str, exact: str, error: float = SKETCH_ERROR):
    """Whether an estimate is as near to the exact number as stated, give or take one."""
    return F.abs(F.col(estimate) - F.col(exact)) <= 1 + error * F.col(exact)
