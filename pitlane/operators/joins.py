"""Joins whose hot keys do not end up in one task.

A fact joined to something keyed by race, asset or score meets hot keys by nature: one race may
hold a third of the league. Such a join either broadcasts a side whose row count was checked, or
spreads each key over a number of salts.
"""

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions.columns import all_of

# Rows a broadcast side may have; dimension rows here are a few hundred bytes at most.
BROADCAST_ROWS = 200_000
# Rows that a task may hold while it sorts or groups them, and the most tasks. Into so many parts
# Spark's shuffle writes rows as they come, without holding them.
TASK_ROWS = 250_000
MOST_PARTS = 200
SALTS = 32
_SALT = "__salt"
_row_counts: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


class CardinalityError(ValueError):
    """A join side that must have unique keys does not."""


def row_count(df: DataFrame) -> int:
    """The rows of df, counted once per frame and summed over its tasks."""
    if df not in _row_counts:
        _row_counts[df] = df.count()
    return _row_counts[df]


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most max_rows rows."""
    return row_count(df) <= min(max_rows, BROADCAST_ROWS)


def parts_for(df: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """How many tasks the rows of df are dealt out to."""
    return min(MOST_PARTS, row_count(df) // task_rows + 1)


def deal_out(df: DataFrame, by: list[str], counted: DataFrame | None = None) -> DataFrame:
    """df dealt out by key before it is grouped, for keys of which next to none repeat.

    Grouping such rows where they are read combines nothing, yet holds every key of a task, which
    grows with the table, and spills. Dealt out first, no task that reads holds rows, and those that
    group hold few. `counted` is a table of as many rows that is cheaper to count.
    """
    return df.repartition(parts_for(df if counted is None else counted), *by)


def attach_small(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", *,
    proof: DataFrame | None = None, max_rows: int = BROADCAST_ROWS, null_safe: bool = False,
) -> DataFrame:
    """Join a fact to a side that is expected to be small, and is checked to be.

    `proof` is a cheaper table that bounds the row count of `small`, such as the calendar for
    anything grouped by race. Beyond the bound the join is salted.
    """
    if not fits(small if proof is None else proof, max_rows):
        return salted_join(big, small, on, how, null_safe=null_safe)
    if not null_safe:
        return big.join(F.broadcast(small), on, how)
    return null_safe_join(big, F.broadcast(small), on, how)


def null_safe_join(big: DataFrame, small: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on equal or equally null keys; the columns are those of a join by name."""
    other = small.withColumnsRenamed({c: f"{c}__other" for c in on})
    same = all_of([F.col(c).eqNullSafe(F.col(f"{c}__other")) for c in on])
    return big.join(other, same, how).drop(*[f"{c}__other" for c in on])


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS, *,
    null_safe: bool = False,
) -> DataFrame:
    """Inner, left, semi or anti join that spreads every key of `big` over `salts` partitions.

    The salt is a hash of the row, not a random number, so a retried task repeats it. Both sides are
    shuffled whatever the planner takes `small` for: it goes by the size of files, in which neither
    packing nor copies count, and a broadcast of all copies does not fit the driver.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no salted form of a {how} join")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    salted = big.withColumn(_SALT, F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
    copies = small.withColumn(_SALT, F.explode(numbers)).hint("merge")
    if null_safe:
        return null_safe_join(salted, copies, [*on, _SALT], how).drop(_SALT)
    return salted.join(copies, [*on, _SALT], how).drop(_SALT)


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Raise unless keys are unique in df. Partial aggregation collapses a hot key first."""
    if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise CardinalityError(f"{what}: duplicate keys on {keys}")
    return df


def unique_rows(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """df as it is, failing when it is read and a key repeats.

    The check is a window by key. It shares its shuffle and sort with a join on the same keys, so it
    costs no pass of its own.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    fail = F.raise_error(F.lit(f"{what}: duplicate keys on {keys}")).cast("boolean")
    return df.withColumn("__copies", copies).filter(
        F.when(F.col("__copies") > 1, fail).otherwise(F.lit(True))
    ).drop("__copies")


def join_one_to_one(
    left: DataFrame, right: DataFrame, on: list[str], what: str, sentinel: str | None = None,
) -> DataFrame:
    """Left join that fails when a key repeats on either side.

    With a `sentinel`, a column of the right side, it also fails when a left row finds no value for
    it. The checks are part of the plan: the query that reads the rows raises.
    """
    joined = unique_rows(left, on, what).join(unique_rows(right, on, what), on, "left")
    if sentinel is None:
        return joined
    fail = F.raise_error(F.lit(f"{what}: rows without details")).cast("boolean")
    return joined.filter(F.when(F.col(sentinel).isNull(), fail).otherwise(F.lit(True)))
