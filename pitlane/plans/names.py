"""Search for a part of a team's name through an index of three characters at a time.

The index holds each name that a team ever had, at the first race that the team had it, once for
every run of three characters in it. So it grows with the number of names and not with races, and a
later race adds the names that it brings. A search reads the names that hold the rarest run of the
text and looks at those alone; what it finds leads to the teams' rows by their key.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import contains_fold

#: Characters of a run.
RUN = 3
#: The run that stands for every name, for texts that hold no run.
ANY = ""
#: Users that are looked up by key; the rows of more are scanned.
MOST_USERS = 1000

_NAME = [*V.TEAM_KEY, "team_name"]


def first_names(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """TEAM_KEY, team_name and the race at which each team's name comes first, without `known` names.

    Rows are combined before the shuffle, so a name held for a whole season moves once a task.
    """
    named = rows.filter(F.col("team_name").isNotNull()).groupBy(*_NAME).agg(
        F.min("race_number").alias("race_number"))
    return named if known is None else named.join(known.select(*_NAME), _NAME, "left_anti")


def runs(name: str) -> Column:
    """All different runs of a name in lower case, and ANY."""
    characters = F.regexp_extract_all(F.lower(name), F.lit("(?s)."), F.lit(0))
    starts = F.when(F.size(characters) >= RUN, F.sequence(F.lit(1), F.size(characters) - RUN + 1))
    found = F.transform(F.coalesce(starts, F.array().cast("array<int>")),
                        lambda i: F.array_join(F.slice(characters, i, RUN), ""))
    return F.array_append(F.array_distinct(found), F.lit(ANY))


def index(names: DataFrame) -> DataFrame:
    """season, race_number, run, user_guid, team_no, team_name: a row for every run of every name."""
    return names.select("season", "race_number", F.explode(runs("team_name")).alias("run"),
                        "user_guid", "team_no", "team_name")


def names_in(indexed: DataFrame) -> DataFrame:
    """The names that an index was made of."""
    return indexed.filter(F.col("run") == ANY).drop("run")


def runs_of_text(spark: SparkSession, text: str) -> list[str]:
    """The runs that every name has which contains the text; % and _ stand for other characters.

    The text is put in lower case by Spark, as `contains_fold` does it, so both agree on every letter.
    """
    pattern = "%" + text.replace("\\", "\\\\") + "%"
    lowered = spark.sql("SELECT lower(:pattern) AS pattern", {"pattern": pattern}).first().pattern
    pieces = [piece.replace("\\\\", "\\") for piece in re.split("[%_]", lowered)]
    return sorted({piece[i:i + RUN] for piece in pieces for i in range(len(piece) - RUN + 1)})


def _rarest(indexed: DataFrame, wanted: list[str]) -> str:
    """Of some runs the one that the fewest names have; counts of one row per run of the text."""
    counts = {r.run: r["count"] for r in indexed.filter(
        F.col("run").isin(wanted)).groupBy("run").count().collect()}
    return min(wanted, key=lambda run: counts.get(run, 0))


def containing(indexed: DataFrame, text: str) -> DataFrame:
    """season, race_number, user_guid, team_no, team_name of the names that contain a text.

    Equals `contains_fold` on every name. A text without a run of three characters beside wildcards,
    an empty one too, looks at each name once.
    """
    wanted = runs_of_text(indexed.sparkSession, text)
    run = _rarest(indexed, wanted) if len(wanted) > 1 else (wanted or [ANY])[0]
    return indexed.filter((F.col("run") == run) & contains_fold("team_name", text)).drop("run")


def users(
    indexed: DataFrame, text: str, season: int | None = None, most: int = MOST_USERS,
) -> list[str] | None:
    """The users of the teams whose name ever contained a text; None if there are more than `most`."""
    found = containing(indexed, text)
    if season is not None:
        found = found.filter(F.col("season") == season)
    # At most one more than `most`.
    some = [r.user_guid for r in found.select("user_guid").distinct().limit(most + 1).collect()]
    return some if len(some) <= most else None


def named(
    rows: DataFrame, indexed: DataFrame, text: str, season: int | None = None,
    most: int = MOST_USERS,
) -> DataFrame:
    """Rows whose team_name contains a text, from a table with user_guid and team_name.

    The index must be of the same build, so that it has every name of `rows`. A few users reach the
    files as a filter on their key; the names of many are looked at one by one, without a join.
    """
    few = users(indexed, text, season, most)
    kept = rows if few is None else rows.filter(F.col("user_guid").isin(few))
    return kept.filter(contains_fold("team_name", text))
