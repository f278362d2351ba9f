"""Where registered queries and their SQL are kept side by side."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.league_sql import with_views
from checks.star_league import StarLeague, star_league

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None, views: bool = True, **more: str):
    """Register a function of a league under its own name, with the SQL that must equal it."""
    def keep(function: Callable[[StarLeague], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(star_league(spark, folder))

        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, **more) if views else sql
        return function

    return keep
