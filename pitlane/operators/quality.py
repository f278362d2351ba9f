"""Data quality as tables of violations, and a wrapper that raises on them."""

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane import fixed_values as V
from pitlane.functions.columns import any_null, as_json, loses_fraction
from pitlane.operators.joins import attach_small, deal_out
from pitlane.sources.tables import stack


class DataQualityError(ValueError):
    """A table breaks a rule that the marts rely on."""


Tables = dict[str, DataFrame]


# A rule is (check, related column, aggregate that counts the rows concerned).
Rules = dict[str, list[tuple[str, str | None, Column]]]


def _counted(tables: Tables, rules: Rules) -> DataFrame:
    """(check, source, related, n) for every rule: one aggregate and one scan per table."""
    def found(name, table_rules):
        counts = tables[name].agg(*[
            rule.alias(f"n{i}") for i, (_, _, rule) in enumerate(table_rules)
        ])
        return counts.select(F.inline(F.array(*[
            F.struct(*_named(check, name, related, F.col(f"n{i}")))
            for i, (check, related, _) in enumerate(table_rules)
        ])))

    return stack([found(name, table_rules) for name, table_rules in rules.items()])


def _named(check: str, source: str, related: str | None, n: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"), F.lit(source).alias("source"),
        F.lit(related).cast("string").alias("related"), n.cast("bigint").alias("n"),
    ]


def _row_rules(names: Iterable[str]) -> Rules:
    return {name: [("rows", None, F.count(F.lit(1)))] for name in names}


def _key_rules(names: Iterable[str]) -> Rules:
    return {name: [("null key", None, F.count_if(any_null(V.KEYS[name])))] for name in names}


def _null_rules(check: str, columns: dict[str, list[str]]) -> Rules:
    return {
        name: [(check, c, F.count_if(F.col(c).isNull())) for c in names]
        for name, names in columns.items()
    }


def _merged(*parts: Rules) -> Rules:
    merged: Rules = {}
    for part in parts:
        for name, rules in part.items():
            merged[name] = merged.get(name, []) + rules
    return merged


def missing_tables(spark: SparkSession, names: list[str]) -> list[str]:
    return [name for name in names if not spark.catalog.tableExists(name)]


def missing_columns(tables: Tables) -> dict[str, list[str]]:
    """Needed columns that a table lacks; only the schemas are looked at."""
    lacking = {}
    for name, df in tables.items():
        needed = [*V.KEYS[name], *V.REQUIRED.get(name, []), *V.OPTIONAL.get(name, [])]
        absent = sorted(set(needed) - set(df.columns))
        if absent:
            lacking[name] = absent
    return lacking


def lost_fractions(texts: Tables) -> DataFrame:
    """Numbers with a fraction among texts that must hold whole numbers, by table and column.

    Coercion makes them null; here they are counted before it.
    """
    return _counted(texts, {
        name: [("lost fraction", c, F.count_if(loses_fraction(F.col(f"`{c}`")))) for c in df.columns]
        for name, df in texts.items()
    })


def row_counts(tables: Tables) -> DataFrame:
    return _counted(tables, _row_rules(tables))


def null_keys(tables: Tables) -> DataFrame:
    """Rows of each table with a null in a key column."""
    return _counted(tables, _key_rules(tables))


def null_measures(tables: Tables) -> DataFrame:
    """Nulls of each required measure."""
    return _counted(tables, _null_rules("null measure", V.REQUIRED))


def null_counts(tables: Tables) -> DataFrame:
    """Nulls of every column of each table."""
    return _counted(tables, _null_rules("nulls", {name: df.columns for name, df in tables.items()}))


def optional_gaps(tables: Tables) -> DataFrame:
    """Nulls of measures that may be absent; reported, never fatal."""
    return _counted(tables, _null_rules("optional gap", V.OPTIONAL))


def duplicate_keys(tables: Tables) -> DataFrame:
    """Rows of each table that repeat the key of another row, the first one not counted.

    A team's rows of a race are dealt out together, so what they share is packed well.
    """
    def by_key(name: str, df: DataFrame) -> DataFrame:
        keys = V.KEYS[name]
        by = [c for c in keys if c in V.TEAM_RACE_KEY] if "user_guid" in keys else keys
        return deal_out(df.select(*keys), by, df).groupBy(*keys)

    return stack([
        by_key(name, df).agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("n"))
        .select(*_named("duplicate key", name, None, F.col("n")))
        for name, df in tables.items()
    ])


def unreferenced(source: DataFrame, related: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct source keys without a partner, with their row counts.

    The source is counted by key before it is joined, so a race or chip that a third of the rows
    share travels as one row.
    """
    counted = source.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    partners = related.select(*[F.col(r).alias(s) for s, r in columns.items()])
    return counted.join(partners, list(columns), "left_anti")


def referential(tables: Tables, relationships: list = V.RELATIONSHIPS) -> DataFrame:
    """Unmatched rows of each declared relationship."""
    return stack([
        unreferenced(tables[source], tables[related], columns)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        .select(*_named("reference", source, related, F.col("n")))
        for source, related, columns in relationships
    ])


def historical_usage_rows(usage: DataFrame, team_race: DataFrame, races: DataFrame) -> DataFrame:
    """Chip uses up to the season's last loaded race that match no team race."""
    last = team_race.groupBy("season").agg(F.max("race_number").alias("__last"))
    past = attach_small(usage, last, ["season"], proof=races).filter("race_used <= __last")
    return unmatched_chip_rows(past.drop("__last"), team_race)


def historical_usage(tables: Tables) -> DataFrame:
    rows = historical_usage_rows(
        tables["team_chip_usage"], tables["team_race"], tables["races"]
    )
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        *_named("historical use", "team_chip_usage", "team_race", F.col("n"))
    )


def unmatched_chip_rows(usage: DataFrame, team_race: DataFrame) -> DataFrame:
    """Chip uses, past or upcoming, whose team has no row at that race."""
    played = team_race.select(
        "season", "user_guid", "team_no", F.col("race_number").alias("race_used")
    )
    return usage.join(played, [*V.TEAM_KEY, "race_used"], "left_anti").select(*usage.columns)


def _fatal(names: Iterable[str]) -> Rules:
    """Rules on single rows; how many rows there are is one."""
    return _merged(_row_rules(names), _key_rules(names), _null_rules(
        "null measure", {name: V.REQUIRED[name] for name in names if name in V.REQUIRED}))


def _broken(counted: DataFrame) -> DataFrame:
    """The fatal ones among counted rules."""
    is_rows, n = F.col("check") == "rows", F.col("n")
    empty = is_rows & (n == 0) & ~F.col("source").isin(V.MAY_BE_EMPTY)
    return counted.filter(
        empty | (~F.col("check").isin("rows", "optional gap") & (n > 0))
    ).withColumn("check", F.when(is_rows, "empty table").otherwise(F.col("check")))


def _between_rows(tables: Tables, relationships: list) -> DataFrame:
    """The rules that more than one row takes part in, zero rows left out."""
    return stack([
        duplicate_keys(tables).filter("n > 0"), referential(tables, relationships).filter("n > 0"),
        historical_usage(tables).filter("n > 0"),
    ])


def violations(tables: Tables, relationships: list = V.RELATIONSHIPS) -> DataFrame:
    """Every fatal rule with the number of rows that break it, zero rows left out.

    All rules on single rows are counted in one scan per table; only keys and references shuffle.
    """
    return stack([_broken(_counted(tables, _fatal(tables))), _between_rows(tables, relationships)])


# --- rules that a write counts ------------------------------------------------------------------

def _rules_of(name: str) -> list[tuple[str, str | None, Column]]:
    gaps = {name: V.OPTIONAL[name]} if name in V.OPTIONAL else {}
    return _merged(_fatal([name]), _null_rules("optional gap", gaps))[name]


def measures(name: str) -> dict[str, Column]:
    """The rules on single rows of a source table, as aggregates that its write can take."""
    return {f"n{i}": rule for i, (_, _, rule) in enumerate(_rules_of(name))}


def counted_by_write(spark: SparkSession, found: dict[str, dict]) -> DataFrame:
    """(check, source, related, n) of the values of `measures`, by table."""
    return spark.createDataFrame([
        (check, name, related, values[f"n{i}"]) for name, values in found.items()
        for i, (check, related, _) in enumerate(_rules_of(name))
    ], "check string, source string, related string, n bigint")


def violating_rows(tables: Tables) -> DataFrame:
    """source, key and broken: the rows that break rules on single rows, and the rules they break.

    `key` is the row's key as JSON, `broken` names the rules in their order, each null measure with
    its column. Rows that repeat a key are listed each. One scan per table, and no shuffle.
    """
    def found(name: str, df: DataFrame) -> DataFrame:
        broken = F.concat_ws(
            ",", F.when(any_null(V.KEYS[name]), "null key"),
            *[F.when(F.col(c).isNull(), f"null measure {c}") for c in V.REQUIRED.get(name, [])])
        return df.select(F.lit(name).alias("source"), as_json(V.KEYS[name]).alias("key"),
                         broken.alias("broken")).filter(F.col("broken") != "")

    return stack([found(name, df) for name, df in tables.items()])


def require_schemas(tables: Tables) -> None:
    """Raise if a table or a needed column is absent."""
    absent = [name for name in V.KEYS if name not in tables]
    if absent:
        raise DataQualityError(f"missing tables: {absent}")
    lacking = missing_columns(tables)
    if lacking:
        raise DataQualityError(f"missing columns: {lacking}")


def raise_on_counted(
    tables: Tables, counted: DataFrame, keep: Callable[[DataFrame], str],
    relationships: list = V.RELATIONSHIPS,
) -> DataFrame:
    """Raise with all findings, the rules on single rows being counted already; or give the gaps.

    Rows are read again for such rules only if some break one. `keep` writes these rows, and the error
    names the place that it gives.
    """
    found = [tuple(row) for row in _broken(counted).collect()]
    concerned = {name: tables[name] for check, name, *_ in found if check != "empty table"}
    place = f"; rows in {keep(violating_rows(concerned))}" if concerned else ""
    found += [tuple(row) for row in _between_rows(tables, relationships).collect()]
    if found:
        raise DataQualityError(f"violations (check, source, related, rows): {found}{place}")
    return counted.filter(F.col("check") == "optional gap")


def raise_on_violation(tables: Tables, relationships: list = V.RELATIONSHIPS) -> DataFrame:
    """Check schemas, then rules; raise with all findings, or return the optional gaps.

    What is collected is one row per broken rule, a list fixed by the declarations.
    """
    require_schemas(tables)
    found = [tuple(row) for row in violations(tables, relationships).collect()]
    if found:
        raise DataQualityError(f"violations (check, source, related, rows): {found}")
    return optional_gaps(tables)
