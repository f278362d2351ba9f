"""Published builds: one record says where every part of every table lies.

A table is a number of parts, one per season, or per season and race where the table has races. A
build writes new parts to folders of its own and then publishes one record, which names them beside
the parts that stay. The record is a file that appears whole, under a number that is taken once, so
a reader that resolved a record keeps one build, and whoever comes later finds the next one. Two that
publish at the same time don't undo each other: the later one adds its change to the other's record.
"""

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane import fixed_values as V
from pitlane.sources.tables import delete, exists, make_folder, stack, write_parts

RECORDS = "_records"
#: Records that are tried, if others publish all the time.
TRIES = 20
#: The race of parts of tables that are not laid out by race.
NO_RACE = -1

Place = tuple[int, int]  # season, race


class LostRowsError(ValueError):
    """A record would take away rows that are published."""


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int


@dataclass(frozen=True)
class Table:
    """The columns of a table, how its folders are divided, and its parts."""

    schema: T.StructType
    by: list[str]
    parts: dict[Place, Part]


@dataclass(frozen=True)
class Record:
    """All published tables at one time, with notes of each season's last build."""

    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    notes: dict[int, dict] = field(default_factory=dict)

    def seasons(self) -> list[int]:
        return sorted({season for t in self.tables.values() for season, _ in t.parts})

    def races(self, name: str, season: int) -> list[int]:
        """The races of a season that a table has rows of."""
        return sorted(race for (s, race), part in self.tables[name].parts.items()
                      if s == season and part.rows)

    def with_parts(
        self, made: "dict[str, Table]", season: int, notes: dict,
        races: dict[str, set[int]] | None = None,
    ) -> "Record":
        """This record with new parts of a season in place of its old ones; parts without rows go.

        Of tables named in `races`, only the parts of these races are replaced.
        """
        tables = dict(self.tables)
        for name, table in made.items():
            only = (races or {}).get(name)
            old = tables[name].parts if name in tables else {}
            kept = {p: x for p, x in old.items()
                    if p[0] != season or (only is not None and p[1] not in only)}
            tables[name] = Table(table.schema, table.by, kept | table.parts)
        return replace(self, tables=tables, notes=self.notes | {season: notes})

    def folders(self) -> set[str]:
        return {part.folder for t in self.tables.values() for part in t.parts.values()}

    def to_json(self) -> str:
        return json.dumps({
            "number": self.number, "notes": {str(s): n for s, n in self.notes.items()},
            "tables": {name: {
                "schema": t.schema.jsonValue(), "by": t.by,
                "parts": [[*place, part.folder, part.rows] for place, part in sorted(t.parts.items())],
            } for name, t in self.tables.items()}})

    @classmethod
    def from_json(cls, text: str) -> "Record":
        held = json.loads(text)
        return cls(held["number"], {
            name: Table(T.StructType.fromJson(t["schema"]), t["by"],
                        {(season, race): Part(folder, rows) for season, race, folder, rows in t["parts"]})
            for name, t in held["tables"].items()},
            {int(season): n for season, n in held["notes"].items()})


# --- parts --------------------------------------------------------------------------------------

def by_of(columns: list[str]) -> list[str]:
    """How a large table is divided: by race inside its season if it has races."""
    return V.RACE_KEY if "race_number" in columns else ["season"]


def written(df: DataFrame, folder: str, by: list[str], season: int) -> tuple[DataFrame, Table]:
    """Write the rows of a season below a folder of its own and count them part by part."""
    return measured(df, folder, by, season, {})[:2]


def measured(
    df: DataFrame, folder: str, by: list[str], season: int, measures: dict[str, Column],
) -> tuple[DataFrame, Table, dict]:
    """`written`, with aggregates of the rows that the write takes as they pass by.

    The count reads file footers only: it asks for nothing but the columns of the layout.
    """
    read, found = write_parts(df, folder, by, V.LOOKED_UP, measures)
    # One row per race of the season at most.
    counted = read.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).collect()
    parts = {(row.season, row["race_number"] if len(by) > 1 else NO_RACE): Part(folder, row["rows"])
             for row in counted}
    strange = {place[0] for place in parts} - {season}
    if strange:
        raise ValueError(f"rows of other seasons: {sorted(strange)}")
    return read, Table(df.schema, by, parts), found


def read_table(
    spark: SparkSession, table: Table, season: int | None = None, races: Iterable[int] | None = None,
) -> DataFrame:
    """The rows of a table, or of the parts asked for; other folders are not looked at."""
    asked = None if races is None else set(races)
    folders: dict[str, list[str]] = {}
    for (s, race), part in sorted(table.parts.items()):
        if (season is None or s == season) and (asked is None or race in asked):
            inner = f"season={s}" if len(table.by) == 1 else f"season={s}/race_number={race}"
            folders.setdefault(part.folder, []).append(f"{part.folder}/{inner}")
    frames = [
        spark.read.schema(table.schema).option("basePath", folder).parquet(*paths)
        .select(*table.schema.names) for folder, paths in folders.items()]
    return stack(frames) if frames else spark.createDataFrame([], table.schema)


@dataclass(frozen=True)
class Published:
    """The tables of one record, for as long as a reader needs them."""

    spark: SparkSession
    record: Record

    def names(self) -> list[str]:
        return sorted(self.record.tables)

    def table(
        self, name: str, season: int | None = None, races: Iterable[int] | None = None,
    ) -> DataFrame:
        return read_table(self.spark, self.record.tables[name], season, races)

    def tables(self, season: int | None = None) -> dict[str, DataFrame]:
        return {name: self.table(name, season) for name in self.names()}

    def as_views(self) -> None:
        """Name all tables in this session, for SQL; they stay with this record."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


# --- records ------------------------------------------------------------------------------------

def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()


def _numbers(spark: SparkSession, out: str) -> list[int]:
    folder = f"{out}/{RECORDS}"
    if not exists(spark, folder):
        return []
    fs, conf = _hadoop(spark)
    path = fs.Path(folder)
    names = [status.getPath().getName() for status in path.getFileSystem(conf).listStatus(path)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _record(spark: SparkSession, out: str, number: int) -> Record:
    # One small file.
    text = spark.read.text(f"{out}/{RECORDS}/{number:012d}.json", wholetext=True).first()
    return Record.from_json(text.value)


def latest_record(spark: SparkSession, out: str) -> Record:
    """The newest record; an empty one if nothing is published."""
    numbers = _numbers(spark, out)
    return _record(spark, out, numbers[-1]) if numbers else Record()


def published(spark: SparkSession, out: str) -> Published:
    """What is published now. The record is resolved here, once."""
    return Published(spark, latest_record(spark, out))


def _appears(spark: SparkSession, out: str, record: Record) -> bool:
    """Write a record under its number, whole or not at all; False if the number is taken."""
    fs, conf = _hadoop(spark)
    folder = f"{out}/{RECORDS}"
    make_folder(spark, folder)
    draft = fs.Path(f"{folder}/draft-{uuid.uuid4().hex}")
    stream = draft.getFileSystem(conf).create(draft, True)
    stream.write(bytearray(record.to_json().encode()))
    stream.close()
    never_over = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        fs.FileContext.getFileContext(draft.toUri(), conf).rename(
            draft, fs.Path(f"{folder}/{record.number:012d}.json"), never_over)
    except Py4JJavaError as error:
        delete(spark, draft.toString())
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def publish(spark: SparkSession, out: str, change: Callable[[Record], Record]) -> Published:
    """Publish a change of the newest record. If another record comes between, change that one."""
    for _ in range(TRIES):
        before = latest_record(spark, out)
        after = replace(change(before), number=before.number + 1)
        if _appears(spark, out, after):
            return Published(spark, after)
    raise RuntimeError(f"{TRIES} others published first")


def require_no_loss(
    before: Record, after: Record, rows: bool, may_go: Iterable[str] = (),
) -> None:
    """Raise if a season or race of a published table goes, or, with `rows`, loses rows."""
    lost = []
    for name, table in before.tables.items():
        if name in may_go:
            continue
        kept = after.tables[name].parts if name in after.tables else {}
        for place, part in table.parts.items():
            left = kept[place].rows if place in kept else 0
            if part.rows and (not left or (rows and left < part.rows)):
                lost.append((name, *place, part.rows, left))
    if lost:
        raise LostRowsError(
            f"published rows would go (table, season, race, rows, rows left): {sorted(lost)[:20]}")


def remove_old(spark: SparkSession, out: str, keep: int = 2) -> list[str]:
    """Remove all but the newest records, and the folders that none of those kept names.

    For a time when no reader holds an older record. Gives the folders removed.
    """
    numbers = _numbers(spark, out)
    old, new = numbers[:-keep], numbers[-keep:]
    used = set().union(*(_record(spark, out, n).folders() for n in new))
    gone = set().union(*(_record(spark, out, n).folders() for n in old)) - used
    for folder in gone:
        delete(spark, folder)
    for number in old:
        delete(spark, f"{out}/{RECORDS}/{number:012d}.json")
    return sorted(gone)
