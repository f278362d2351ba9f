"""What the operators share: code for the executors, staging, work on texts."""

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitlane.sources.tables import stage

__all__ = ["REMEMBERED", "Remembered", "documents", "find_on_executors", "id_keys", "map_texts",
           "plain_text", "stage"]

#: Most words or pieces of text of which a Python worker remembers the result, twice.
REMEMBERED = 300_000
#: Longer ones are not remembered.
LONGEST_REMEMBERED = 64


def find_on_executors(spark: SparkSession) -> None:
    """Let executors that have this package in the same place find it.

    On a cluster where they don't, hand the package over with --py-files.
    """
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def plain_text(text: str = "text") -> Column:
    """The text, where none counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def id_keys(column: str) -> dict[str, Column]:
    """An id of any type as keys without nulls, for joins and windows that share a shuffle."""
    return {"id": F.coalesce(F.col(column).cast("string"), F.lit("")),
            "no_id": F.col(column).isNull()}


def map_texts(
    docs: DataFrame, text: str, fields: list[T.StructField],
    start: Callable[[], Callable[[str], tuple]],
) -> DataFrame:
    """The other columns of docs, and what a function makes of each whole text.

    `start` is called once per task and gives the function; it returns one value per field. The
    partitions stay as they are; a lost one is computed again from its input alone. A null text
    counts as empty.
    """
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType(kept + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            texts = batch.column(text)
            made = [work(texts[i].as_py() or "") for i in range(batch.num_rows)]
            columns = [batch.column(f.name) for f in kept]
            columns += [
                pa.array([row[i] for row in made], type=arrow.field(len(kept) + i).type)
                for i in range(len(fields))
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, schema)


class Remembered(dict):
    """Results for short texts met before: those of the current and of the last generation."""

    def __init__(self, work: Callable[[str], object]):
        super().__init__()
        self.work, self.older = work, {}

    def __missing__(self, text: str):
        if len(text) > LONGEST_REMEMBERED:
            return self.work(text)
        found = self.older.get(text)
        if found is None:
            found = self.work(text)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[text] = found
        return found
