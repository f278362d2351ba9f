"""Rendezvous sharding: stable record keys over weighted shards.

Every shard scores every key by a hash of both; the best score takes the record. A shard that is
added scores for itself and changes no other score, so it takes just the records that it wins, and
a shard that is removed gives up its own only. A shard of twice the weight wins twice as many.

Columns only: no Python runs on the executors.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import plain_text, stage

SHARDS = 40
#: Parts of a shard that are numbered by themselves, so no task holds a whole shard.
PARTS = 256


def _cost(key: Column, shard: Column, weight: Column) -> Column:
    """The shard with the smallest cost wins: an exponential draw with the weight as its rate."""
    draw = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string"))), 1, 13), 16, 10)
    return -F.ln((draw.cast("double") + 0.5) / F.lit(2.0**52)) / weight


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """struct(cost, shard) of the winner; equal costs go to the smaller shard."""
    shards = F.array(*[
        F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight"))
        for i, w in enumerate(weights)
    ])
    return F.array_min(F.transform(shards, lambda s: F.struct(
        _cost(key, s["shard"], s["weight"]).alias("cost"), s["shard"].alias("shard"))))


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _part(columns: Sequence[str], parts: int) -> Column:
    """Where in its shard a record is numbered: by the whole record, so one key can't fill a part."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    return F.pmod(F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"), F.lit(parts))


def place(
    records: DataFrame, key: str, weights: Sequence[float], grown_weight: float = 1.0,
    parts: int = PARTS,
) -> DataFrame:
    """Each record with its shard, its slot there and its shard after one more is added.

    Adds `shard` int, `slot` long (0, 1, ... without a gap in a shard, ordered by part of the shard,
    key and the other columns) and `grown_shard` int. Records are a few small columns that can be
    ordered, not texts. Rows that agree in every column are counted before they are shuffled and
    follow one another; a null key is one key like any other. An empty table gives an empty one.
    Columns of these three names must not be in records.
    """
    columns = records.columns
    counted = records.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows"))
    # The cost is needed twice; a column of its own keeps it from being computed twice.
    won = counted.withColumn("__won", best_shard(_key(key), weights))
    rival = _cost(_key(key), F.lit(len(weights)), F.lit(float(grown_weight)))
    placed = won.select(
        *columns, "__rows", F.col("__won.shard").alias("shard"),
        F.when(rival < F.col("__won.cost"), len(weights)).otherwise(F.col("__won.shard"))
        .cast("int").alias("grown_shard"),
        _part(columns, parts).alias("__part"),
    )
    kept = stage(placed, "shards")
    sizes = kept.groupBy("shard", "__part").agg(F.sum("__rows").alias("__size"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # At most len(weights) * parts rows, however many records there are.
    starts = sizes.select(
        "shard", "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    own = (
        Window.partitionBy("shard", "__part").orderBy(*columns)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = kept.withColumn("__first", F.coalesce(F.sum("__rows").over(own), F.lit(0)))
    return (
        numbered.join(F.broadcast(starts), ["shard", "__part"])
        .withColumn("__row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1)))
        .select(
            *columns, "shard", (F.col("__start") + F.col("__first") + F.col("__row")).alias("slot"),
            "grown_shard")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, parts: int = PARTS) -> DataFrame:
    """All documents over equal shards, by doc_id and the number of shards alone.

    A null text has no bytes and the check sum of an empty one; other columns are not read.
    """
    records = docs.select(
        "doc_id", (F.octet_length(plain_text()) + 16).cast("long").alias("size"),
        F.crc32(plain_text()).cast("long").alias("text_crc32"),
    )
    placed = place(records, "doc_id", [1.0] * shards, parts=parts)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
