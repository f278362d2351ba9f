"""Exact deduplication by a tree merge of sorted digest runs.

Every task makes sorted runs of the digests it holds, one row per digest with the smallest
identifier and a count, and belongs to one of the tree's leaves. A round stands for some steps of a
binomial exchange at once: leaves that differ in their last bits only send their runs to one node,
where they are merged and rows of one digest become one. As the runs of a node grow by a factor, the
node is split by digest into as many slices, so every round has the same number of equal parts and
no task ever holds more than its share; a digest of any number of copies is one row per run. There
are as many rounds as the leaves need to become one node, so the number of parts follows that of the
input's partitions.

Two texts count as equal if two independent digests of the normalised text agree.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import id_keys, plain_text, stage

#: Bits of a leaf's number that one round merges away, as many as a hex digit of the digest has.
ROUND_BITS = 4
_RUN = "node int, digest string, proof long, smallest {id}, copies long"


def normalised(text: str = "text") -> Column:
    """The text with every run of white space as one space; a null counts as empty."""
    return F.regexp_replace(plain_text(text), r"[\x20\x09-\x0D]+", " ")


def _merged(table: pa.Table) -> pa.Table:
    """Rows of a key become one, in the order of the keys; a null identifier yields to any other."""
    keys = ["node", "digest", "proof"]
    merged = table.group_by(keys).aggregate([("smallest", "min"), ("copies", "sum")])
    merged = merged.rename_columns([{
        "smallest_min": "smallest", "copies_sum": "copies"}.get(c, c) for c in merged.column_names])
    return merged.select(table.column_names).sort_by([(k, "ascending") for k in keys])


def rounds_of(leaves: int) -> int:
    """Rounds after which so many leaves are one node; at least one, which merges the leaf's runs."""
    return max(1, -(-max(leaves - 1, 0).bit_length() // ROUND_BITS))


def _leaf_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted run per batch; each task is a leaf."""
    leaf = TaskContext.get().partitionId()
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        nodes = pa.array([leaf] * batch.num_rows, pa.int32())
        copies = pa.array([1] * batch.num_rows, pa.int64())
        rows = rows.add_column(0, "node", nodes).append_column("copies", copies)
        yield from _merged(rows).to_batches()


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by key: merge neighbours, holding one batch and one open row.

    That they are sorted is verified, as rows of a key that don't meet would each keep an identifier.
    """
    held, last = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        ends = [tuple(rows[k][i].as_py() for k in ("node", "digest", "proof"))
                for i in ((0, -1) if rows.num_rows else ())]
        if ends and last is not None and ends[0] < last:
            raise ValueError(f"a run isn't sorted: {ends[0]} comes after {last}")
        last = ends[1] if ends else last
        merged = _merged(rows if held is None else pa.concat_tables([held, rows]))
        held = merged.slice(merged.num_rows - 1)
        yield from merged.slice(0, merged.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def tree_merge(rows: DataFrame) -> DataFrame:
    """One row per digest and proof: the smallest identifier and the number of copies.

    `rows` has the columns digest (hex text), proof (long) and smallest (any ordered type). A group
    that has null identifiers only has none.
    """
    # Known from the plan: rows come from staged files.
    rounds = rounds_of(rows.rdd.getNumPartitions())
    schema = _RUN.format(id=rows.schema["smallest"].dataType.simpleString())
    runs = rows.select("digest", "proof", "smallest").mapInArrow(_leaf_runs, schema)
    for done in range(1, rounds + 1):
        node = F.shiftright("node", ROUND_BITS).alias("node")
        met = runs.select(node, "digest", "proof", "smallest", "copies")
        # The exchange brings sorted runs together, and the sort merges them, on disk if need be. One
        # more digit than the round has makes slices small enough to be dealt out evenly.
        runs = (
            met.repartition("node", F.substring("digest", 1, done + 1))
            .sortWithinPartitions("node", "digest", "proof").mapInArrow(_merge_runs, schema)
        )
    return runs.drop("node")


def _fingerprinted(docs: DataFrame) -> DataFrame:
    text = normalised()
    return docs.select(
        F.col("doc_id").alias("doc_id"), F.sha2(text, 256).alias("digest"),
        F.xxhash64(text).alias("proof"))


def duplicate_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The digests of all rows, and one row per group of equal texts."""
    rows = stage(_fingerprinted(docs), "digests")
    merged = tree_merge(rows.withColumnRenamed("doc_id", "smallest"))
    return rows, stage(merged, "groups")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the smallest doc_id stays; null ids come last, and a group without any id has a
    null keep_id. Of rows with the same id and text just one is kept. A null text counts as empty.
    An empty table gives an empty one; other columns are not read.
    """
    rows, groups = duplicate_groups(docs)
    # Rows that agree in everything are counted before the join, and told apart after it.
    counted = rows.groupBy("doc_id", "digest", "proof").agg(F.count(F.lit(1)).alias("rows"))
    return (
        counted.join(groups, ["digest", "proof"])
        .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .select(
            "doc_id", F.col("smallest").alias("keep_id"), F.col("copies").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("smallest")) & (F.col("row") == 1)).alias("kept"),
            F.col("digest").alias("text_sha256"))
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that `exact_duplicates` keeps, with all their columns.

    The texts are shuffled once, by id and digest, which spreads the copies of a group.
    """
    _, groups = duplicate_groups(docs)
    text = normalised()
    rows = docs.select(
        F.struct("*").alias("row"), *[c.alias(n) for n, c in id_keys("doc_id").items()],
        F.sha2(text, 256).alias("digest"), F.xxhash64(text).alias("proof"))
    keys = ["id", "no_id", "digest", "proof"]
    staying = groups.withColumns(id_keys("smallest")).select(*keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return (
        rows.join(staying, keys, "left_semi").withColumn("place", place).filter("place = 1")
        .select("row.*")
    )
