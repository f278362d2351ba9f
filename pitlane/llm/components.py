"""Connected components of a graph given as links, by alternating stars.

A round joins every node to the smallest node near it: first each node's larger neighbours, then
its smaller ones. Paths shrink by a factor per round, and the graph ends as stars around the
smallest node of each component. Only links are shuffled; the smallest neighbour of a node is found
by an aggregate that is reduced before the shuffle, and what joins it back is a plain join, in which
the runtime planner can split a node with very many links.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.sources.tables import delete, shared_dir


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links (a, b) with a > b to links of each node's neighbours with its smallest neighbour."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    met = both.join(least, "a")
    moved = met.filter(F.col("b") > F.col("a")) if larger else met
    out = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is its component's smallest node.

    `links` has two columns a and b of one ordered type, in any order and as often as they come.
    Every round is written to the shared folder and the round before it removed; the end is reached
    when a round changes nothing.
    """
    spark = links.sparkSession
    base = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/components-{uuid.uuid4().hex}"
    schema = links.select("a", "b").schema

    def kept(df: DataFrame, step: int) -> tuple[DataFrame, str, tuple]:
        path = f"{base}/{step}"
        df.write.parquet(path)
        read = spark.read.schema(schema).parquet(path)
        # A sum over all links tells a changed graph from an unchanged one.
        state = read.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return read, path, tuple(state)

    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, path, state = kept(ordered.filter("a > b").distinct(), 0)
    step = 0
    while state[0]:
        step += 1
        after, new_path, new_state = kept(_star(_star(current, True), False), step)
        delete(spark, path)
        unchanged = new_state == state
        current, path, state = after, new_path, new_state
        if unchanged:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
