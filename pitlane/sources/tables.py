"""Writing tables: shared staging, partition replacement, catalog tables."""

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_named: dict[str, str] = {}
#: Folders that were staged, with the catalog's name for those that have one.
_staged: list[tuple[str, str | None]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the cluster names it.

    Without the setting, it is the one that `name_shared_dir` gave; without either, an error.
    """
    folder = spark.conf.get(_CHECKPOINT_CONF, None) or _named.get(spark.sparkContext.applicationId)
    if not folder:
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
    return folder.rstrip("/")


def name_shared_dir(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a running application whose session has no setting for it."""
    _named[spark.sparkContext.applicationId] = folder


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that is no longer needed, wherever the session keeps it."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def stage(
    df: DataFrame, name: str, by: list[str] | None = None, dealt: bool = False,
) -> DataFrame:
    """Write df to the shared folder, partitioned if asked for, and read it back.

    This cuts the lineage at a place that survives lost executors, and gives the planner the true
    size of what follows. Rows that are `dealt` out by partition value already aren't moved again.
    """
    spark = df.sparkSession
    path = _staging_folder(spark, name, uuid.uuid4().hex)
    _staged.append((path, None))
    rows = df if dealt else _balanced(df, by or [])
    rows.write.partitionBy(*by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _staging_folder(spark: SparkSession, name: str, unique: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{unique}"


def stage_by(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Write df to the shared folder in buckets of `keys` and read it back.

    There are as many buckets as a shuffle has partitions, each one sorted file. So aggregates and
    windows by these keys, and joins of several such tables, take the buckets as they lie: rows move
    once, for the writing, and not at all if df is dealt out by the keys already. The keys have to be
    those of bounded groups, as a bucket is one task. The session's catalog holds the layout under a
    name of its own until the end of `staging`.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = uuid.uuid4().hex
    path, table = _staging_folder(spark, name, unique), f"staged_{name}_{unique}"
    _staged.append((path, table))
    (
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        .format("parquet").option("path", path).saveAsTable(table)
    )
    return spark.table(table).select(*df.columns)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what was staged inside; for work whose results are written elsewhere."""
    before = len(_staged)
    try:
        yield
    finally:
        for path, table in _staged[before:]:
            if table is not None:
                drop_tables(spark, [table])
            delete(spark, path)
        del _staged[before:]


def _balanced(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows gathered by partition value, for writing.

    The rebalance hint lets the runtime planner split a value that is too large for one task and
    merge small ones, so a hot season is written by many tasks and a cold one by few.
    """
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write df below path, replacing just the partitions that df holds."""
    (
        _balanced(df, by).write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).mode("overwrite").parquet(path)
    )


def write_parts(
    df: DataFrame, path: str, by: list[str], looked_up: Iterable[str] = (),
    measures: dict[str, Column] | None = None,
) -> tuple[DataFrame, dict]:
    """Write df as a whole to path, a folder per value of `by`, and read it back.

    Aggregates in `measures` are taken from the rows as they pass by, after the last shuffle, where a
    task that runs again counts once. Their values come with what was read.

    Files are sorted by the columns of `looked_up`, so their page indexes lead to the rows of a few
    values, and carry bloom filters of them, which tell files apart that hold none. The sort is the
    one that writing by folders needs anyway, with more columns. Observing the rows before it also
    keeps the planner from dropping a constant season from the sort, which would then not be the one
    that the writer asks for, and be replaced by it.
    """
    seen, columns = Observation(), [c for c in looked_up if c in df.columns]
    rows = _balanced(df, by).observe(seen, F.count(F.lit(1)).alias("__rows"), *[
        measure.alias(name) for name, measure in (measures or {}).items()])
    if columns:
        rows = rows.sortWithinPartitions(*by, *columns)
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    filters["parquet.bloom.filter.adaptive.enabled"] = "true"
    rows.write.options(**filters).partitionBy(*by).mode("overwrite").parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    return read, {name: seen.get[name] for name in measures or {}}


def replace_table(df: DataFrame | None, name: str) -> int | None:
    """Replace a catalog table and report its rows, counted by the write itself.

    Without a frame (no files matched) the table stays as it is.
    """
    if df is None:
        return None
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").format("parquet").saveAsTable(name)
    )
    return counted.get["rows"]


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def stack(frames: list[DataFrame]) -> DataFrame | None:
    """All rows of all frames, aligned by column name; absent columns are null."""
    stacked = None
    for frame in frames:
        stacked = frame if stacked is None else stacked.unionByName(frame, True)
    return stacked
