"""Land new JSON documents of a season into bronze tables; set aside what can't be read.

A file stream reads each file once. A document that can't be parsed, whose name holds no key or that
holds no records goes to the rejects table, by path and reason and without its text, and takes no
key: the corrected file lands like any new one. Of several valid documents of one key the newest
file counts, whenever it came, so a correction replaces what it corrects and an old copy does not.

Bronze is laid out by season, race and micro-batch. A batch that is repeated after a lost executor
or driver replaces the partitions that it had begun to write; no batch reads what is landed. Many
small batches of a race are compacted into one from time to time.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from pitlane.operators.joins import attach_small
from pitlane.sources import documents
from pitlane.sources.tables import delete, overwrite_partitions

LAYOUT = ["season", "race_number", "batch"]
REJECTS = "rejects"
_FILE = ["path", "modified_at"]
_DAMAGED = "__damaged"
#: A stream passes over files that are older than its newest one by more than this.
_ANY_AGE = "36500d"


def keys_of(dataset: str) -> list[str]:
    """What tells the documents of a data set apart."""
    return ["season", *[name for name, _, _ in documents.NAME_KEYS[dataset]]]


def bronze_schema(dataset: str) -> StructType:
    """Name keys, the file, the document without personal fields, then the layout."""
    schema = StructType()
    for name, _, kind in documents.NAME_KEYS[dataset]:
        if name not in LAYOUT:
            schema.add(name, LongType() if kind == "bigint" else StringType())
    schema.add("path", StringType()).add("modified_at", TimestampType())
    for field in documents.stored_schema(dataset).fields:
        schema.add(field)
    for name in LAYOUT:
        schema.add(name, LongType())
    return schema


def read_all(spark: SparkSession, dataset: str, bronze: str) -> DataFrame:
    """Every landed document, earlier versions too."""
    return spark.read.schema(bronze_schema(dataset)).parquet(f"{bronze}/{dataset}")


def read_rejects(spark: SparkSession, dataset: str, bronze: str) -> DataFrame:
    """Files that were set aside: season, path, modified_at, reason."""
    return spark.read.schema(
        "path STRING, modified_at TIMESTAMP, reason STRING, season BIGINT, batch BIGINT"
    ).parquet(f"{bronze}/{REJECTS}/{dataset}")


def read_bronze(
    spark: SparkSession, dataset: str, bronze: str, season: int | None = None,
) -> DataFrame:
    """The valid documents of a data set, the newest version of each; of one season if given.

    Only keys and file names are grouped. Keys with several versions are few, and their older files
    are taken out by a join that leaves the documents where they are. A document that lies in two
    batches, as it does while a compaction is under way, counts once.
    """
    landed = read_all(spark, dataset, bronze)
    if season is not None:
        landed = landed.filter(F.col("season") == season)
    return _newest(landed, dataset).drop(*_FILE, "batch")


def _newest(landed: DataFrame, dataset: str) -> DataFrame:
    key, copy = keys_of(dataset), ["path", "batch"]
    several = (
        landed.select(*key, *_FILE, "batch").groupBy(*key)
        .agg(F.max(F.struct("modified_at", *copy)).alias("newest"), F.count(F.lit(1)).alias("versions"))
        .filter("versions > 1").select(*key, "newest")
    )
    other = landed.select(*key, *copy).join(several, key).filter(
        (F.col("path") != F.col("newest.path")) | (F.col("batch") != F.col("newest.batch"))
    ).select(*key, *copy)
    return attach_small(landed, other, [*key, *copy], "left_anti")


def compact(spark: SparkSession, dataset: str, bronze: str, season: int, least: int = 2) -> int:
    """Rewrite the races of a season that lie in `least` batches or more, each into one batch.

    The newest version of each document stays; earlier ones remain among the incoming files only. What
    is read afterwards is the same. A run that is cut short leaves copies in two batches, which read
    as one document, and the next run finishes its work. Batches that land meanwhile are left alone.
    For a time when nobody reads the season, as the old folders go. Gives the number of races.
    """
    landed = read_all(spark, dataset, bronze).filter(F.col("season") == season)
    # One row per folder of the season.
    folders = [(r.race_number, r.batch) for r in
               landed.select("race_number", "batch").distinct().collect()]
    batches: dict[int, list[int]] = {}
    for race, batch in folders:
        batches.setdefault(race, []).append(batch)
    races = sorted(race for race, found in batches.items() if len(found) >= least)
    if not races:
        return 0
    # Streams count their batches upwards from 0; compacted ones go down from -2.
    new = min(-1, *[batch for _, batch in folders]) - 1
    here = landed.filter(F.col("race_number").isin(races) & F.col("batch").isin(
        sorted({batch for race in races for batch in batches[race]})))
    target = f"{bronze}/{dataset}"
    one = _newest(here, dataset).withColumn("batch", F.lit(new).cast("bigint"))
    overwrite_partitions(one.select(*bronze_schema(dataset).names), target, LAYOUT)
    for race in races:
        for batch in batches[race]:
            delete(spark, f"{target}/season={season}/race_number={race}/batch={batch}")
    return len(races)


def versions(spark: SparkSession, bronze: str, season: int) -> dict[str, dict[str, str]]:
    """What tells the landed documents of each race from earlier ones, by data set and race.

    Files are named by path and time, and only keys and names are read. What comes to the driver is a
    text per data set and race of the season.
    """
    found: dict[str, dict[str, str]] = {}
    for dataset in documents.SCHEMAS:
        key = keys_of(dataset)
        newest = (
            read_all(spark, dataset, bronze).filter(F.col("season") == season)
            .groupBy(*key).agg(F.max(F.struct("modified_at", "path")).alias("file"))
        )
        marks = newest.groupBy("race_number").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64(*key, "file").cast("decimal(38,0)")).alias("sum"))
        found[dataset] = {str(r.race_number): f"{r.n}:{r.sum}" for r in marks.collect()}
    return found


def _incoming(
    spark: SparkSession, dataset: str, folder: str, season: int, files_per_batch: int,
) -> DataFrame:
    schema = StructType([*documents.SCHEMAS[dataset].fields, StructField(_DAMAGED, StringType())])
    stream = (
        spark.readStream.schema(schema)
        .options(multiLine=True, recursiveFileLookup=True, maxFilesPerTrigger=files_per_batch,
                 maxFileAge=_ANY_AGE, mode="PERMISSIVE", columnNameOfCorruptRecord=_DAMAGED)
        .json(folder)
    )
    keyed = stream.select(
        F.lit(season).cast("bigint").alias("season"), *documents.keys_from_path(dataset),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified_at"), "*",
    )
    return documents.without_personal_fields(keyed, dataset)


def _fault(dataset: str) -> Column:
    """Why a document can't be landed; null if it can."""
    no_key = F.lit(False)
    for name in keys_of(dataset):
        no_key = no_key | F.col(name).isNull()
    return (
        F.when(F.col(_DAMAGED).isNotNull(), "unreadable").when(no_key, "no key in the name")
        .when(F.coalesce(F.size(documents.records_of(dataset)), F.lit(0)) < 1, "no records")
    )


def land(
    spark: SparkSession, dataset: str, incoming: str, bronze: str, checkpoint: str, season: int,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Start a run over whatever has arrived of a season; it ends by itself when that is landed."""
    target, rejects = f"{bronze}/{dataset}", f"{bronze}/{REJECTS}/{dataset}"
    columns = bronze_schema(dataset).names
    # An empty first batch makes the tables, so reading them is no special case.
    none = spark.createDataFrame([], bronze_schema(dataset)).drop(*LAYOUT)
    none.write.mode("overwrite").parquet(f"{target}/season=0/race_number=0/batch=-1")
    none.select(*_FILE, F.lit("").alias("reason")).write.mode("overwrite").parquet(
        f"{rejects}/season=0/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        # The documents of a batch are parsed once for both tables.
        marked = batch.withColumn("batch", F.lit(number).cast("bigint")).withColumn(
            "reason", _fault(dataset)).persist()
        try:
            overwrite_partitions(
                marked.filter("reason IS NULL").select(*columns), target, LAYOUT)
            overwrite_partitions(
                marked.filter("reason IS NOT NULL").select(*_FILE, "reason", "season", "batch"),
                rejects, ["season", "batch"])
        finally:
            marked.unpersist()

    stream = _incoming(spark, dataset, incoming, season, files_per_batch)
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/{dataset}/season={season}")
        .trigger(availableNow=True).start()
    )
