"""From raw documents to packed sequences: five stages, each a job that is written before the next.

quality     documents that the classifier rejects go
dedup       of equal texts one document stays
near_dedup  of each group of near-duplicates one document stays
secrets     what the scan reports is masked in the texts
packing     the pieces of all documents, placed in sequences

All but the last return the columns of documents, whatever these are. A stage reads all that the one
before it kept. Labels are read from the folder of the tables.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitlane.llm.common import documents, find_on_executors
from pitlane.llm.exact_dedup import drop_duplicates
from pitlane.llm.packing import pack
from pitlane.llm.quality import CUT, keep_good
from pitlane.llm.secret_scan import mask_secrets
from pitlane.llm.simhash import keep_one_each
from pitlane.sources.tables import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels and these documents, predicts as good."""
    find_on_executors(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), CUT)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_on_executors(spark)
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_on_executors(spark)
    return keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_on_executors(spark)
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_on_executors(spark)
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("dedup", dedup), ("near_dedup", near_dedup), ("secrets", secrets),
    ("packing", packing),
]

#: The classifier, the fingerprints and the tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    base = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
