"""CSV tables with a header and a declared schema; a header that differs from it is an error."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    return spark.read.schema(schema).options(
        header=True, enforceSchema=False, **options
    ).csv(path)


def scan_prefix(
    spark: SparkSession, folder: str, prefix: str, schema: StructType,
) -> DataFrame | None:
    """All files named prefix + digits + .csv as one table, or None where there are none.

    The digits keep `team_race_` from also taking `team_race_asset_1.csv`.
    """
    names = f"{prefix}[0-9]*.csv"
    numbered = F.col("_metadata.file_name").rlike("^" + re.escape(prefix) + r"\d+\.csv$")
    # One row per file, without its content.
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder)
    if files.select("length", "_metadata").filter(numbered).isEmpty():
        return None
    return scan(spark, folder, schema, pathGlobFilter=names).filter(numbered)
