"""Tables that are replaced as a whole, one folder per version.

A version is complete once its marker file is there, which is written after the data.
Readers take the newest complete one, so they never see a half-written table, and writing a
version again after a failure gives the same state.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from escrutinio.folders import exists, make_file, names, remove_folder

_PREFIX = "version="
_MARKER = "_COMPLETE"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first. Lists folders, never data."""
    found = [n for n in names(spark, path) if n.startswith(_PREFIX) and exists(spark, f"{path}/{n}/{_MARKER}")]
    return sorted(int(name[len(_PREFIX) :]) for name in found)


def write_version(df: DataFrame, path: str, version: int, partition_by: Sequence[str] = ()) -> None:
    folder = f"{path}/{_PREFIX}{version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
    make_file(df.sparkSession, f"{folder}/{_MARKER}")


def read_version(spark: SparkSession, path: str, version: int, schema: StructType) -> DataFrame:
    folder = f"{path}/{_PREFIX}{version}"
    if not exists(spark, f"{folder}/{_MARKER}"):
        raise ValueError(f"version {version} of {path} is missing or incomplete")
    return spark.read.schema(schema).parquet(folder)


def read_current(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The newest complete version, or an empty table; ``before`` looks at older ones only."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    return read_version(spark, path, known[-1], schema) if known else spark.createDataFrame([], schema)


def drop_old_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` complete versions."""
    if keep < 1:
        raise ValueError("keep at least one version")
    for version in versions(spark, path)[:-keep]:
        remove_folder(spark, f"{path}/{_PREFIX}{version}")
