"""Plain Parquet tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace a table. Not atomic for concurrent readers; see ``sinks.versions``."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table, the insert-only form of serving."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
