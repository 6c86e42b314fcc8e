"""Broadcast behind a check of the size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``df`` was counted and fits; otherwise Spark shuffles.

    For derived tables whose size Spark can only guess. Runs one aggregation over ``df``
    while the query is built, so it should be cheap next to what it is joined with. Results
    are the same either way.
    """
    fixed = 16 * len(df.columns)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    row_bytes = sum(texts, F.lit(fixed).cast("bigint"))
    size = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
