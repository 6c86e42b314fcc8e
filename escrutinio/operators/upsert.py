"""Keyed upsert of messages into a served table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_latest(current: DataFrame, changes: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """The newest row of each key; a key whose newest row has a NULL ``value`` is deleted.

    Newest by ``order``, best a sequence such as the micro-batch and never a clock, which may
    step back. On a tie a change replaces the current row, and a deletion another change. An
    aggregate, so many changes of one key collapse in the map tasks.
    """
    unknown = [name for name in order if name not in current.columns]
    if unknown or not order:
        raise ValueError(f"order must name columns of the table: {list(order)}")
    payload = [name for name in current.columns if name != key and name not in order]
    newest = (
        current.withColumn("_change", F.lit(0))
        .unionByName(changes.withColumn("_change", F.lit(1)))
        .groupBy(key)
        .agg(F.max(F.struct(*order, "_change", F.col(value).isNull().alias("_gone"), *payload)).alias("_row"))
    )
    rows = newest.select(key, *(F.col("_row")[name].alias(name) for name in [*order, *payload]))
    return rows.filter(F.col(value).isNotNull()).select(*current.columns)
