"""Top-k per group where k is a column."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_by_column(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: str, rank: str = "ranking", salts: int = 16
) -> DataFrame:
    """Keep the first ``k`` rows of each group and number them in ``rank``.

    Two steps: rank within (keys, salt) and drop what is beyond k there, then rank the
    survivors. A row outside its salt's top k is outside the group's top k, so nothing is
    lost, and a group of any size is sorted by ``salts`` tasks; the last step sees at most
    salts * k rows of it. ``order`` must be a total order for a determined result.
    """
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= F.col(k))
        .drop("_salt", "_rank")
        .withColumn(rank, F.row_number().over(last))
        .filter(F.col(rank) <= F.col(k))
    )
