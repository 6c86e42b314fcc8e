"""A derived table written once and read where it is needed."""

from pyspark.sql import DataFrame

from escrutinio.session import scratch_dir


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage, survives the loss of executors, and gives Spark the true size of the
    table, by which it chooses between broadcast and shuffle. The files stay until the
    owner of the folder removes them, as with Spark's checkpoints.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
