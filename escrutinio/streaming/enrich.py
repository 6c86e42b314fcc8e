"""Clean votes joined with a dimension that may change while the stream runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from escrutinio.operators.reference import province_lookup
from escrutinio.schemas import PROVINCE_LOOKUP, SILVER
from escrutinio.session import configure_state
from escrutinio.sinks.versions import read_current, versions, write_version
from escrutinio.streaming.lake import Lake, Trigger, layer


def publish_provinces(lookup: DataFrame, lake: Lake) -> None:
    """Put a new version of the dimension in place; micro-batches from then on use it."""
    known = versions(lookup.sparkSession, lake.provinces)
    write_version(lookup.select(*PROVINCE_LOOKUP.names), lake.provinces, known[-1] + 1 if known else 0)


def enriched(votes: DataFrame, lookup: DataFrame) -> DataFrame:
    """Votes with the names and codes of their province's region as the dimension has them; NULL if it has not."""
    return province_lookup(votes, lookup)


def start_enriched(spark: SparkSession, lake: Lake, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Append silver votes with their region, by the newest version of the dimension.

    A join with a table that was read when the query was built would keep the files of that
    time. The callback reads the newest complete version once for its micro-batch, whose output
    has a folder of its own and is replaced if the batch comes again.
    """
    configure_state(spark)

    def publish(batch: DataFrame, batch_id: int) -> None:
        lookup = read_current(spark, lake.provinces, PROVINCE_LOOKUP)
        enriched(batch, lookup).write.mode("overwrite").parquet(f"{lake.enriched}/batch_id={batch_id}")

    writer = layer(spark, lake, lake.silver, SILVER, trigger).writeStream.foreachBatch(publish)
    return trigger.start(writer, lake.checkpoint("enriched"))
