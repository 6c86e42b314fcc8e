"""Message sources: a Kafka topic, or files where there is no broker."""

from pyspark.sql import DataFrame, SparkSession

# Topic names.
TOPIC_VOTES_RAW = "votes_raw"
TOPIC_VOTES_CLEAN = "votes_clean"
TOPIC_VOTES_SEATS_PROVINCES = "votes_seats_provinces"


def kafka_options(servers: str, topic: str, starting: str = "earliest", **options: str) -> dict[str, str]:
    """Options of the Kafka source; extra ones such as ``maxOffsetsPerTrigger`` pass through."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **options}


def kafka_stream(spark: SparkSession, servers: str, topic: str = TOPIC_VOTES_RAW, **options: str) -> DataFrame:
    """Messages of a topic as they arrive, from the earliest offset at the first start.

    ``maxOffsetsPerTrigger`` bounds a micro-batch, the first one over a backlog above all.
    """
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder, as ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def file_table(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the text files in a folder, as ``value``."""
    return spark.read.text(path)
