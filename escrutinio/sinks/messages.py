"""Message sinks: a Kafka topic, or files of (key, value) where there is no broker."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming.readwriter import DataStreamWriter


def kafka_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}


def _text(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


class KafkaSink:
    """Messages to a topic. On a repeated micro-batch Kafka receives them again; a compacted
    topic or a keyed upsert downstream makes that harmless."""

    def __init__(self, servers: str, topic: str, **options: str):
        self.options = kafka_options(servers, topic, **options)

    def stream(self, messages: DataFrame) -> DataStreamWriter:
        return _text(messages).writeStream.format("kafka").options(**self.options)

    def write(self, messages: DataFrame, batch_id: int) -> None:
        _text(messages).write.format("kafka").options(**self.options).save()


class FileSink:
    """Messages to Parquet files. A micro-batch has its own folder, so repeating it
    replaces it."""

    def __init__(self, path: str):
        self.path = path

    def stream(self, messages: DataFrame) -> DataStreamWriter:
        return _text(messages).writeStream.format("parquet").option("path", self.path)

    def write(self, messages: DataFrame, batch_id: int) -> None:
        _text(messages).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
