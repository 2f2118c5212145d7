"""Kafka source and sink. They need the public spark-sql-kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# --- fixed values: delivery settings of the sink ------------------------------------------
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.compression.type": "gzip",
}


def read_messages(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Stream of a topic; the message text is in ``value``.

    Messages that the topic has dropped before they were read are an error; ``options`` may say otherwise.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", starting_offsets).option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.options(**options).load()


def write_messages(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None,
                   **options: str) -> StreamingQuery | None:
    """Send rows with ``key``, ``value`` and ``partition`` to a topic, as a batch or as a stream."""
    settings = {**PRODUCER_OPTIONS, "kafka.bootstrap.servers": servers, "topic": topic, **options}
    if messages.isStreaming:
        return (messages.writeStream.format("kafka").options(**settings)
                .option("checkpointLocation", checkpoint).start())
    messages.write.format("kafka").options(**settings).save()
    return None
