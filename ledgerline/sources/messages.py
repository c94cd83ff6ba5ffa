"""The message source: a topic in production, files of the same shape elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# How a start position is named outside and in Spark.
START_POSITIONS = {"earliest-offset": "earliest", "latest-offset": "latest"}


def topic_options(
    servers: str,
    topic: str,
    group: str,
    start: str = "latest-offset",
    per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the Kafka source; anything but earliest starts at the end.

    Offsets that are gone stop the query, unless a caller says that they may be skipped.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": START_POSITIONS.get(start.lower(), "latest"),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def topic_messages(spark: SparkSession, **settings) -> DataFrame:
    """Unbounded ``value STRING`` from a topic; needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**topic_options(**settings)).load()
    return stream.selectExpr("CAST(value AS STRING) AS value")


def file_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded ``value STRING``, one message per line of text files landing in a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)
