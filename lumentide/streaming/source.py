"""Event streams of shape `value binary, topic string`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from lumentide.schemas import STREAM_TOPICS
from lumentide.sources.landed import ALL_AGES

MESSAGE = T.StructType([
    T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()),
])


def kafka_options(
    servers: str, topics: Sequence[str] = STREAM_TOPICS, max_offsets: int | None = None,
    starting: str = "latest", fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the Kafka source: all topics as one stream.

    By default a trigger takes all there is, and offsets the broker has dropped before
    they were read stop the stream rather than go unnoticed. A cap such as 50,000 offsets
    per trigger bounds a micro-batch; it has to exceed the topics' rate, or the backlog
    outgrows the broker's retention.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_event_stream(
    spark: SparkSession, servers: str, topics: Sequence[str] = STREAM_TOPICS,
    max_offsets: int | None = None, starting: str = "latest", fail_on_data_loss: bool = True,
) -> DataFrame:
    """The live stream. Needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topics, max_offsets, starting, fail_on_data_loss)
    return spark.readStream.format("kafka").options(**options).load().select("value", "topic")


def read_landed_stream(
    spark: SparkSession, path: str, max_files: int | None = None,
) -> DataFrame:
    """The same stream from Parquet files of messages of any age, for replays and tests.

    Files may lie in folders by topic and batch, as `feeds.write_messages` leaves them.
    """
    schema = T.StructType([*MESSAGE, T.StructField("batch", T.StringType())])
    reader = spark.readStream.schema(schema).option("maxFileAge", ALL_AGES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*MESSAGE.fieldNames())
