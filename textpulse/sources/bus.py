"""Message sources: a topic on the bus, or a directory of envelopes standing in for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.config import DEFAULTS, PulseConfig
from textpulse.schemas import ENVELOPE


def topic_options(
    config: PulseConfig, topic: str, max_per_trigger: int | None = None
) -> dict[str, str]:
    """Reader options; where to start, what to do about lost data and the cap are settings."""
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(
    spark: SparkSession, config: PulseConfig, topic: str, max_per_trigger: int | None = None
) -> DataFrame:
    options = topic_options(config, topic, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def posts_stream(spark: SparkSession, config: PulseConfig = DEFAULTS) -> DataFrame:
    source = read_topic(spark, config, config.posts_topic, config.max_records_per_trigger)
    return source.withColumn("content_type", F.lit("post"))


def comments_stream(spark: SparkSession, config: PulseConfig = DEFAULTS) -> DataFrame:
    source = read_topic(spark, config, config.comments_topic, config.max_records_per_trigger)
    return source.withColumn("content_type", F.lit("comment"))


def as_text(messages: DataFrame) -> DataFrame:
    """Key and value as strings."""
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


def processed_stream(spark: SparkSession, config: PulseConfig = DEFAULTS) -> DataFrame:
    return as_text(read_topic(spark, config, config.processed_topic))


def dead_letter_stream(spark: SparkSession, config: PulseConfig = DEFAULTS) -> DataFrame:
    return as_text(read_topic(spark, config, config.dead_letter_topic))


def directory_stream(
    spark: SparkSession,
    path: str,
    content_type: str | None = None,
    *,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Envelopes from files that appear in a directory; the cap counts files."""
    reader = spark.readStream.schema(ENVELOPE).format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(path)
    return stream if content_type is None else stream.withColumn("content_type", F.lit(content_type))
