"""Queue messages: one text of comma-separated ids each."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.names import decode_utf8


def _shaped(body, message_id):
    return [message_id.alias("message_id"), decode_utf8(body).alias("value")]


def message_stream(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """Messages dropped as files into a folder, one message per file."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(path)
    return raw.select(*_shaped(F.col("value").cast("binary"), F.col("_metadata.file_path")))


def broker_stream(spark: SparkSession, **options) -> DataFrame:
    """Messages of a Kafka-protocol broker (needs the connector on the class path)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    place = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return raw.select(*_shaped(F.col("value"), place))
