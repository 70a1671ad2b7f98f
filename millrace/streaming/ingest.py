"""Messages into a lake table: read the envelope, decode the record, append with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.session import setting
from millrace.sources.feed import ENVELOPE, WEATHER, decode_messages
from millrace.sources.tables import DEFAULT_FORMAT

# Session settings that name the broker, topic and consumer group.
BROKER_SETTING = "spark.kafka_controller"
TOPIC_SETTING = "spark.kafka_topic"
GROUP_SETTING = "spark.kafka_group_id"


def open_topic(spark: SparkSession, servers: str | None = None, topic: str | None = None, group: str | None = None,
               starting_offsets: str = "earliest", offsets_per_batch: int | None = None, **options: str) -> DataFrame:
    """Envelope rows of a Kafka topic; the broker settings of the session apply where nothing is given.

    ``offsets_per_batch`` bounds every batch, also the first one from the earliest offset. Needs the Kafka package
    on the cluster.
    """
    given = {
        "kafka.bootstrap.servers": servers or setting(spark, BROKER_SETTING),
        "subscribe": topic or setting(spark, TOPIC_SETTING),
        "kafka.group.id": group or setting(spark, GROUP_SETTING),
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": None if offsets_per_batch is None else str(offsets_per_batch),
    }
    present = {name: value for name, value in given.items() if value is not None}
    return spark.readStream.format("kafka").options(**present, **options).load()


def open_files(spark: SparkSession, path: str, schema: StructType = ENVELOPE, fmt: str = DEFAULT_FORMAT,
               files_per_batch: int | None = None) -> DataFrame:
    """Rows of a growing folder of files, from the first file on; by default message envelopes."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def append_stream(rows: DataFrame, path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT,
                  until_caught_up: bool = False) -> StreamingQuery:
    """Append to a lake table, each row once across restarts with the same checkpoint.

    ``until_caught_up`` stops after everything present at the start has been read.
    """
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("mergeSchema", "true")
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start(path)


def without_repeats(rows: DataFrame, keys: list[str], stamp: str, within: str) -> DataFrame:
    """Every message once, however often it is delivered, up to ``within`` (such as ``"2 days"``) after its time ``stamp``.

    The keys seen are kept with the checkpoint of the stream, in as many parts as its shuffles have, and go when no
    message of their time can come any more. Messages that come later than that are dropped.
    """
    return rows.withWatermark(stamp, within).dropDuplicatesWithinWatermark(keys)


def load_stream(rows: DataFrame, load: Callable[[DataFrame, int], object], checkpoint: str,
                until_caught_up: bool = False) -> StreamingQuery:
    """Hand every batch, with its number, to ``load``. After a failure a batch comes again, with the same rows and number."""
    writer = rows.writeStream.foreachBatch(lambda batch, number: load(batch, number) and None)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start()


def ingest(messages: DataFrame, path: str, checkpoint: str, schema: StructType = WEATHER, codec: str = "json",
           fmt: str = DEFAULT_FORMAT, until_caught_up: bool = False) -> StreamingQuery:
    """Decode messages and append the records to a lake table."""
    return append_stream(decode_messages(messages, schema, codec), path, checkpoint, fmt, until_caught_up)
