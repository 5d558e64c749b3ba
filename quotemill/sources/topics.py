"""Topic scans, streaming and batch, from Kafka or from files of the same row shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotemill.schemas import KAFKA_ROW


@dataclass(frozen=True)
class KafkaTopics:
    """Connection settings of a topic scan.

    Offsets live in the query's checkpoint, so nothing is committed to the
    broker. ``min_partitions`` splits a topic with few partitions over more
    tasks; ``max_offsets_per_trigger`` bounds one micro-batch of a backlog.
    """

    bootstrap_servers: str = "kafka:9092"
    group_id: str | None = None
    starting_offsets: str = "earliest"
    security_protocol: str = "PLAINTEXT"
    min_partitions: int | None = None
    max_offsets_per_trigger: int | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self, topics: Iterable[str], *, streaming: bool) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "kafka.security.protocol": self.security_protocol,
            "subscribe": ",".join(topics),
            "startingOffsets": self.starting_offsets,
        }
        if self.group_id:
            options["kafka.group.id"] = self.group_id
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        if streaming and self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return options | dict(self.extra)

    def read_stream(self, spark: SparkSession, *topics: str) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options(topics, streaming=True)).load()

    def sending(self, topic: str | None = None) -> dict[str, str]:
        """Options of a writer; without a topic, each message goes to the one it names."""
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "kafka.security.protocol": self.security_protocol,
        }
        return options | ({"topic": topic} if topic else {}) | dict(self.extra)

    def write(self, messages: DataFrame, topic: str | None = None) -> None:
        """Sends messages. One task sends each partition; a key's messages keep to one partition of the topic."""
        sent(messages).write.format("kafka").options(**self.sending(topic)).save()

    def write_stream(
        self, messages: DataFrame, checkpoint_location: str, topic: str | None = None, *, interval: str | None = None,
    ) -> StreamingQuery:
        """Sends a stream of messages, at least once: a batch that is repeated is sent again."""
        writer = sent(messages).writeStream.format("kafka").options(**self.sending(topic)).option(
            "checkpointLocation", checkpoint_location)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def read_batch(self, spark: SparkSession, *topics: str, since: datetime | None = None) -> DataFrame:
        """Messages there are now, or those sent from ``since`` on."""
        options = self.options(topics, streaming=False)
        if since is not None:
            options |= {
                "startingTimestamp": str(int(since.timestamp() * 1000)),
                # A partition without newer messages has nothing to read.
                "startingOffsetsByTimestampStrategy": "latest",
            }
        return spark.read.format("kafka").options(**options).load()


@dataclass(frozen=True)
class FileTopics:
    """Messages kept in files, one column per field of a Kafka row."""

    path: str
    format: str = "parquet"
    max_files_per_trigger: int | None = None

    def read_stream(self, spark: SparkSession, *topics: str) -> DataFrame:
        reader = spark.readStream.schema(KAFKA_ROW).format(self.format)
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return of_topics(reader.load(self.path), *topics)

    def read_batch(self, spark: SparkSession, *topics: str, since: datetime | None = None) -> DataFrame:
        """Messages there are now, or those sent from ``since`` on."""
        messages = self._read(spark, *topics)
        return messages if since is None else messages.where(F.col("timestamp") >= F.lit(since))

    def write(self, messages: DataFrame, topic: str | None = None) -> None:
        """Appends messages as files of a topic's rows."""
        named = messages if topic is None else messages.withColumn("topic", F.lit(topic))
        shaped(named).write.format(self.format).mode("append").save(self.path)

    def write_stream(
        self, messages: DataFrame, checkpoint_location: str, topic: str | None = None, *, interval: str | None = None,
    ) -> StreamingQuery:
        """Appends a stream of messages, each batch once."""
        named = messages if topic is None else messages.withColumn("topic", F.lit(topic))
        writer = shaped(named).writeStream.format(self.format).option("path", self.path).option(
            "checkpointLocation", checkpoint_location)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def _read(self, spark: SparkSession, *topics: str) -> DataFrame:
        return of_topics(spark.read.schema(KAFKA_ROW).format(self.format).load(self.path), *topics)


def sent(messages: DataFrame) -> DataFrame:
    """The columns a topic takes; partition and offset are its own to give."""
    return messages.select(*[c for c in ("key", "value", "topic") if c in messages.columns])


def shaped(messages: DataFrame) -> DataFrame:
    """Messages as a topic's rows: columns they lack are null, types are those of a topic."""
    return messages.select(*[
        (F.col(f.name) if f.name in messages.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in KAFKA_ROW])


def of_topics(messages: DataFrame, *topics: str) -> DataFrame:
    """Messages of the named topics; all of them when none is named."""
    return messages.where(F.col("topic").isin(*topics)) if topics else messages
