"""Registered queries of the ingest path: decode, check, project, store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions import parsing
from quotemill.functions.identity import message_id, random_id
from quotemill.operators import gate
from quotemill.plans import inputs
from quotemill.schemas import BAR_MESSAGE, TRADE_MESSAGE
from quotemill.session import scratch_path
from quotemill.sources.feeds import BARS, TRADES
from quotemill.sources.topics import FileTopics, of_topics
from quotemill.streaming import sinks
from quotemill.streaming.jobs import accepted_rows, ingest, run, table_rows


def flat(rows: DataFrame) -> DataFrame:
    """Table rows with UTC wall times and the condition list as text."""
    if "trade_conditions" in rows.columns:
        rows = rows.withColumn("trade_conditions", F.array_join("trade_conditions", ","))
    return inputs.wall_time(rows)


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.trade_messages(inputs.events(spark, sf_dir))


def bar_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.bar_messages(inputs.events(spark, sf_dir))


def flawed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.flawed_messages(inputs.events(spark, sf_dir))


def decode_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsing.decode(trade_messages(spark, sf_dir), TRADE_MESSAGE, keep=("offset",))
    return rows.withColumn("c", F.array_join("c", ","))


def decode_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsing.decode(bar_messages(spark, sf_dir), BAR_MESSAGE)
    return rows.select(*[F.col(c).alias(c.lower().replace(" ", "_")) for c in rows.columns])


def trade_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(table_rows(trade_messages(spark, sf_dir), TRADES))


def bar_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(table_rows(bar_messages(spark, sf_dir), BARS))


def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsing.decode(trade_messages(spark, sf_dir), TRADE_MESSAGE, keep=("offset",))
    return inputs.wall_time(rows.select(
        "offset",
        parsing.epoch_ms_to_time(F.col("t")).alias("at"),
        parsing.epoch_ms_to_text(F.col("t")).alias("at_second"),
    ))


def deterministic_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_messages(spark, sf_dir).select("offset", message_id().alias("id"))


def random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random ids are distinct and have the layout of a UUID."""
    rows = table_rows(trade_messages(spark, sf_dir), TRADES, random_id())
    shape = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_if(F.col("id").rlike(shape)).alias("well_formed"),
    )


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics in one scan, routed to the feed of each topic."""
    both = trade_messages(spark, sf_dir).unionByName(bar_messages(spark, sf_dir))
    routed = None
    for feed in (TRADES, BARS):
        rows = table_rows(of_topics(both, feed.topic), feed)
        part = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("volume").cast("bigint")).alias("volume"))
        part = part.withColumn("table_name", F.lit(feed.table))
        routed = part if routed is None else routed.unionByName(part)
    return routed


def message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of the readiness rule for every message."""
    return gate.with_outcome(flawed_messages(spark, sf_dir), TRADES).select("offset", "outcome")


def valid_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(table_rows(gate.valid_messages(trade_messages(spark, sf_dir), TRADES), TRADES))


def valid_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(table_rows(gate.valid_messages(bar_messages(spark, sf_dir), BARS), BARS))


def accepted_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasoned = gate.with_reason(flawed_messages(spark, sf_dir), TRADES)
    return flat(accepted_rows(reasoned, TRADES))


def quarantined_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasoned = gate.with_reason(flawed_messages(spark, sf_dir), TRADES)
    return gate.quarantined(reasoned).select("offset", "reason")


def quarantined_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasoned = gate.with_reason(bar_messages(spark, sf_dir), BARS)
    return gate.quarantined(reasoned).select("partition", "offset", "reason")


def first_valid_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = gate.first_valid(flawed_messages(spark, sf_dir), TRADES)
    return first.select("topic", "partition", "offset")


def ingest_trades_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade stream into batch directories, read back as the stored table."""
    messages = inputs.trade_messages(inputs.event_stream(spark, sf_dir))
    sink = sinks.BatchDirectory(scratch_path(spark, "trades"))
    run(ingest(messages, TRADES, sink, scratch_path(spark, "offsets")))
    return flat(sink.read(spark, TRADES.row).select(*TRADES.row.names))


def ingest_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs with checkpoints of their own fill one table; neither replaces the other's rows."""
    sink = sinks.BatchDirectory(scratch_path(spark, "trades"))
    for half in (0, 1):
        topic = scratch_path(spark, "topic")
        trade_messages(spark, sf_dir).where(F.col("offset") % 2 == half).write.parquet(topic)
        stream = FileTopics(topic).read_stream(spark, TRADES.topic)
        run(ingest(stream, TRADES, sink, scratch_path(spark, "offsets")))
    return flat(sink.read(spark, TRADES.row).select(*TRADES.row.names))


def ingest_bars_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar messages written as files of the topic's shape, then streamed."""
    topic = scratch_path(spark, "topic")
    bar_messages(spark, sf_dir).write.parquet(topic)
    messages = FileTopics(topic).read_stream(spark, BARS.topic)
    sink = sinks.BatchDirectory(scratch_path(spark, "bars"))
    run(ingest(messages, BARS, sink, scratch_path(spark, "offsets")))
    return flat(sink.read(spark, BARS.row).select(*BARS.row.names))


def ingest_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checked stream: every message in the table or in quarantine."""
    messages = inputs.flawed_messages(inputs.event_stream(spark, sf_dir))
    stored = sinks.BatchDirectory(scratch_path(spark, "trades"))
    held = sinks.BatchDirectory(scratch_path(spark, "quarantine"))
    run(ingest(messages, TRADES, stored, scratch_path(spark, "offsets"), quarantine=held))
    ids = stored.read(spark, TRADES.row).select("id", F.lit("stored").alias("side"))
    raw = spark.read.parquet(held.path)
    return ids.unionByName(raw.select(message_id().alias("id"), F.col("reason").alias("side")))


def _catalog_table(spark: SparkSession, sf_dir: str, feed, messages: DataFrame) -> DataFrame:
    inputs.table(spark, sf_dir, "events")
    database = f"finance_{uuid.uuid4().hex}"
    sinks.create_database(spark, database, scratch_path(spark, database))
    table = sinks.create_table(spark, feed, database)
    # A second create must leave the table alone, a second write of the same
    # batch must replace the first.
    sinks.create_table(spark, feed, database)
    sink = sinks.CatalogTable(table)
    rows = table_rows(messages, feed)
    sink.write(rows, 0)
    sink.write(rows, 0)
    return flat(spark.table(table).select(*feed.row.names))


def ingest_trades_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_table(spark, sf_dir, TRADES, trade_messages(spark, sf_dir))


def ingest_bars_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_table(spark, sf_dir, BARS, bar_messages(spark, sf_dir))


def table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of both stored tables, with how many values arrived."""
    found = None
    for feed, messages in ((TRADES, trade_messages), (BARS, bar_messages)):
        counts = table_rows(messages(spark, sf_dir), feed).agg(
            *[F.count(c).alias(c) for c in feed.row.names])
        columns = F.array(*[
            F.struct(
                F.lit(feed.table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f.name).alias("filled"),
            )
            for f in feed.row
        ])
        part = counts.select(F.inline(columns))
        found = part if found is None else found.unionByName(part)
    return found


QUERIES = {
    f.__name__: f
    for f in (
        decode_trades, decode_bars, trade_projection, bar_projection,
        epoch_to_timestamp, deterministic_id, random_ids, topic_routing, message_outcomes,
        valid_trades, valid_bars, accepted_trades, quarantined_trades, quarantined_bars,
        first_valid_message, ingest_trades_stream, ingest_two_checkpoints, ingest_bars_stream, ingest_split_stream,
        ingest_trades_table, ingest_bars_table, table_contract,
    )
}
