"""The test tables in the shape of messages, trades, bars and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.identity import message_id
from quotemill.functions.once import with_computed
from quotemill.operators.bars import ohlcv
from quotemill.schemas import BAR_MESSAGE, TRADE_MESSAGE
from quotemill.sources.feeds import BARS, TRADES
from quotemill.sources.messages import encode, payload


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Stored times carry no zone; the engine reads them as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed(table(spark, sf_dir, "events"))


def timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A file stream takes a directory or a pattern, not the name of one file.
    return timed(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"))


def trade_fields(events: DataFrame) -> DataFrame:
    """Event columns plus the fields of a trade message."""
    return events.select(
        "event_id",
        "ts",
        F.array("event_type").alias("c"),
        F.col("value").alias("p"),
        F.col("user_id").cast("string").alias("s"),
        F.unix_millis("ts").alias("t"),
        F.floor("value").cast("double").alias("v"),
        "event_type",
    )


def _trade_place() -> dict[str, Column]:
    return {
        "key": F.col("s"),
        "partition": F.lit(0),
        "offset": F.col("event_id"),
        "timestamp": F.col("ts"),
    }


def trade_messages(events: DataFrame) -> DataFrame:
    return encode(trade_fields(events), TRADE_MESSAGE, TRADES.topic, **_trade_place())


def flawed_messages(events: DataFrame) -> DataFrame:
    """Trade messages of which most event types carry one kind of flaw."""
    rows = trade_fields(events)
    kind = F.col("event_type")
    even = F.col("event_id") % 2 == 0
    rows = (
        rows.withColumn("v", F.when(kind == "view", F.col("v") + 0.5).otherwise(F.col("v")))
        .withColumn("s", F.when(kind == "signup", F.lit("")).otherwise(F.col("s")))
        .withColumn("t", F.when((kind == "purchase") & even, F.lit(2**62)).otherwise(F.col("t")))
    )
    rows = with_computed(rows, "body", F.to_json(F.struct(*TRADE_MESSAGE.names)))
    quoted_volume = F.col("v").cast("string").alias("v")
    text = (
        F.when(kind == "error", F.expr("left(body, length(body) - 1)"))
        .when(
            (kind == "purchase") & ~even,
            F.to_json(F.struct(*[quoted_volume if n == "v" else n for n in TRADE_MESSAGE.names])),
        )
        .otherwise(F.col("body"))
    )
    rows = with_computed(rows, "text", text)
    return payload(rows, F.col("text"), TRADES.topic, **_trade_place())


def trades(events: DataFrame, symbol: str = "user_id") -> DataFrame:
    """Stored trades with full-width numbers; ``symbol`` names the event column used."""
    return events.select(
        message_id(F.lit(TRADES.topic), F.lit(0), F.col("event_id")).alias("id"),
        F.array("event_type").alias("trade_conditions"),
        F.col("value").alias("last_price"),
        F.col(symbol).cast("string").alias("symbol"),
        F.timestamp_millis(F.unix_millis("ts")).alias("datetime"),
        F.floor("value").cast("int").alias("volume"),
    )


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as daily trades of a part."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").cast("string").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("datetime"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("last_price"),
        F.col("l_quantity").cast("int").alias("volume"),
        F.col("l_quantity").alias("quantity"),
    )


FILL_TIES = ("order_id", "line", "last_price", "volume")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("holder"))


def bar_fields(events: DataFrame) -> DataFrame:
    """Hourly bars per event type with the fields of a bar message."""
    bars = ohlcv(trades(events, "event_type"), "1 hour")
    return bars.select(
        F.concat(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")).alias("Datetime"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("close").alias("Adj Close"),
        F.col("volume").cast("double").alias("Volume"),
        F.lit(0.0).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"),
        F.col("symbol").alias("ticker"),
        F.ascii("symbol").alias("_partition"),
        (F.unix_seconds("datetime") / 3600).cast("bigint").alias("_offset"),
    )


def bar_messages(events: DataFrame) -> DataFrame:
    return encode(
        bar_fields(events), BAR_MESSAGE, BARS.topic,
        key=F.col("ticker"),
        partition=F.col("_partition"),
        offset=F.col("_offset"),
        timestamp=F.timestamp_seconds(F.col("_offset") * 3600),
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per part, with payments read off the line number.

    A line 7 on a day is a two-for-one split, a line 6 a dividend of 10.
    """
    trades = fills(spark, sf_dir)
    place = F.struct(*FILL_TIES)
    return trades.groupBy("symbol", "datetime").agg(
        F.max_by("last_price", place).alias("close"),
        F.when(F.max("line") == 7, 2.0).otherwise(0.0).alias("stock_splits"),
        F.when(F.count_if(F.col("line") == 6) > 0, 10.0).otherwise(0.0).alias("dividends"),
    )


def wall_time(rows: DataFrame) -> DataFrame:
    """Timestamps as UTC times without a zone, as the stored tables have them."""
    return rows.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in rows.schema
    ])
