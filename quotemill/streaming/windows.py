"""Event-time operators on running streams, and reading their results back.

Windowed results change while a window is open. Each micro-batch writes the
rows it changed as one version; readers take the last version of every key.
Nothing is rewritten, so the cost of a batch follows what changed in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotemill.operators.bars import bar_values, ohlcv
from quotemill.operators.joins import bucket, touched


def start(
    rows: DataFrame, sink, checkpoint_location: str, *, mode: str = "update", interval: str | None = None,
) -> StreamingQuery:
    """Writes every micro-batch of a stateful stream to the sink.

    ``update`` keeps versions of changed rows, ``complete`` the whole result
    per batch. Runs over the messages there are, or at ``interval``.
    """
    writer = (
        rows.writeStream.foreachBatch(lambda batch, batch_id: sink.write(batch, batch_id))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint_location)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def current(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of every key one query wrote in update mode."""
    rest = [c for c in versions.columns if c not in (*keys, "query_id", "batch_id")]
    return (
        versions.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
        .select(*keys, "_row.*")
    )


def newest(versions: DataFrame) -> DataFrame:
    """The result of the last batch one query wrote in complete mode."""
    last = versions.agg(F.max("batch_id").alias("_last"))
    # One row, so the broadcast is bounded.
    return versions.join(F.broadcast(last), F.col("batch_id") == F.col("_last"), "left_semi").drop("query_id", "batch_id")


def bars(trades: DataFrame, width: str, lateness: str | None = None) -> DataFrame:
    """Bars of a trade stream. Trades later than ``lateness`` are dropped.

    Without a bound, every window stays open and late trades always count.
    """
    timed = trades.withWatermark("datetime", lateness) if lateness else trades
    return ohlcv(timed, width)


def ladder(trades: DataFrame, widths: Sequence[str], lateness: str) -> dict[str, DataFrame]:
    """Bars of several widths of a trade stream, each made of the ones before, for append mode.

    Widths ascend, each a multiple of the one before. A bar leaves a step when
    the watermark passes its end and enters the next one, so only the first step
    keeps state per trade minute, and every bar is written once.
    """
    timed = trades.withWatermark("datetime", lateness)
    step = timed.groupBy("symbol", F.window("datetime", widths[0]).alias("bar")).agg(*bar_values())
    out = {widths[0]: step}
    for width in widths[1:]:
        opened = F.when(F.col("open").isNotNull(), F.col("bar.start"))
        step = step.groupBy("symbol", F.window(F.window_time("bar"), width).alias("wider")).agg(
            F.min_by("open", opened).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", opened).alias("close"), F.sum("volume").alias("volume"),
            F.sum("trades").alias("trades")).withColumnRenamed("wider", "bar")
        out[width] = step
    return out


def rungs(trades: DataFrame, widths: Sequence[str], lateness: str) -> DataFrame:
    """All bars of a ladder in one stream, with their width."""
    steps = [
        step.select(F.lit(width).alias("width"), "symbol", F.col("bar.start").alias("datetime"),
                    "open", "high", "low", "close", "volume", "trades")
        for width, step in ladder(trades, widths, lateness).items()]
    return reduce(lambda one, two: one.unionByName(two), steps)


def sessions(trades: DataFrame, gap: str, lateness: str | None = None) -> DataFrame:
    """Sessions of a trade stream, for complete mode or, with a bound, append."""
    timed = trades.withWatermark("datetime", lateness) if lateness else trades
    return (
        timed.groupBy("symbol", F.session_window("datetime", gap).alias("session"))
        .agg(F.count(F.lit(1)).alias("trades"), F.sum(F.col("volume").cast("bigint")).alias("volume"))
        .select("symbol", F.col("session.start").alias("session_start"),
                F.col("session.end").alias("session_end"), "trades", "volume")
    )


def to_bar(
    trades: DataFrame, bars: DataFrame, width: str, lateness: str, *,
    values: Sequence[str] = ("open", "close"), salts: int = 16,
) -> DataFrame:
    """Trades of one stream with the bar of another whose interval holds them.

    Time is cut into buckets of the width, and the bucket is part of the join
    key; a bar stands in the one or two it touches, wherever it starts. A
    stream cannot count keys ahead, so every bucket is spread over ``salts``
    tasks: trades by their id, bars as one copy each. The time condition tells
    Spark when state can go.
    """
    left = trades.withWatermark("datetime", lateness).withColumns({
        "_bucket": bucket("datetime", width),
        "_salt": F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"),
    }).alias("t")
    right = (
        touched(bars.withWatermark("datetime", lateness), width, values)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).alias("b"))
    inside = (
        (F.col("t.symbol") == F.col("b.symbol"))
        & (F.col("t._salt") == F.col("b._salt"))
        & (F.col("t._bucket") == F.col("b._bucket"))
        & (F.col("t.datetime") >= F.col("b.bar_start"))
        & (F.col("t.datetime") < F.col("b.bar_start") + F.expr(f"INTERVAL {width}"))
    )
    columns = [*[f"t.{c}" for c in trades.columns], "b.bar_start", *[f"b.bar_{v}" for v in values]]
    return left.join(right, inside).select(*columns)
