"""Duplicates and the common shape of both feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(rows: DataFrame, remember: str | None = None) -> DataFrame:
    """One row per id.

    Replayed messages have equal ids and equal content, so it does not matter
    which copy stays. A stream remembers ids for ``remember`` after they arrive,
    by its own clock, which bounds the state: the first copy is never dropped,
    however old its time, and later copies are dropped while the id is known.
    Without ``remember`` ids are never forgotten.
    """
    if rows.isStreaming and remember is not None:
        return (
            rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
            .dropDuplicatesWithinWatermark(["id"]).drop("_arrived"))
    return rows.dropDuplicates(["id"])


def quotes(trades: DataFrame, bars: DataFrame) -> DataFrame:
    """Both feeds as quotes: symbol, time, price, volume, and bar range if any."""
    from_trades = trades.select(
        F.lit("trades").alias("feed"), "id", "symbol", "datetime",
        F.col("last_price").alias("price"), "volume")
    from_bars = bars.select(
        F.lit("bars").alias("feed"), "id", F.col("ticker").alias("symbol"), "datetime",
        F.col("close").alias("price"), "volume", "open", "high", "low")
    return from_trades.unionByName(from_bars, allowMissingColumns=True)
