"""Decoded message columns to the columns of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.parsing import epoch_ms_to_time, text_to_time, to_int

BAR_PRICES = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
}
BAR_EVENTS = {"Dividends": "dividends", "Stock Splits": "stock_splits"}


def trades(decoded: DataFrame, row_id: Column) -> DataFrame:
    """Decoded trade messages as rows of the trade table."""
    return decoded.select(
        row_id.alias("id"),
        F.col("c").alias("trade_conditions"),
        F.col("p").cast("float").alias("last_price"),
        F.col("s").alias("symbol"),
        epoch_ms_to_time(F.col("t")).alias("datetime"),
        to_int(F.col("v")).alias("volume"),
    )


def bars(decoded: DataFrame, row_id: Column) -> DataFrame:
    """Decoded bar messages as rows of the bar table."""
    return decoded.select(
        row_id.alias("id"),
        text_to_time(F.col("Datetime")).alias("datetime"),
        *[F.col(field).cast("float").alias(name) for field, name in BAR_PRICES.items()],
        to_int(F.col("Volume")).alias("volume"),
        *[F.col(field).cast("float").alias(name) for field, name in BAR_EVENTS.items()],
        F.col("ticker"),
    )
