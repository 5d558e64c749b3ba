"""Message and table contracts of the two feeds.

Field names and table columns are fixed values: stored data and running
producers depend on them. Numbers are parsed wide (double, bigint) and
narrowed only when a row is written, so a value that does not fit is seen
instead of silently lost.
"""

from __future__ import annotations

from pyspark.sql import types as T

KAFKA_ROW = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

TRADE_MESSAGE = T.StructType([
    T.StructField("c", T.ArrayType(T.StringType())),
    T.StructField("p", T.DoubleType()),
    T.StructField("s", T.StringType()),
    T.StructField("t", T.LongType()),
    T.StructField("v", T.DoubleType()),
])

BAR_MESSAGE = T.StructType([
    T.StructField("Datetime", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Adj Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
    T.StructField("Dividends", T.DoubleType()),
    T.StructField("Stock Splits", T.DoubleType()),
    T.StructField("ticker", T.StringType()),
])

TRADE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("trade_conditions", T.ArrayType(T.StringType())),
    T.StructField("last_price", T.FloatType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("volume", T.IntegerType()),
])

BAR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("open", T.FloatType()),
    T.StructField("high", T.FloatType()),
    T.StructField("low", T.FloatType()),
    T.StructField("close", T.FloatType()),
    T.StructField("adj_close", T.FloatType()),
    T.StructField("volume", T.IntegerType()),
    T.StructField("dividends", T.FloatType()),
    T.StructField("stock_splits", T.FloatType()),
    T.StructField("ticker", T.StringType()),
])
