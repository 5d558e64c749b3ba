"""Payload text, JSON and time conversions that never raise on bad input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epoch milliseconds of 0001-01-01 and 9999-12-31, the range of a timestamp.
MIN_EPOCH_MS = -62_135_596_800_000
MAX_EPOCH_MS = 253_402_300_799_999

MAX_INT = 2**31 - 1


def payload_text(value: Column | str = "value") -> Column:
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def parse_message(text: Column, schema: T.StructType) -> Column:
    """Permissive parse: a bad field is null, a bad document is all null."""
    return F.from_json(text, schema)


def decode(messages: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages to the flat columns of ``schema``; ``keep`` passes columns along."""
    return messages.select(
        *keep, parse_message(payload_text(), schema).alias("data")
    ).select(*keep, "data.*")


def epoch_ms_to_time(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp; null outside years 1 to 9999."""
    return F.when(ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS), F.timestamp_millis(ms))


def epoch_ms_to_text(ms: Column) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd HH:mm:ss`` text, cut to the second."""
    return F.from_unixtime(F.floor(ms / 1000))


def text_to_time(text: Column) -> Column:
    """ISO text, with or without an offset, to a timestamp; null when unreadable."""
    return text.try_cast("timestamp")


def fits_int(number: Column) -> Column:
    """Whether a double is a whole number that an int holds."""
    return (number == F.floor(number)) & number.between(-MAX_INT - 1, MAX_INT)


def to_int(number: Column) -> Column:
    """Double to int; null for a fraction or a value an int cannot hold."""
    return F.when(number.between(-MAX_INT - 1, MAX_INT) & (number == F.floor(number)), number.cast("int"))
