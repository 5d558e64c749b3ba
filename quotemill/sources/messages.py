"""Rows to topic messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.schemas import KAFKA_ROW


def encode(
    rows: DataFrame,
    fields: T.StructType,
    topic: str,
    *,
    key: Column,
    partition: Column,
    offset: Column,
    timestamp: Column,
) -> DataFrame:
    """One JSON object per row, in the shape of a Kafka row.

    Null fields are left out of the object, as ``to_json`` does.
    """
    body = F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]))
    return payload(rows, body, topic, key=key, partition=partition, offset=offset, timestamp=timestamp)


def payload(
    rows: DataFrame,
    body: Column,
    topic: str,
    *,
    key: Column,
    partition: Column,
    offset: Column,
    timestamp: Column,
) -> DataFrame:
    """Message text as given, in the shape of a Kafka row."""
    columns = {
        "key": key.cast("string"),
        "value": body,
        "topic": F.lit(topic),
        "partition": partition,
        "offset": offset,
        "timestamp": timestamp,
        "timestampType": F.lit(0),
    }
    return rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in KAFKA_ROW])
