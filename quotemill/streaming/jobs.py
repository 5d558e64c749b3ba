"""Ingest jobs: topic to typed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quotemill.functions.identity import message_id, random_id
from quotemill.functions.parsing import decode
from quotemill.operators import gate, reports
from quotemill.session import shared_dir
from quotemill.sources.feeds import Feed
from quotemill.streaming.sinks import query_of

POSITION = ("topic", "partition", "offset")
HELD = T.StructField("held", T.BooleanType())


def table_rows(messages: DataFrame, feed: Feed, row_id: Column | None = None) -> DataFrame:
    """Messages as rows of the feed's table, batch or streaming.

    Every message gives a row, also one that does not parse.
    """
    decoded = decode(messages, feed.message, keep=POSITION)
    return feed.projection(decoded, message_id() if row_id is None else row_id)


def accepted_rows(reasoned: DataFrame, feed: Feed, row_id: Column | None = None) -> DataFrame:
    """Rows of the feed's table for the messages that passed the checks."""
    decoded = gate.accepted(reasoned).select(*POSITION, "data.*")
    return feed.projection(decoded, message_id() if row_id is None else row_id)


def staged(batch: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """The two sides of a checked batch, accepted and held back, from one pass over it.

    The batch is written once to the shared folder, parted by side, with what
    each side needs of it. A query has one such folder; the next batch replaces it.
    """
    path = f"{shared_dir(batch.sparkSession)}/staged-{query_of(batch)}-{feed.name}"
    held = F.col("reason").isNotNull()
    raw = [c for c in batch.columns if c not in (*POSITION, "data", "reason")]
    batch.select(
        *POSITION, held.alias("held"), "reason", F.when(~held, F.col("data")).alias("data"),
        *[F.when(held, F.col(c)).alias(c) for c in raw],
    ).write.mode("overwrite").partitionBy("held").parquet(path)
    whole = batch.sparkSession.read.schema(T.StructType([*batch.schema.fields, HELD])).parquet(path)
    good, bad = (whole.where(F.col("held") == side).drop("held") for side in (False, True))
    return good.select(batch.columns), bad.select(batch.columns)


def watched(write: Callable[[DataFrame, int], None], rows: DataFrame, batch_id: int, checks: list[Column]) -> dict:
    """Writes rows and returns the checks over them, taken from the write itself."""
    seen = Observation()
    write(rows.observe(seen, *checks), batch_id)
    return seen.get


def ingest(
    messages: DataFrame,
    feed: Feed,
    sink,
    checkpoint_location: str,
    *,
    quarantine=None,
    random_ids: bool = False,
    interval: str | None = None,
    continuous: bool = False,
    explain: bool = False,
    quality=None,
) -> StreamingQuery:
    """Starts the stream that fills a feed's table.

    By default the query handles all messages there are and stops; a scheduler
    can rerun it. ``continuous`` keeps it running, ``interval`` also sets the
    pace. With a ``quarantine`` sink, messages that fail the checks go there
    with a reason, in their raw form, and only the others reach ``sink``; a
    batch is read and checked once for both. ``random_ids`` gives ids that
    differ between replays; use it only where ids need not be stable. A
    ``quality`` sink gets one row of quality counts per batch, observed while
    the batch's rows are written.
    """
    row_id = random_id() if random_ids else None
    checks = reports.checks(feed.row)

    def store(rows: DataFrame, batch_id: int) -> None:
        if quality is None:
            sink.write(rows, batch_id)
            return
        found = watched(sink.write, rows, batch_id, checks)
        spark = rows.sparkSession
        names = ", ".join(f"`{name}` bigint" for name in found)
        quality.write(spark.createDataFrame([tuple(found.values())], names), batch_id)

    if quarantine is None:
        rows = table_rows(messages, feed, row_id)
        write = store
    else:
        rows = gate.with_reason(messages, feed)

        def write(batch: DataFrame, batch_id: int) -> None:
            good, bad = staged(batch, feed)
            store(accepted_rows(good, feed, row_id), batch_id)
            quarantine.write(gate.quarantined(bad), batch_id)

    if explain:
        rows.explain(True)
    writer = (
        rows.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_location)
        .queryName(f"ingest-{feed.name}")
    )
    if interval:
        writer = writer.trigger(processingTime=interval)
    elif not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run(query: StreamingQuery) -> None:
    """Blocks until the query ends; raises what made it fail."""
    query.awaitTermination()
