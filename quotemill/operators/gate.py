"""Valid and quarantined messages, and the readiness gate."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions import readiness
from quotemill.functions.once import with_computed
from quotemill.functions.parsing import fits_int, parse_message, payload_text
from quotemill.functions.readiness import VALID
from quotemill.sources.feeds import Feed

# How far the clocks of producers may be apart.
OVERLAP = timedelta(minutes=1)
LOSSY_VOLUME = "volume_lossy"
BAD_TIME = "time_unreadable"


def with_outcome(messages: DataFrame, feed: Feed) -> DataFrame:
    return readiness.with_outcome(messages, payload_text(), feed.symbol_key, feed.volume_key)


def valid_messages(messages: DataFrame, feed: Feed) -> DataFrame:
    """Messages the readiness rule accepts."""
    return with_outcome(messages, feed).where(F.col("outcome") == VALID).drop("outcome")


def with_reason(messages: DataFrame, feed: Feed) -> DataFrame:
    """Adds the parsed ``data`` and a ``reason`` to hold the message back, or null.

    The readiness outcome comes first. A valid message is still held back when
    its volume is not a whole number an int holds, or its time is unreadable.
    """
    whole = F.coalesce(fits_int(F.col(f"data.{feed.volume_key}")), F.lit(False))
    reason = (
        F.when(F.col("outcome") != VALID, F.col("outcome"))
        .when(~whole, LOSSY_VOLUME)
        .when(feed.moment(F.col(f"data.{feed.time_key}")).isNull(), BAD_TIME)
    )
    parsed = with_outcome(messages, feed).withColumn("data", parse_message(payload_text(), feed.message))
    return with_computed(parsed, "reason", reason).drop("outcome")


def accepted(reasoned: DataFrame) -> DataFrame:
    """Parsed messages that can be stored without loss."""
    return reasoned.where(F.col("reason").isNull()).drop("reason")


def quarantined(reasoned: DataFrame) -> DataFrame:
    """Raw messages that are held back, with the reason."""
    return reasoned.where(F.col("reason").isNotNull()).drop("data")


def first_valid(messages: DataFrame, feed: Feed) -> DataFrame:
    """The valid message with the lowest position, or no row."""
    return valid_messages(messages, feed).orderBy("topic", "partition", "offset").limit(1)


def wait_until_ready(
    read: Callable[[datetime | None], DataFrame], feed: Feed, *,
    poll_interval: float = 5, poll_timeout: float = 360,
) -> bool:
    """Polls until there is a valid message; false at the timeout.

    ``read`` takes the time from which messages are wanted and may give more. A
    poll asks from where the last one ended, less ``OVERLAP``; a reader that
    follows that parses a long head of invalid messages once, but misses a
    message that arrives later with an older time or none. The job's does not.
    """
    deadline = time.monotonic() + poll_timeout
    since = None
    while True:
        messages = read(since)
        # Taken before the check, so what arrives meanwhile is read again.
        newest = messages.agg(F.max("timestamp")).first()[0]
        if not valid_messages(messages, feed).isEmpty():
            return True
        if newest is not None:
            since = newest - OVERLAP
        if time.monotonic() + poll_interval > deadline:
            return False
        time.sleep(poll_interval)


def wait_on_stream(
    read: Callable[[], DataFrame], feed: Feed, checkpoint_location: str, *,
    poll_interval: float = 5, poll_timeout: float = 360,
) -> bool:
    """Polls a topic until there is a valid message; false at the timeout.

    ``read`` gives the topic as a stream. A poll is a run of it over the
    messages there are; the checkpoint carries the offsets (of files, the list
    of those seen) from poll to poll, so every message is parsed once, whenever
    it arrives and whatever time it bears. A new checkpoint looks at the whole
    topic. Messages after the first valid batch are left unread.
    """
    found = []

    def look(batch: DataFrame, batch_id: int) -> None:
        if not found and not valid_messages(batch, feed).isEmpty():
            found.append(batch_id)

    deadline = time.monotonic() + poll_timeout
    while True:
        query = (
            read().writeStream.foreachBatch(look).option("checkpointLocation", checkpoint_location)
            .queryName(f"ready-{feed.name}").trigger(availableNow=True).start())
        query.awaitTermination()
        if found:
            return True
        if time.monotonic() + poll_interval > deadline:
            return False
        time.sleep(poll_interval)
