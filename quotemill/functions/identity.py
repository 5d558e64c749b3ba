"""Row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def message_id(topic: Column | str = "topic", partition: Column | str = "partition",
               offset: Column | str = "offset") -> Column:
    """Id of a message position, equal on every replay.

    The md5 of topic, partition and offset in the 8-4-4-4-12 layout of a UUID.
    """
    digest = F.md5(F.concat_ws("|", topic, partition, offset))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def random_id() -> Column:
    """A random UUID per row. A replayed batch gets new ids."""
    return F.expr("uuid()")
