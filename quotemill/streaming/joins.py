"""Joins of running streams: trades with their last bar, own bars against a provider's.

Both write a row once, when the watermark says that nothing can change it any
more, so they run in append mode and a batch run over the whole input gives the
same rows. Rows later than the bound are dropped, as Spark's watermarks do.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from quotemill.operators.bars import bar_values
from quotemill.session import DEFAULTS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """State of our own needs the state store of the engine's sessions; others get it for a while."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, DEFAULTS[PROVIDER])
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def _numbers(schema: T.StructType) -> list[Column]:
    """The columns with times as microseconds, which pass through Python as they are."""
    return [F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in schema]


def _times(schema: T.StructType) -> list[Column]:
    return [F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in schema]


def _plain(schema: T.StructType) -> T.StructType:
    """The schema of ``_numbers``."""
    return T.StructType([
        T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema])


def last_bar(slot: int, values: int) -> StatefulProcessor:
    """State of one key: the trades and bars of time slots that are still open, and the bar before them.

    A slot is settled when the watermark passes its end: its trades are written
    with the last bar at or before their time, and its last bar is all that is
    kept of it. So the state holds what lies within the bound, and one bar.
    The class is made here so that executors get it with the query.
    """

    def plain(value):
        """Rows as tuples, which is what state takes."""
        if isinstance(value, tuple):
            return tuple(map(plain, value))
        return list(map(plain, value)) if isinstance(value, list) else value

    class LastBar(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.trades = handle.getMapState("trades", self.key, self.trade_rows)
            self.bars = handle.getMapState("bars", self.key, self.bar_rows)
            self.carried = handle.getValueState("carried", self.bar)

        def __init__(self, trade: T.StructType, bar: T.StructType):
            self.key = T.StructType([T.StructField("slot", T.LongType())])
            self.bar = bar
            self.made = Row(*trade.names, *bar.names)
            self.trade_rows = T.StructType([T.StructField("rows", T.ArrayType(T.StructType(
                [T.StructField("at", T.LongType()), T.StructField("trade", trade)])))])
            self.bar_rows = T.StructType([T.StructField("rows", T.ArrayType(bar))])

        def handleInputRows(self, key, rows, timerValues):
            fresh: tuple[dict, dict] = ({}, {})
            for row in rows:
                held = fresh[row["_bar"] is None]
                held.setdefault(row["_at"] // slot, []).append(
                    plain(row["_bar"]) if row["_bar"] is not None else (row["_at"], plain(row["_trade"])))
            for state, held in ((self.bars, fresh[0]), (self.trades, fresh[1])):
                for number, found in held.items():
                    known = plain(state.getValue((number,))[0]) if state.containsKey((number,)) else []
                    state.updateValue((number,), (known + found,))
                    # The first millisecond after the slot.
                    self.handle.registerTimer(-(-(number + 1) * slot // 1000))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            # Timers come in the order of their times, so slots are settled one after another.
            number = expiredTimerInfo.getExpiryTimeInMs() * 1000 // slot - 1
            last = plain(self.carried.get()) if self.carried.exists() else None
            if last is not None and last[0] >= (number + 1) * slot:
                raise RuntimeError("a later slot was settled before this one")
            bars = sorted(self._taken(self.bars, number), key=lambda bar: bar[0])
            place = 0
            for at, trade in sorted(self._taken(self.trades, number), key=lambda pair: pair[0]):
                while place < len(bars) and bars[place][0] <= at:
                    last, place = bars[place], place + 1
                yield self.made(*trade, *(last or (None,) * (values + 1)))
            last = bars[-1] if bars else last
            if last is not None:
                self.carried.update(last)

        def _taken(self, state, number):
            if not state.containsKey((number,)):
                return []
            rows = plain(state.getValue((number,))[0])
            state.removeKey((number,))
            return rows

        def close(self) -> None:
            pass

    return LastBar


def as_of(
    trades: DataFrame, bars: DataFrame, lateness: str, *, values: Sequence[str] = ("close",), slot: str = "1 minute",
    salts: int = 16,
) -> DataFrame:
    """Each trade of one stream with the last bar of another at or before its time.

    A trade is written when the watermark passes the end of its time slot; longer
    slots cost less state traffic and delay more. The slower stream sets the watermark. A stream cannot count keys ahead, so every
    symbol is spread over ``salts`` keys: trades by their id, bars as one copy
    each. A symbol holds one bar a time. A trade without a time is written at
    once, without a bar; a bar without one is left out.
    """
    width = _micros(trades.sparkSession, slot)
    bar = bars.select(F.col("datetime").alias("bar_datetime"), *[F.col(v).alias(f"bar_{v}") for v in values]).schema
    boxed = F.struct(F.unix_micros("datetime").alias("bar_datetime"), *[F.col(v).alias(f"bar_{v}") for v in values])
    row = F.struct(*_numbers(trades.schema))
    place = [F.col("datetime").alias("_time"), F.unix_micros("datetime").alias("_at")]
    left = trades.where("datetime is not null").withWatermark("datetime", lateness).select(
        "symbol", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("_salt"), *place,
        row.alias("_trade"), F.lit(None).cast(_plain(bar)).alias("_bar"))
    right = bars.where("datetime is not null").withWatermark("datetime", lateness).select(
        "symbol", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), *place,
        F.lit(None).cast(_plain(trades.schema)).alias("_trade"), boxed.alias("_bar"))
    whole = T.StructType([*trades.schema.fields, *bar.fields])
    processor = last_bar(width, len(values))(_plain(trades.schema), _plain(bar))
    found = left.union(right).groupBy("symbol", "_salt").transformWithState(
        processor, _plain(whole), "Append", "EventTime").select(*_times(whole))
    timeless = trades.where("datetime is null").select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in bar])
    return found.union(timeless)


def _micros(spark: SparkSession, width: str) -> int:
    return spark.range(1).select(
        F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {width})").alias("n")).first()["n"]


def reconcile(
    trades: DataFrame, provided: DataFrame, width: str, lateness: str, *,
    values: Sequence[str] = ("open", "high", "low", "close", "volume"),
) -> DataFrame:
    """Bars of a trade stream beside a provider's, with differences and the missing side.

    A pair is written when both sides are there, a bar without a partner when
    the watermark has passed its end. Bars pair if they start at one time, so a
    provided bar off the grid of the width stands alone. Rows without a time
    cannot be held, and are left out.
    """
    ours = trades.where("datetime is not null").withWatermark("datetime", lateness).groupBy(
        "symbol", F.window("datetime", width).alias("bar")).agg(*bar_values()).alias("o")
    # A stream has one event time, so the start beside the window is a plain copy.
    theirs = provided.where("datetime is not null").withColumn("start", F.col("datetime")).withWatermark(
        "datetime", lateness).select("symbol", F.window("datetime", width).alias("bar"), "start", *values).alias("t")
    # The window is the key that carries the watermark, so that state can go.
    same = (
        (F.col("o.bar") == F.col("t.bar")) & F.col("o.symbol").eqNullSafe(F.col("t.symbol"))
        & (F.col("o.bar.start") == F.col("t.start")))
    return ours.join(theirs, same, "full_outer").select(
        F.coalesce("o.symbol", "t.symbol").alias("symbol"),
        F.coalesce("o.bar.start", "t.start").alias("datetime"),
        F.when(F.col("t.start").isNull(), "theirs").when(F.col("o.bar").isNull(), "ours").alias("missing"),
        *[(F.col(f"o.{v}") - F.col(f"t.{v}")).alias(f"{v}_diff") for v in values],
    )
