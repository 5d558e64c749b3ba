"""The feeds the engine knows: topic, contract, projection and target table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from quotemill import schemas
from quotemill.functions.parsing import epoch_ms_to_time, text_to_time
from quotemill.operators import project

DATABASE = "finance"


@dataclass(frozen=True)
class Feed:
    name: str
    topic: str
    message: T.StructType
    row: T.StructType
    table: str
    symbol_key: str
    volume_key: str
    projection: Callable[[DataFrame, Column], DataFrame]
    time_key: str
    moment: Callable[[Column], Column]

    @property
    def full_table(self) -> str:
        return f"{DATABASE}.{self.table}"


# Topic and table names are fixed values shared with producers and readers.
TRADES = Feed(
    name="trades",
    topic="finnhub_stock",
    message=schemas.TRADE_MESSAGE,
    row=schemas.TRADE,
    table="stock_trade",
    symbol_key="s",
    volume_key="v",
    projection=project.trades,
    time_key="t",
    moment=epoch_ms_to_time,
)

BARS = Feed(
    name="bars",
    topic="yfinance_stock",
    message=schemas.BAR_MESSAGE,
    row=schemas.BAR,
    table="stock_data",
    symbol_key="ticker",
    volume_key="Volume",
    projection=project.bars,
    time_key="Datetime",
    moment=text_to_time,
)

FEEDS = {feed.name: feed for feed in (TRADES, BARS)}


def feed(name: str) -> Feed:
    try:
        return FEEDS[name]
    except KeyError:
        raise ValueError(f"unknown feed {name!r}, expected one of {sorted(FEEDS)}") from None
