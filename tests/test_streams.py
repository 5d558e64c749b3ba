"""Event-time streams against the same operators on the whole table."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_ingest import messages

from quotemill.operators import bars, joins, records
from quotemill.plans import inputs
from quotemill.schemas import TRADE
from quotemill.session import build_session
from quotemill.sources.feeds import TRADES
from quotemill.sources.topics import FileTopics
from quotemill.streaming import sinks, windows
from quotemill.streaming.jobs import ingest, run, table_rows

PARTS = 5


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    """Trade messages of the test table in five parts by time."""
    sent = inputs.trade_messages(inputs.events(spark, sf_dir)).cache()
    size = sent.count() // PARTS
    return [sent.where(F.floor(F.col("offset") / size) == n) for n in range(PARTS)]


def deliver(spark, path, parts):
    """Files in the given order, one per micro-batch."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    source = FileTopics(path, max_files_per_trigger=1)
    stream = table_rows(source.read_stream(spark, TRADES.topic), TRADES)
    return stream, table_rows(source.read_batch(spark, TRADES.topic), TRADES)


def bars_of(spark, tmp_path, parts, lateness=None):
    stream, whole = deliver(spark, str(tmp_path / "topic"), parts)
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    rows = windows.bars(stream, "1 hour", lateness)
    run(windows.start(rows, sink, str(tmp_path / "cp")))
    versions = sink.read(spark, rows.schema)
    found = windows.current(versions, ["symbol", "datetime"])
    expected = bars.ohlcv(whole, "1 hour")
    return set(found.select(*sorted(found.columns)).collect()), set(
        expected.select(*sorted(expected.columns)).collect())


def test_bars_in_order(spark, tmp_path, parts):
    found, expected = bars_of(spark, tmp_path, parts)
    assert found == expected


def test_bars_out_of_order(spark, tmp_path, parts):
    found, expected = bars_of(spark, tmp_path, [parts[n] for n in (3, 0, 4, 1, 2)])
    assert found == expected


def test_a_bound_drops_late_trades(spark, tmp_path, parts):
    found, expected = bars_of(spark, tmp_path, [parts[n] for n in (3, 0, 4, 1, 2)], "10 minutes")
    assert sum(r.trades for r in found) < sum(r.trades for r in expected)


def test_a_bound_keeps_trades_in_order(spark, tmp_path, parts):
    found, expected = bars_of(spark, tmp_path, parts, "10 minutes")
    assert found == expected


def test_repeated_file(spark, tmp_path, parts):
    """A file delivered twice doubles its rows; ids tell the copies apart."""
    path = str(tmp_path / "topic")
    deliver(spark, path, [*parts, parts[2]])
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    source = FileTopics(path, max_files_per_trigger=1)
    run(ingest(source.read_stream(spark), TRADES, sink, str(tmp_path / "cp")))
    stored = sink.read(spark, TRADE).drop("query_id", "batch_id")
    clean = records.unique(stored)
    assert stored.count() == clean.count() + parts[2].count()
    assert clean.count() == stored.select("id").distinct().count()


def test_stream_drops_repeats(spark, tmp_path, parts):
    stream, whole = deliver(spark, str(tmp_path / "topic"), [*parts, parts[4]])
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    rows = records.unique(stream, "60 days")
    run(windows.start(rows, sink, str(tmp_path / "cp"), mode="append"))
    found = sink.read(spark, rows.schema)
    assert found.count() == found.select("id").distinct().count() == whole.select("id").distinct().count()


@pytest.mark.parametrize("remember", [None, "1 hour"])
def test_first_copies_are_never_dropped(spark, tmp_path, parts, remember):
    """Files out of order, far beyond the time ids are remembered: no first copy is lost."""
    stream, whole = deliver(spark, str(tmp_path / "topic"), [parts[n] for n in (3, 0, 4, 1, 2, 0)])
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    rows = records.unique(stream, remember)
    run(windows.start(rows, sink, str(tmp_path / "cp"), mode="append"))
    found = sink.read(spark, rows.schema)
    assert found.count() == whole.select("id").distinct().count()


def sessions_in_parts(spark, tmp_path, parts, lateness):
    stream, whole = deliver(spark, str(tmp_path / "topic"), parts)
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    rows = windows.sessions(stream, "3 hours", lateness)
    run(windows.start(rows, sink, str(tmp_path / "cp"), mode="append"))
    found = sink.read(spark, rows.schema)
    last = whole.agg(F.max("datetime")).first()[0]
    expected = [r for r in bars.sessions(whole, 10_800).collect() if r.session_end <= last - dt.timedelta(hours=1)]
    return (
        Counter((r.symbol, r.session_start, r.session_end, r.trades, r.volume) for r in found.collect()),
        Counter((r.symbol, r.session_start, r.session_end, r.trades, r.volume) for r in expected))


def test_sessions_are_written_once_when_they_end(spark, tmp_path, parts):
    found, expected = sessions_in_parts(spark, tmp_path, parts, "1 hour")
    assert found == expected and len(found) > 10


def test_stream_joins_bars_of_any_start(spark, tmp_path, parts):
    stream, whole = deliver(spark, str(tmp_path / "topic"), parts)
    early = whole.withColumn("datetime", F.col("datetime") - F.expr("INTERVAL 30 MINUTES"))
    shifted = bars.ohlcv(early, "1 hour").withColumn("datetime", F.col("datetime") + F.expr("INTERVAL 30 MINUTES"))
    shifted.coalesce(1).write.parquet(str(tmp_path / "bars"))
    bar_stream = spark.readStream.schema(shifted.schema).parquet(str(tmp_path / "bars"))
    rows = windows.to_bar(stream, bar_stream, "1 hour", "60 days")
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    run(windows.start(rows, sink, str(tmp_path / "cp"), mode="append"))
    found = sink.read(spark, rows.schema).select("id", "bar_start", "bar_open").collect()
    expected = joins.to_bar(whole, shifted, "1 hour").select("id", "bar_start", "bar_open").collect()
    assert Counter(found) == Counter(expected) and len(found) == whole.count()


def test_session_edges(spark):
    """A trade exactly one gap later joins the session, one second more does not."""
    seconds = [0, 600, 1200, 1801, 5000]
    rows = spark.createDataFrame(
        [(str(n), "A", s, 1) for n, s in enumerate(seconds)], "id string, symbol string, s bigint, volume int"
    ).withColumn("datetime", F.timestamp_seconds("s"))
    found = bars.sessions(rows, 600).orderBy("session_start").collect()
    assert [r.trades for r in found] == [3, 1, 1]


def test_session_defaults(spark, tmp_path):
    """The engine's session options work, the state store among them."""
    session = build_session("ignored", {"endpoint_url": "http://store", "spark.sql.shuffle.partitions": "2"})
    try:
        assert session.conf.get("spark.hadoop.fs.s3a.endpoint") == "http://store"
        texts = ['{"c":["1"],"p":1.0,"s":"A","t":1700000000000,"v":1}'] * 3
        messages(session, texts).coalesce(1).write.parquet(str(tmp_path / "topic"))
        stream = table_rows(FileTopics(str(tmp_path / "topic")).read_stream(session), TRADES)
        sink = sinks.BatchDirectory(str(tmp_path / "out"))
        rows = windows.sessions(stream, "1 minute")
        run(windows.start(rows, sink, str(tmp_path / "cp"), mode="complete"))
        assert [r.trades for r in windows.newest(sink.read(session, rows.schema)).collect()] == [3]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.unset("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
