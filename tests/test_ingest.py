"""Decoding, projection, ids, sinks and the ingest streams."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from quotemill.__main__ import main
from quotemill.functions import parsing
from quotemill.functions.identity import message_id, random_id
from quotemill.operators import gate, reports
from quotemill.schemas import BAR, BAR_MESSAGE, KAFKA_ROW, TRADE, TRADE_MESSAGE
from quotemill.session import STORAGE_OPTIONS, storage_from_env
from quotemill.sources.feeds import BARS, TRADES, feed
from quotemill.sources.messages import encode
from quotemill.sources.topics import FileTopics, KafkaTopics
from quotemill.streaming import sinks
from quotemill.streaming.jobs import accepted_rows, ingest, run, table_rows

NOW = dt.datetime(2024, 11, 15, 9, 30)


def messages(spark, texts, topic="finnhub_stock", first=0):
    rows = [
        (None, None if t is None else bytearray(t, "utf8"), topic, 0, first + i, NOW, 0)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, KAFKA_ROW)


def good(i):
    return json.dumps({"c": ["1", "8"], "p": 1.5 + i, "s": f"S{i % 3}", "t": 1700000000123 + i, "v": i + 1})


MALFORMED = [
    ("not json", dict.fromkeys("cpstv")),
    ("", dict.fromkeys("cpstv")),
    (None, dict.fromkeys("cpstv")),
    ("null", dict.fromkeys("cpstv")),
    ('[{"s":"E"},{"s":"F"}]', dict.fromkeys("cpstv")),
    ('{"c":[],"p":"x","s":"B","t":1,"v":2}', {"c": [], "p": None, "s": "B", "t": 1, "v": 2.0}),
    ('{"c":null,"p":1,"s":"C","t":5,"v":0.5}', {"c": None, "p": 1.0, "s": "C", "t": 5, "v": 0.5}),
    ('{"P":9,"s":"D","v":3000000000}', {"c": None, "p": None, "s": "D", "t": None, "v": 3e9}),
    ('{"p":2,"p":3,"s":"dup"}', {"c": None, "p": 3.0, "s": "dup", "t": None, "v": None}),
    ('{"s":5,"v":true}', {"c": None, "p": None, "s": "5", "t": None, "v": None}),
    ('{"s":"Z","v":7} trailing', {"c": None, "p": None, "s": "Z", "t": None, "v": 7.0}),
]


def test_permissive_decode(spark):
    df = parsing.decode(messages(spark, [t for t, _ in MALFORMED]), TRADE_MESSAGE, keep=("offset",))
    got = [r.asDict() for r in sorted(df.collect(), key=lambda r: r["offset"])]
    for row, (text, expected) in zip(got, MALFORMED, strict=True):
        row.pop("offset")
        assert row == expected, text


def test_every_message_gives_a_row_with_an_id(spark):
    rows = table_rows(messages(spark, [t for t, _ in MALFORMED]), TRADES).collect()
    assert len(rows) == len(MALFORMED)
    assert len({r.id for r in rows}) == len(MALFORMED)


def test_trade_contract(spark):
    texts = [good(0), '{"s":"x","v":0.5,"t":9223372036854775807,"p":1}', '{"s":"y","v":3000000000}']
    df = table_rows(messages(spark, texts), TRADES)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TRADE]
    first, fraction, large = sorted(df.collect(), key=lambda r: r.symbol)
    assert first.datetime == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert (first.trade_conditions, first.last_price, first.volume) == (["1", "8"], 1.5, 1)
    assert (fraction.datetime, fraction.volume, large.volume) == (None, None, None)


def test_bar_contract(spark):
    text = json.dumps({
        "Datetime": "2024-11-15 09:30:00-05:00", "Open": 1.0, "High": 2.0, "Low": 0.5, "Close": 1.5,
        "Adj Close": 1.25, "Volume": 10, "Dividends": 0.0, "Stock Splits": 2.0, "ticker": "A"})
    df = table_rows(messages(spark, [text, '{"Datetime":"soon","ticker":"B"}'], BARS.topic), BARS)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BAR]
    bar, broken = sorted(df.collect(), key=lambda r: r.ticker)
    assert bar.datetime == dt.datetime(2024, 11, 15, 14, 30)
    assert (bar.adj_close, bar.stock_splits, bar.volume) == (1.25, 2.0, 10)
    assert broken.datetime is None


def test_epoch_text_is_cut_to_the_second(spark):
    df = spark.createDataFrame([(1700000000999,)], "ms bigint")
    row = df.select(parsing.epoch_ms_to_text(F.col("ms")).alias("t")).first()
    assert row.t == "2023-11-14 22:13:20"


def test_ids(spark):
    df = messages(spark, [good(i) for i in range(50)])
    ids = [r.id for r in df.select(message_id().alias("id")).collect()]
    assert len(set(ids)) == 50
    assert ids == [r.id for r in df.select(message_id().alias("id")).collect()]
    once = {r.id for r in df.select(random_id().alias("id")).collect()}
    assert once.isdisjoint({r.id for r in df.select(random_id().alias("id")).collect()})


def test_round_trip(spark):
    rows = spark.createDataFrame([
        (["a", "b"], 1.5, "X", 1, 2.0), ([], 1e308, "ü\"\\", -(2**62), 0.0),
        (None, None, None, None, None), (["", None], 5e-324, "", 2**62, -1.5),
    ], TRADE_MESSAGE).withColumn("n", F.monotonically_increasing_id())
    sent = encode(rows, TRADE_MESSAGE, "t", key=F.col("s"), partition=F.lit(0), offset=F.col("n"),
                  timestamp=F.lit(NOW))
    assert [f.dataType for f in sent.schema] == [f.dataType for f in KAFKA_ROW]
    back = parsing.decode(sent, TRADE_MESSAGE)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.drop("n").collect()))


def test_null_fields_are_left_out(spark):
    rows = spark.createDataFrame([(None, 1.0, None, None, None)], TRADE_MESSAGE)
    sent = encode(rows, TRADE_MESSAGE, "t", key=F.col("s"), partition=F.lit(0), offset=F.lit(0),
                  timestamp=F.lit(NOW))
    assert bytes(sent.first()["value"]) == b'{"p":1.0}'


def test_each_message_lands_on_one_side(spark):
    texts = [t for t, _ in MALFORMED] + [good(i) for i in range(5)] + ['{"s":"q","v":1,"t":4611686018427387904}']
    reasoned = gate.with_reason(messages(spark, texts), TRADES)
    reasons = {r["offset"]: r.reason for r in reasoned.collect()}
    assert len(reasons) == len(texts)
    kept = {r["offset"] for r in gate.accepted(reasoned).collect()}
    held = {r["offset"]: r.reason for r in gate.quarantined(reasoned).collect()}
    assert kept | set(held) == set(range(len(texts))) and not kept & set(held)
    assert held[0] == "decode_error" and held[3] == "error" and held[4] == "error"
    assert held[6] == "volume_lossy" and held[len(texts) - 1] == "time_unreadable"
    assert kept >= set(range(11, 16))


def test_gate(spark):
    df = messages(spark, ["x", '{"s":"","v":1}', good(1), good(0)])
    assert gate.first_valid(df, TRADES).first()["offset"] == 2
    assert gate.first_valid(messages(spark, ["x"]), TRADES).isEmpty()
    seen = []

    def read(since):
        seen.append(since)
        return messages(spark, ["x"] if len(seen) < 3 else ["x", good(0)])

    assert gate.wait_until_ready(read, TRADES, poll_interval=0.01, poll_timeout=60)
    # Later polls start where the last one ended, less the overlap.
    assert seen == [None, NOW - gate.OVERLAP, NOW - gate.OVERLAP]
    assert not gate.wait_until_ready(
        lambda since: messages(spark, ["x"]), TRADES, poll_interval=0.01, poll_timeout=0)


@pytest.fixture
def rows_read(spark):
    """Input rows of every micro-batch of the queries a test runs."""
    from pyspark.sql.streaming import StreamingQueryListener

    class Log(StreamingQueryListener):
        def __init__(self):
            self.rows, self.ended = {}, set()

        def onQueryStarted(self, event):
            self.rows[event.runId] = 0

        def onQueryProgress(self, event):
            # Events of queries that a test before this one ran may still come.
            if event.progress.runId in self.rows:
                self.rows[event.progress.runId] += event.progress.numInputRows

        def onQueryTerminated(self, event):
            self.ended.add(event.runId)

        def of(self, queries):
            """Rows per query, once its end was heard."""
            deadline = time.monotonic() + 20
            while len(self.ended & set(self.rows)) < queries and time.monotonic() < deadline:
                time.sleep(0.05)
            return list(self.rows.values())

    log = Log()
    spark.streams.addListener(log)
    yield log
    spark.streams.removeListener(log)


@pytest.mark.parametrize("late", [NOW - dt.timedelta(days=1), None])
def test_a_late_message_with_an_old_time_is_seen(spark, tmp_path, late, rows_read):
    """It arrives in the third poll, and no poll reads what an earlier one has read."""
    path, polls = str(tmp_path / "topic"), []
    messages(spark, ["x", "y", "z"]).write.parquet(path)

    def polled():
        polls.append(len(polls))
        if len(polls) == 3:
            messages(spark, [good(0)], first=3).withColumn(
                "timestamp", F.lit(late).cast("timestamp")).write.mode("append").parquet(path)
        return FileTopics(path).read_stream(spark, TRADES.topic)

    assert gate.wait_on_stream(polled, TRADES, str(tmp_path / "cp"), poll_interval=0.01, poll_timeout=60)
    assert rows_read.of(3) == [3, 0, 1]


def test_gate_on_a_stream_times_out_and_takes_the_first_batch(spark, tmp_path, rows_read):
    topic = str(tmp_path / "topic")
    messages(spark, ["x"] * 5).coalesce(1).write.parquet(topic)

    def read():
        return FileTopics(topic, max_files_per_trigger=1).read_stream(spark, TRADES.topic)

    assert not gate.wait_on_stream(read, TRADES, str(tmp_path / "cp"), poll_interval=0.01, poll_timeout=0)
    assert not gate.wait_on_stream(
        lambda: FileTopics(topic).read_stream(spark, "other"), TRADES, str(tmp_path / "cp2"), poll_timeout=0)
    messages(spark, [good(0)], first=5).coalesce(1).write.mode("append").parquet(topic)
    assert gate.wait_on_stream(read, TRADES, str(tmp_path / "cp"), poll_interval=0.01, poll_timeout=0)


def test_a_split_batch_is_read_once(spark, tmp_path, rows_read):
    topic = str(tmp_path / "topic")
    write_files(spark, topic, files=3)
    source = FileTopics(topic, max_files_per_trigger=1)
    stored, held, counts = (sinks.BatchDirectory(str(tmp_path / name)) for name in ("out", "held", "quality"))
    run(ingest(source.read_stream(spark, TRADES.topic), TRADES, stored, str(tmp_path / "cp"), quarantine=held,
               quality=counts))
    assert rows_read.of(1) == [30]
    assert stored.read(spark, TRADE).count() + spark.read.parquet(held.path).count() == 30


@pytest.mark.parametrize("split", [False, True])
def test_quality_of_every_batch_comes_with_its_write(spark, tmp_path, split, rows_read):
    topic = str(tmp_path / "topic")
    write_files(spark, topic, files=4)
    messages(spark, ['{"p":-1,"s":"","v":0}', "broken", good(3)], first=99).coalesce(1).write.mode("append").parquet(topic)
    source = FileTopics(topic, max_files_per_trigger=1)
    stored, counts = (sinks.BatchDirectory(str(tmp_path / name)) for name in ("out", "quality"))
    held = sinks.BatchDirectory(str(tmp_path / "held")) if split else None
    run(ingest(source.read_stream(spark, TRADES.topic), TRADES, stored, str(tmp_path / "cp"), quarantine=held,
               quality=counts))
    assert rows_read.of(1) == [43]
    found = {r.batch_id: r for r in spark.read.parquet(counts.path).drop("query_id").collect()}
    rows = stored.read(spark, TRADE)
    assert set(found) == set(range(5))
    for number, row in found.items():
        expected = reports.trade_quality(rows.where(F.col("batch_id") == number)).first().asDict()
        assert {k: v for k, v in row.asDict().items() if k != "batch_id"} == expected
    assert sum(row["no_symbol"] for row in found.values()) == (0 if split else 8)


def test_quality_of_bars(spark, tmp_path):
    texts = ['{"Datetime":"2024-01-02 09:30:00+00:00","Open":1,"High":2,"Low":0.5,"Close":1.5,"Volume":10,"ticker":"A"}',
             '{"Datetime":"2024-01-02 09:31:00+00:00","Open":3,"High":2,"Low":0.5,"Close":1.5,"Volume":0,"ticker":"A"}',
             '{"Datetime":"2024-01-02 09:32:00+00:00","Open":1,"High":0.2,"Low":0.5,"Close":1.5,"Volume":1,"ticker":"A"}',
             '{"Open":1}']
    messages(spark, texts, topic=BARS.topic).write.parquet(str(tmp_path / "topic"))
    counts = sinks.BatchDirectory(str(tmp_path / "quality"))
    run(ingest(FileTopics(str(tmp_path / "topic")).read_stream(spark), BARS, sinks.BatchDirectory(str(tmp_path / "out")),
               str(tmp_path / "cp"), quality=counts))
    (row,) = spark.read.parquet(counts.path).collect()
    assert (row["rows"], row.no_key, row.high_below_low, row.outside_range, row.no_positive_volume) == (4, 1, 2, 3, 2)


def test_feeds():
    assert feed("trades").full_table == "finance.stock_trade"
    assert feed("bars").full_table == "finance.stock_data"
    with pytest.raises(ValueError):
        feed("news")


def test_kafka_options():
    source = KafkaTopics(group_id="t5", min_partitions=64, max_offsets_per_trigger=10)
    options = source.options(["a", "b"], streaming=True)
    assert options == {
        "kafka.bootstrap.servers": "kafka:9092", "kafka.security.protocol": "PLAINTEXT",
        "subscribe": "a,b", "startingOffsets": "earliest", "kafka.group.id": "t5",
        "minPartitions": "64", "maxOffsetsPerTrigger": "10"}
    assert "maxOffsetsPerTrigger" not in source.options(["a"], streaming=False)


def test_kafka_writer_options():
    source = KafkaTopics("k:1", group_id="g", security_protocol="SSL", starting_offsets="latest", extra={"kafka.acks": "all"})
    options = {"kafka.bootstrap.servers": "k:1", "kafka.security.protocol": "SSL", "kafka.acks": "all"}
    assert source.sending() == options
    assert source.sending("finnhub_stock") == {**options, "topic": "finnhub_stock"}


def test_messages_written_to_a_topic_are_read_back(spark, tmp_path):
    topic = FileTopics(str(tmp_path / "topic"))
    first = messages(spark, [good(0), "broken", None])
    topic.write(first.drop("timestampType"), TRADES.topic)
    topic.write(messages(spark, [good(1)], topic="other", first=3))
    whole = topic.read_batch(spark)
    assert whole.schema == KAFKA_ROW and whole.count() == 4
    assert topic.read_batch(spark, TRADES.topic).select("offset", "value").exceptAll(first.select("offset", "value")).isEmpty()
    # A stream sends each message once, over a restart on its checkpoint too.
    target = FileTopics(str(tmp_path / "copy"))
    for _ in range(2):
        run(target.write_stream(topic.read_stream(spark, TRADES.topic), str(tmp_path / "cp"), "copied"))
    copied = target.read_batch(spark, "copied")
    assert sorted(r["offset"] for r in copied.collect()) == [0, 1, 2]
    assert rows_in(table_rows(copied, TRADES).drop("id")) == rows_in(table_rows(first, TRADES).drop("id"))


def test_storage_settings():
    found = storage_from_env({"MINIO_ENDPOINT": "http://x", "AWS_ACCESS_KEY_ID": "", "OTHER": "1"})
    assert found == {"endpoint_url": "http://x"}
    assert STORAGE_OPTIONS["endpoint_url"] == "spark.hadoop.fs.s3a.endpoint"


def write_files(spark, path, per_file=10, files=5):
    for n in range(files):
        texts = [good(i) if i % 7 else "broken" for i in range(n * per_file, (n + 1) * per_file)]
        messages(spark, texts, first=n * per_file).coalesce(1).write.mode("append").parquet(path)


def rows_in(df, *drop):
    return sorted(map(repr, df.drop("query_id", "batch_id", "day", *drop).collect()))


def test_stream_equals_batch(spark, tmp_path):
    topic = str(tmp_path / "topic")
    write_files(spark, topic)
    source = FileTopics(topic, max_files_per_trigger=1)
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    query = ingest(source.read_stream(spark, TRADES.topic), TRADES, sink, str(tmp_path / "cp"))
    run(query)
    stored = sink.read(spark, TRADE)
    assert stored.select("batch_id").distinct().count() == 5
    assert rows_in(stored) == rows_in(table_rows(source.read_batch(spark, TRADES.topic), TRADES))


@pytest.mark.parametrize("split", [False, True])
def test_replay_after_failure(spark, tmp_path, split):
    topic = str(tmp_path / "topic")
    write_files(spark, topic)
    source = FileTopics(topic, max_files_per_trigger=2)
    held = sinks.BatchDirectory(str(tmp_path / "held")) if split else None

    class Breaks(sinks.BatchDirectory):
        def write(self, batch, batch_id):
            super().write(batch, batch_id)
            raise RuntimeError("lost after the write")

    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def start(sink):
        return ingest(source.read_stream(spark, TRADES.topic), TRADES, sink, cp, quarantine=held)

    with pytest.raises(Exception, match="lost after the write"):
        run(start(Breaks(out)))
    sink = sinks.BatchDirectory(out)
    run(start(sink))
    everything = source.read_batch(spark, TRADES.topic)
    if split:
        expected = accepted_rows(gate.with_reason(everything, TRADES), TRADES)
    else:
        expected = table_rows(everything, TRADES)
    assert rows_in(sink.read(spark, TRADE)) == rows_in(expected)
    if split:
        assert spark.read.parquet(held.path).count() == gate.quarantined(
            gate.with_reason(everything, TRADES)).count()


def test_catalog_table(spark, tmp_path):
    sinks.create_database(spark, "ingest_test", str(tmp_path / "db"))
    sinks.create_database(spark, "ingest_test")
    table = sinks.create_table(spark, TRADES, "ingest_test")
    sink = sinks.CatalogTable(table)
    first = table_rows(messages(spark, [good(0), good(1)]), TRADES)
    second = table_rows(messages(spark, [good(2)], first=2), TRADES)
    sink.write(first, 0)
    sink.write(second, 1)
    sink.write(first, 0)
    assert sinks.create_table(spark, TRADES, "ingest_test") == table
    assert rows_in(spark.table(table)) == rows_in(first.union(second))
    bars = sinks.create_table(spark, BARS, "ingest_test")
    assert spark.table(bars).columns == [*BAR.names, "query_id", "batch_id", "day"]
    days = {r.day for r in spark.table(table).collect()}
    assert days == {dt.date(2023, 11, 14)}
    # A report on one day reads that day's files.
    plan = spark.table(table).where("day = DATE'2023-11-14'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_new_checkpoint_adds_rows(spark, tmp_path):
    """Another job, or a lost checkpoint, starts at batch 0 again and must not replace rows."""
    sinks.create_database(spark, "two_runs", str(tmp_path / "db"))
    table = sinks.CatalogTable(sinks.create_table(spark, TRADES, "two_runs"))
    folder = sinks.BatchDirectory(str(tmp_path / "out"))
    for run_number, first in enumerate((0, 10, 10)):
        topic = str(tmp_path / f"topic{first}")
        if run_number < 2:
            messages(spark, [good(i) for i in range(5)], first=first).write.parquet(topic)
        for name, sink in (("folder", folder), ("table", table)):
            # The third run repeats the second on its checkpoint and finds nothing new.
            stream = FileTopics(topic).read_stream(spark, TRADES.topic)
            run(ingest(stream, TRADES, sink, str(tmp_path / f"{name}-{first}")))
    assert folder.read(spark, TRADE).count() == 10
    assert spark.table(table.table).count() == 10
    assert folder.read(spark, TRADE).select("query_id").distinct().count() == 2


def test_keyed_store_provisioning():
    database, table = sinks.keyed_statements(BARS, "finance")
    assert database == (
        "CREATE DATABASE IF NOT EXISTS cassandra.finance "
        "WITH DBPROPERTIES (class='SimpleStrategy', replication_factor='1')")
    assert table.startswith("CREATE TABLE IF NOT EXISTS cassandra.finance.stock_data (`id` string, `datetime` timestamp,")
    assert table.endswith("`ticker` string) USING cassandra PARTITIONED BY (id)")


def test_files_are_read_from_a_time_on(spark, tmp_path):
    messages(spark, [good(0)]).write.parquet(str(tmp_path / "topic"))
    source = FileTopics(str(tmp_path / "topic"))
    assert source.read_batch(spark, TRADES.topic, since=NOW).count() == 1
    assert source.read_batch(spark, TRADES.topic, since=NOW + dt.timedelta(seconds=1)).count() == 0


def test_job_settings_reach_the_source():
    from quotemill.__main__ import arguments, source_of
    common = ["trades", "--checkpoint", "c", "--table"]
    source = source_of(arguments([
        *common, "--servers", "k:1", "--group-id", "g", "--protocol", "SSL", "--min-partitions", "9",
        "--max-offsets", "500"]))
    assert source.options(["t"], streaming=True) == {
        "kafka.bootstrap.servers": "k:1", "kafka.security.protocol": "SSL", "subscribe": "t",
        "startingOffsets": "earliest", "kafka.group.id": "g", "minPartitions": "9", "maxOffsetsPerTrigger": "500"}
    assert source_of(arguments([*common, "--files", "f", "--max-files", "3"])) == FileTopics("f", max_files_per_trigger=3)


def test_keyed_store_options():
    store = sinks.cassandra(TRADES, "finance")
    assert (store.format, store.mode) == ("org.apache.spark.sql.cassandra", "append")
    assert store.options == {"table": "stock_trade", "keyspace": "finance"}


def test_explain_prints_plans(spark, tmp_path, capfd):
    topic = str(tmp_path / "topic")
    write_files(spark, topic, files=1)
    sink = sinks.BatchDirectory(str(tmp_path / "out"))
    run(ingest(FileTopics(topic).read_stream(spark), TRADES, sink, str(tmp_path / "cp"),
               random_ids=True, explain=True))
    assert "== Physical Plan ==" in capfd.readouterr().out
    assert sink.read(spark, TRADE).count() == 10


def test_bar_schema_reads_spaced_names(spark):
    df = parsing.decode(messages(spark, ['{"Adj Close":1.0,"Stock Splits":2.0}']), BAR_MESSAGE)
    row = df.select(F.col("Adj Close").alias("a"), F.col("Stock Splits").alias("s")).first()
    assert (row.a, row.s) == (1.0, 2.0)


def test_job(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    write_files(spark, topic)
    common = ["trades", "--files", topic, "--checkpoint", str(tmp_path / "cp")]
    held = str(tmp_path / "held")
    assert main([*common, "--directory", out, "--quarantine", held], spark) == 0
    assert sinks.BatchDirectory(out).read(spark, TRADE).count() == 42
    assert spark.read.parquet(held).count() == 8
    other = ["--checkpoint", str(tmp_path / "cp2"), "--database", "job_test", "--table"]
    assert main(["trades", "--files", topic, *other], spark) == 0
    assert spark.table("job_test.stock_trade").count() == 50
    empty = ["bars", "--files", topic, "--checkpoint", str(tmp_path / "cp3"), "--directory", out]
    assert main([*empty, "--poll-timeout", "0"], spark) == 1
