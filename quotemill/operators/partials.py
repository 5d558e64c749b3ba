"""Stored partial aggregates of a table that grows batch by batch.

A report over months need not read months of rows. Each refresh reads only the
micro-batches written since the last one, reduces them to one row per key (a
symbol's day, say) and adds these rows to the store; a report merges them. Sums
merge by adding, sketches by their own merge, so a range of days, or a key
without its day, is answered from the partials alone.

What has been read is kept as one high-water mark per writing query: a query's
batches come in order. The marks of a run are written after its rows and make
them count, so a refresh that fails leaves nothing behind that a reader sees,
and the next one reads the same batches again. One refresh runs at a time.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.operators.bars import known

BATCH = re.compile(r"/query_id=([^/]+)/batch_id=(\d+)/")
MARKS = "run bigint, base boolean, query_id string, batch_id bigint"
# Entries of a set sketch, as a power of two: below it, counts are exact.
SET_ENTRIES = 14
# Size of a quantile sketch: the rank of an answer is off by about 1.65 / k, here 0.4 %.
QUANTILE_K = 400


@dataclass(frozen=True)
class Measure:
    """A value per key: how rows make it, and how two of it make one."""

    name: str
    partial: Column
    merged: Column


def count(name: str) -> Measure:
    return Measure(name, F.count(F.lit(1)), F.sum(name))


def total(name: str, amount: Column) -> Measure:
    return Measure(name, F.sum(amount), F.sum(name))


def distinct(name: str, value: Column, entries: int = SET_ENTRIES) -> Measure:
    """Theta sketch of a set; nulls are not members."""
    return Measure(name, F.theta_sketch_agg(value, entries), F.theta_union_agg(name, entries))


def quantiles(name: str, value: Column, k: int = QUANTILE_K) -> Measure:
    """KLL sketch of a distribution; null and not-a-number are left out."""
    return Measure(name, F.kll_sketch_agg_double(known(value.cast("double")), k), F.kll_merge_agg_double(name, k))


def merged(partials: DataFrame, keys: Sequence[str | Column], measures: Sequence[Measure]) -> DataFrame:
    """One row per key from any number of partial rows."""
    return partials.groupBy(*keys).agg(*[m.merged.alias(m.name) for m in measures])


@dataclass(frozen=True)
class Progress:
    """Which micro-batches of a table have been read: a folder of marks, one ``run=N`` a run."""

    path: str

    def marks(self, spark: SparkSession) -> DataFrame:
        """High-water marks of the runs that count: those since the last base."""
        try:
            found = spark.read.schema(MARKS).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], MARKS)
        base = found.where("base").agg(F.max("run")).first()[0] or 0
        return found.where(F.col("run") >= base)

    def newest(self, spark: SparkSession) -> dict[str, int]:
        """The last batch read of each writing query."""
        rows = self.marks(spark).groupBy("query_id").agg(F.max("batch_id").alias("m")).collect()
        return {row["query_id"]: row["m"] for row in rows}

    def fresh(self, stored: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """Rows of the batches not read yet, and the new marks.

        ``stored`` is a table partitioned by ``query_id`` and ``batch_id``. Its
        batches are known from the paths of its files, so the rows are found by
        partition and no file that was read before is opened.
        """
        marks = self.newest(stored.sparkSession)
        found: dict[str, int] = {}
        for path in stored.inputFiles():
            query, batch = BATCH.search(path).groups()
            found[query] = max(int(batch), found.get(query, -1))
        ahead = {query: batch for query, batch in found.items() if batch > marks.get(query, -1)}
        chosen = [
            (F.col("query_id") == query) & (F.col("batch_id") > marks.get(query, -1)) & (F.col("batch_id") <= batch)
            for query, batch in sorted(ahead.items())]
        return stored.where(reduce(lambda one, two: one | two, chosen, F.lit(False))), ahead

    def next_run(self, spark: SparkSession) -> int:
        return (self.marks(spark).agg(F.max("run")).first()[0] or 0) + 1

    def commit(self, spark: SparkSession, run: int, marks: Mapping[str, int], base: bool = False) -> None:
        """Makes a run count; a base replaces all runs before it."""
        table = spark.createDataFrame(list(marks.items()), "query_id string, batch_id bigint").withColumn("base", F.lit(base))
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run}")


@dataclass(frozen=True)
class Store:
    """Partials per key in a folder: ``rows/run=N`` and, for the runs that count, ``marks/run=N``."""

    path: str
    keys: Mapping[str, Column]
    measures: Sequence[Measure]

    @property
    def progress(self) -> Progress:
        return Progress(f"{self.path}/marks")

    def refresh(self, stored: DataFrame) -> int:
        """Adds the batches written since the last run; returns how many queries had any."""
        spark = stored.sparkSession
        rows, ahead = self.progress.fresh(stored)
        if ahead:
            grouped = rows.groupBy(*[key.alias(name) for name, key in self.keys.items()])
            self._write(spark, grouped.agg(*[m.partial.alias(m.name) for m in self.measures]), ahead, False)
        return len(ahead)

    def compact(self, spark: SparkSession) -> None:
        """Writes all partials as one run, which readers start from. Older files may then be removed."""
        marks = self.progress.newest(spark)
        if marks:
            self._write(spark, self.read(spark), marks, True)

    def rows(self, spark: SparkSession) -> DataFrame:
        """Partial rows of all runs that count."""
        runs = self.progress.marks(spark).select("run").distinct()
        return spark.read.parquet(f"{self.path}/rows").join(runs, "run", "left_semi").drop("run")

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per key."""
        return merged(self.rows(spark), list(self.keys), self.measures)

    def _write(self, spark: SparkSession, rows: DataFrame, marks: Mapping[str, int], base: bool) -> None:
        run = self.progress.next_run(spark)
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/run={run}")
        self.progress.commit(spark, run, marks, base)


def day(time: str = "datetime") -> Column:
    return F.to_date(time)


def daily_totals(path: str) -> Store:
    """Trades, volume and notional per symbol and day."""
    notional = known(F.col("last_price").cast("double") * F.col("volume").cast("double"))
    return Store(path, {"symbol": F.col("symbol"), "day": day()}, (
        count("trades"), total("volume", F.col("volume").cast("bigint")), total("notional", notional)))


def rollup_report(store: Store, spark: SparkSession) -> DataFrame:
    """The report of ``reports.rollup_report`` from stored partials."""
    return store.rows(spark).rollup("symbol", "day").agg(
        F.grouping_id().cast("int").alias("level"), *[m.merged.alias(m.name) for m in store.measures])


def daily_symbols(path: str, entries: int = SET_ENTRIES) -> Store:
    """The set of symbols traded on each day."""
    return Store(path, {"day": day()}, (count("trades"), distinct("symbols", F.col("symbol"), entries)))


def symbols_between(store: Store, ranges: DataFrame) -> DataFrame:
    """Estimated number of different symbols in each range of days, both ends included.

    ``ranges`` has ``first`` and ``last``; there are few of them. A symbol that
    trades on many days of a range counts once, which sums of days cannot give.
    """
    days = store.read(ranges.sparkSession)
    covered = ranges.withColumn("day", F.explode(F.sequence("first", "last")))
    return merged(days.join(covered, "day"), ["first", "last"], store.measures).select(
        "first", "last", F.round(F.theta_sketch_estimate("symbols")).cast("bigint").alias("symbols"), "trades")


def symbols_in_both(one: DataFrame, other: DataFrame, entries: int = SET_ENTRIES) -> DataFrame:
    """Estimated numbers of symbols on either side and on both, from two frames of sketches."""
    sides = one.select("symbols", F.lit(0).alias("side")).unionByName(other.select("symbols", F.lit(1).alias("side")))
    both = sides.agg(*[
        F.theta_union_agg(F.when(F.col("side") == number, F.col("symbols")), entries).alias(name)
        for number, name in enumerate("ab")])
    return both.select(*[
        F.round(F.theta_sketch_estimate(sketch)).cast("bigint").alias(name) for name, sketch in (
            ("left_symbols", F.col("a")), ("right_symbols", F.col("b")), ("both", F.theta_intersection("a", "b")))])


def daily_prices(path: str, symbol: Column | None = None) -> Store:
    """The distribution of prices per symbol and day."""
    key = F.col("symbol") if symbol is None else symbol
    return Store(path, {"symbol": key, "day": day()}, (quantiles("prices", F.col("last_price")),))


def price_percentiles(store: Store, spark: SparkSession, first: str, last: str, percents: Sequence[int]) -> DataFrame:
    """Percentiles per symbol over the days from ``first`` to ``last``, within the sketch's rank error."""
    inside = store.rows(spark).where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    # An empty sketch has no quantiles.
    size = F.kll_sketch_get_n_double("prices")
    return merged(inside, ["symbol"], store.measures).select(
        "symbol", size.alias("n"), *[
            F.when(size > 0, F.kll_sketch_get_quantile_double("prices", F.lit(p / 100))).alias(f"p{p}") for p in percents])


def last_versions(path: str, keys: Sequence[str], values: Sequence[str]) -> Store:
    """The last version of every key that a stream wrote in update mode.

    Superseded versions are read once; what a refresh has read, and after a
    ``compact`` the store's own older runs, may be removed.
    """
    version = F.struct("batch_id", *values)
    return Store(path, {key: F.col(key) for key in keys}, (Measure("version", F.max(version), F.max("version")),))


def current(store: Store, spark: SparkSession) -> DataFrame:
    """The rows of ``last_versions``, as ``windows.current`` gives them from all versions."""
    return store.read(spark).select(*store.keys, "version.*").drop("batch_id")
