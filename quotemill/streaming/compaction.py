"""Merges stored micro-batches into a table laid out by symbol.

A stream writes many small folders, one a run, batch and day. Compaction moves
the batches written since the last one into a catalog table that is bucketed by
symbol and sorted by time, so series, windows and joins on the symbol need no
shuffle, and a report lists few files. The stream's own folders stay as they are.

A run is a partition of the table. It counts once its marks are written; one
that failed before that is replaced by the next, which reads the same batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.operators.partials import Progress
from quotemill.operators.pieces import HOT_ROWS, hot_keys

# Rows of a very common symbol that one file holds, about.
FILE_ROWS = 2_000_000


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table by ``run`` and ``day``, in buckets of the symbol; ``marks`` is a folder of its own."""

    table: str
    marks: str
    symbol: str = "symbol"
    time: str = "datetime"
    buckets: int = 64

    @property
    def progress(self) -> Progress:
        return Progress(self.marks)

    def compact(self, stored: DataFrame, *, hot_rows: int = HOT_ROWS) -> int:
        """Adds the batches written since the last run; returns how many queries had any."""
        spark = stored.sparkSession
        rows, ahead = self.progress.fresh(stored)
        if not ahead:
            return 0
        run = self.progress.next_run(spark)
        shaped = rows.drop("query_id", "batch_id", "day").withColumn("day", F.to_date(self.time))
        if not spark.catalog.tableExists(self.table):
            (
                shaped.limit(0).withColumn("run", F.lit(run).cast("bigint")).write.format("parquet")
                .partitionBy("run", "day").bucketBy(self.buckets, self.symbol).sortBy(self.symbol, self.time)
                .saveAsTable(self.table))
        columns = [f"`{name}`" for name in spark.table(self.table).columns if name not in ("run", "day")]
        # Whatever a failed run of this number wrote goes.
        spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} PARTITION (run = {run}, day) "
            f"SELECT {', '.join(columns)}, day FROM {{rows}}", rows=self._dealt(shaped, hot_rows))
        self.progress.commit(spark, run, ahead)
        return len(ahead)

    def _dealt(self, rows: DataFrame, hot_rows: int) -> DataFrame:
        """Rows of a bucket in one task, so in one file a day; a very common symbol in several."""
        hot = hot_keys(rows.select(self.symbol), [self.symbol], hot_rows)
        if hot is None:
            return rows.repartition(self.buckets, self.symbol)
        parts = F.greatest(F.lit(1), F.ceil(F.col("_rows") / FILE_ROWS).cast("int"))
        few = hot.select(F.col(self.symbol).alias("_k"), parts.alias("_parts"))
        # At most rows / hot_rows symbols are that common.
        salted = rows.join(F.broadcast(few), F.col(self.symbol).eqNullSafe(F.col("_k")), "left").withColumn(
            "_salt", F.pmod(F.xxhash64(self.time, "id"), F.coalesce("_parts", F.lit(1))))
        # Buckets are told by the hash that also deals rows to tasks.
        bucket = F.pmod(F.hash(self.symbol), F.lit(self.buckets))
        total = self.buckets + int(few.agg(F.sum("_parts")).first()[0])
        return salted.withColumn("_bucket", bucket).repartition(total, "_bucket", "_salt").drop(
            "_k", "_parts", "_salt", "_bucket")

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows of the runs that count."""
        last = self.progress.next_run(spark) - 1
        return spark.table(self.table).where(F.col("run") <= last).drop("run", "day")
