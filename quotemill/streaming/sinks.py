"""Micro-batch sinks and the tables they fill.

A replayed micro-batch must not leave duplicate rows, and no run may replace
another run's rows. The directory and catalog sinks replace the partition of
their query and batch id: a restart on the same checkpoint is the same query, a
new checkpoint or another job is a new one and adds its rows. A keyed store
converges because row ids are equal on every replay.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quotemill.sources.feeds import Feed


# Partition columns of stored rows: which run wrote them, and their day.
RUN = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())])


def query_of(batch: DataFrame) -> str:
    """Id of the streaming query that runs the batch; it comes with the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


@dataclass(frozen=True)
class BatchDirectory:
    """Parquet files, one ``query_id=Q/batch_id=N`` directory per micro-batch."""

    path: str

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/query_id={query_of(batch)}/batch_id={batch_id}")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All batches, with their ``query_id`` and ``batch_id``."""
        whole = T.StructType([*schema.fields, *RUN.fields])
        return spark.read.schema(whole).parquet(self.path)


@dataclass(frozen=True)
class CatalogTable:
    """A catalog table partitioned by run and by the rows' day."""

    table: str

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = [f"`{name}`" for name in spark.table(self.table).columns if name not in (*RUN.names, "day")]
        # Days follow from the rows; everything the run's batch wrote before goes.
        spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} "
            f"PARTITION (query_id = '{query_of(batch)}', batch_id = {int(batch_id)}, day) "
            f"SELECT {', '.join(columns)}, to_date(datetime) AS day FROM {{batch}}",
            batch=batch,
        )


@dataclass(frozen=True)
class KeyedStore:
    """A table of a connector that writes by primary key, ``id``."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    mode: str = "append"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.format(self.format).options(**self.options).mode(self.mode).save()


def cassandra(feed: Feed, keyspace: str) -> KeyedStore:
    """The feed's table in a Cassandra keyspace; needs the connector on the class path."""
    return KeyedStore("org.apache.spark.sql.cassandra", {"table": feed.table, "keyspace": keyspace})


def keyed_statements(feed: Feed, keyspace: str, catalog: str = "cassandra") -> list[str]:
    """Statements that create a feed's keyspace (replication 1) and table (key ``id``).

    They run where ``spark.sql.catalog.<catalog>`` names the connector's catalog.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.row)
    return [
        f"CREATE DATABASE IF NOT EXISTS {catalog}.{keyspace} "
        "WITH DBPROPERTIES (class='SimpleStrategy', replication_factor='1')",
        f"CREATE TABLE IF NOT EXISTS {catalog}.{keyspace}.{feed.table} ({columns}) "
        "USING cassandra PARTITIONED BY (id)",
    ]


def create_keyed(spark: SparkSession, feed: Feed, keyspace: str, catalog: str = "cassandra") -> KeyedStore:
    """The feed's keyspace and table in the keyed store, if they are absent, and its sink."""
    for statement in keyed_statements(feed, keyspace, catalog):
        spark.sql(statement)
    return cassandra(feed, keyspace)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def create_table(spark: SparkSession, feed: Feed, database: str) -> str:
    """The feed's table, partitioned by run and day, if it is absent."""
    table = f"{database}.{feed.table}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.row)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, query_id string, batch_id bigint, day date) "
        "USING parquet PARTITIONED BY (query_id, batch_id, day)"
    )
    return table
