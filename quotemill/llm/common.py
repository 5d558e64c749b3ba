"""Helpers the corpus operators share."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

# Bytes between words: space and the five ASCII control characters (fixed value).
BLANKS = r"\x20\x09-\x0D"
# Characters whose results a task holds before it hands them on.
HELD_CHARS = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and text of the documents table; other columns stay unread."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and quality label of the labelled documents."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once per context.

    A job submitted with ``--py-files`` does not need it, and neither does a
    cluster that has the package installed; it does no harm there.
    """
    context = spark.sparkContext
    if getattr(context, "_quotemill_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="quotemill-"), "quotemill_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(target)
    context._quotemill_shipped = True


def per_value(make: Callable[[], Callable[[Any], Any]], returns: T.DataType) -> Callable[..., Column]:
    """Column function that maps values one by one inside Arrow batches.

    ``make`` runs once per task on an executor and returns the function of one
    value (None for null). Spark bounds a batch by rows and by bytes, so a task
    holds one batch of texts whatever their lengths. Structs are given as dicts.
    """
    kind = to_arrow_type(returns)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            yield pa.array([work(value.as_py()) for value in batch], type=kind)
        del work
        give_back()

    return F.arrow_udf(run, returns)


def give_back() -> None:
    """Frees what a task built; Python workers are kept for later tasks of other queries."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def mapped_texts(
    df: DataFrame, text: str, keep: Sequence[str], make: Callable[[], Callable[[Any], dict]], fields: T.StructType,
) -> DataFrame:
    """The kept columns and what ``make``'s function gives for each text.

    Like ``per_value`` for results about as large as the texts: they leave a
    task in small batches, so it holds few of them at a time.
    """
    # Names of our own on the way: a dot in a name would be taken for a field.
    chosen = df.select(
        F.col(f"`{text}`").alias("__value"), *[F.col(f"`{name}`").alias(f"__{k}") for k, name in enumerate(keep)])
    schema = T.StructType([*chosen.schema.fields[1:], *fields.fields])
    kind = to_arrow_schema(schema)
    shape = to_arrow_type(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            values = batch.column(0)
            start, held, rows = 0, 0, []
            for place in range(len(values)):
                value = values[place].as_py()
                rows.append(work(value))
                held += len(value or "")
                if held >= HELD_CHARS or place == len(values) - 1:
                    made = pa.array(rows, type=shape)
                    kept = [column.slice(start, len(rows)) for column in batch.columns[1:]]
                    yield pa.RecordBatch.from_arrays([*kept, *made.flatten()], schema=kind)
                    start, held, rows = place + 1, 0, []
        del work
        give_back()

    return chosen.mapInArrow(run, schema).toDF(*keep, *fields.names)


def words_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]++")), F.lit(0)).cast("bigint")


def bounded_sample(df: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` rows drawn from the whole table, or all of a smaller one.

    The share follows the table's row count, so that what the limit gathers
    stays near ``rows`` however large the table is.
    """
    total = df.count()
    share = min(1.0, 1.5 * rows / total) if total else 1.0
    return df.sample(share, seed=seed).limit(rows)


def saved(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder, with their lineage cut."""
    from quotemill.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
