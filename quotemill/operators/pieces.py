"""Ordered work per key when one key may hold a large share of all rows.

A window over a key runs in one task. ``cut`` counts rows per key first and
leaves ordinary keys alone. Rows of keys above ``hot_rows`` are range
partitioned by key and order, so a key spans many partitions, and each
partition becomes a piece with its own window. What a piece needs from the
pieces before it, such as a running total, is a value per piece: it is
aggregated, folded in piece order and joined back. That table has one row per
key and piece, and is broadcast while there are few pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quotemill.session import shared_dir

# Rows of one key that a single window task may sort.
HOT_ROWS = 5_000_000

# Keys or pieces that are broadcast; more are joined by shuffle.
FEW = 1_000_000

PIECE = "_piece"


def composed(name: str, earlier: WindowSpec) -> Column:
    """Affine maps ``x -> a x + b`` of the earlier pieces, applied one after another.

    Two maps compose to a third, so a recurrence is a scan whose parts may be
    taken apart anywhere. There is one map per piece.
    """
    none = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    maps = F.collect_list(name).over(earlier)
    return F.when(F.size(maps) > 0, F.aggregate(maps, none, lambda done, step: F.struct(
        (step["a"] * done["a"]).alias("a"), (step["a"] * done["b"] + step["b"]).alias("b"))))


# How values of a key's earlier pieces become one.
FOLDS = {
    "sum": lambda name, earlier: F.sum(name).over(earlier),
    "max": lambda name, earlier: F.max(name).over(earlier),
    "product": lambda name, earlier: F.product(name).over(earlier),
    "first": lambda name, earlier: F.first(name, ignorenulls=True).over(earlier),
    "last": lambda name, earlier: F.last(name, ignorenulls=True).over(earlier),
    "affine": composed,
}


def same_key(left: str, right: str, keys: list[str], renamed: str = "") -> Column:
    """Null-safe equality on all keys between two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{renamed}{k}")) for k in keys],
    )


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their row count, or None.

    The first key column alone is counted before the full key, so that the
    common case costs one aggregation over few groups. There are at most
    rows / ``hot_rows`` such keys.
    """
    counted = df
    for prefix in sorted({1, len(keys)}):
        part = keys[:prefix]
        hot = (
            counted.groupBy(*part).agg(F.count(F.lit(1)).alias("_rows"))
            .where(F.col("_rows") > hot_rows)
        )
        shared_dir(df.sparkSession)
        hot = hot.checkpoint()
        if hot.isEmpty():
            return None
        if prefix < len(keys):
            counted = with_keys(df, hot, part)
    return hot


def few(table: DataFrame) -> DataFrame:
    """A stored table, marked for a broadcast if it has at most ``FEW`` rows."""
    return F.broadcast(table) if table.count() <= FEW else table


def with_keys(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in the small table ``chosen``."""
    return df.alias("l").join(few(chosen).alias("r"), same_key("l", "r", keys), "left_semi")


def without_keys(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    return df.alias("l").join(few(chosen).alias("r"), same_key("l", "r", keys), "left_anti")


@dataclass(frozen=True)
class Pieces:
    """Rows with a piece number that grows with the order inside each key."""

    plain: DataFrame
    hot: DataFrame | None
    keys: list[str]
    order: list[str]
    descending: bool
    hot_rows: int
    # Range partitions of the large keys.
    count: int = 0

    @property
    def window(self) -> WindowSpec:
        """Rows of one piece in order.

        Without large keys a key is one piece, and rows that are laid out by key need no shuffle.
        """
        parts = self.keys if self.hot is None else [*self.keys, PIECE]
        return Window.partitionBy(*parts).orderBy(*self.sorting)

    @property
    def sorting(self) -> list[Column]:
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in self.order]

    def last_of(self, value: Column, when: Column | None = None) -> Column:
        """Aggregate: ``value`` of a piece's last row, or last row with ``when``."""
        place = F.struct(*self.order)
        place = place if when is None else F.when(when, place)
        return F.min_by(value, place) if self.descending else F.max_by(value, place)

    def transform(self, change: Callable[[DataFrame], DataFrame]) -> Pieces:
        """The same pieces after a row-wise or windowed change."""
        return replace(
            self, plain=change(self.plain), hot=None if self.hot is None else change(self.hot))

    def carry(self, **before: tuple[Column, str]) -> Pieces:
        """Adds values folded over the earlier pieces of the same key.

        Each ``name=(aggregate, fold)`` adds a column. ``aggregate`` is computed
        per piece and ``fold`` is one of ``FOLDS``. The column is null in a
        key's first piece.
        """
        kinds = self.plain.select(*[agg.alias(name) for name, (agg, _) in before.items()]).schema
        plain = self.plain.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in kinds])
        if self.hot is None:
            return replace(self, plain=plain)
        earlier = Window.partitionBy(*self.keys).orderBy(PIECE).rowsBetween(
            Window.unboundedPreceding, -1)
        per_piece = self.hot.groupBy(*self.keys, PIECE).agg(
            *[agg.alias(name) for name, (agg, _) in before.items()])
        folded = per_piece.select(
            *[F.col(k).alias(f"_k_{k}") for k in [*self.keys, PIECE]],
            *[FOLDS[fold](name, earlier).cast(kinds[name].dataType).alias(name)
              for name, (_, fold) in before.items()],
        )
        hot = (
            self.hot.alias("l")
            .join((F.broadcast(folded) if self.count <= FEW else folded).alias("r"),
                  same_key("l", "r", [*self.keys, PIECE], renamed="_k_"), "left")
            .select("l.*", *[f"r.{name}" for name in before])
        )
        return replace(self, plain=plain, hot=hot)

    def rows(self) -> DataFrame:
        return self.plain if self.hot is None else self.plain.unionByName(self.hot)

    def positions(self, name: str) -> Pieces:
        """Adds the 1-based place in the key's order."""
        place = F.coalesce("_ahead", F.lit(0)) + F.row_number().over(self.window)
        return self.carry(_ahead=(F.count(F.lit(1)), "sum")).transform(
            lambda rows: rows.withColumn(name, place.cast("bigint")).drop("_ahead"))

    def with_lookback(self, rows: int) -> tuple[DataFrame, WindowSpec]:
        """Frame and window for a function of the last ``rows`` rows before each row.

        Hot keys are numbered and cut into runs of equal length; the end of a
        run is copied to the start of the next. Copies have ``_own`` false and
        must be filtered out after the window function.
        """
        window = self.window
        plain = self.plain.withColumn("_own", F.lit(True))
        if self.hot is None:
            return plain, window
        length = max(self.hot_rows, rows)
        place = F.col("_place") - 1
        run = F.floor(place / length).cast("int")
        copies = F.when(
            place % length >= length - rows, F.array(run, run + 1)
        ).otherwise(F.array(run))
        hot = (
            self.positions("_place").hot
            .withColumn("_runs", copies)
            .drop(PIECE)
            .select("*", F.posexplode("_runs").alias("_copy", PIECE))
            .withColumn("_own", F.col("_copy") == 0)
            .drop("_runs", "_copy", "_place")
        )
        return plain.unionByName(hot), window


def cut(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    descending: bool = False,
    hot_rows: int | None = HOT_ROWS,
    probe: DataFrame | None = None,
) -> Pieces:
    """Rows of ``df`` in pieces that one task can order.

    ``order`` should be unique within a key, so that even rows of equal time
    can be split. ``hot_rows=None`` states that the groups are bounded by
    construction, such as one row per key and hour, and skips the count.
    ``probe`` is a cheaper frame to count: one that holds, for every key, at
    least as many rows as ``df``.
    """
    whole = df.withColumn(PIECE, F.lit(0))
    hot = hot_keys(df if probe is None else probe, keys, hot_rows) if hot_rows is not None else None
    if hot is None:
        return Pieces(whole, None, keys, order, descending, hot_rows or HOT_ROWS)
    total = hot.agg(F.sum("_rows")).first()[0]
    pieces = max(2, -(-2 * total // hot_rows))
    # Both sides below read the input, which may be expensive.
    df = df.checkpoint()
    whole = df.withColumn(PIECE, F.lit(0))
    direction = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    # The partition number must not change between the uses below, and range
    # bounds are sampled anew by every plan, hence the checkpoint.
    ranged = (
        with_keys(df, hot, keys)
        .repartitionByRange(int(pieces), *keys, *direction)
        .withColumn(PIECE, F.spark_partition_id())
        .checkpoint()
    )
    return Pieces(
        without_keys(df, hot, keys).withColumn(PIECE, F.lit(0)),
        ranged, keys, order, descending, hot_rows, int(pieces))


def lookup(
    df: DataFrame, table: DataFrame, keys: list[str], how: str = "left", *, null_safe: bool = False,
) -> DataFrame:
    """Join to a table that has one row per key.

    The optimizer picks the strategy from the measured sizes and splits a
    partition that one key makes too large, since only inner and left joins
    are made. ``null_safe`` lets a null key match a null key.
    """
    if not null_safe:
        return df.join(table, keys, how)
    other = table.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = same_key("l", "r", keys, renamed="_k_")
    return df.alias("l").join(other.alias("r"), same, how).drop(*[f"_k_{k}" for k in keys])
