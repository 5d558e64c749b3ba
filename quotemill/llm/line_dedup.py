"""Boilerplate lines by the number of distinct sites they stand on.

Lines are compared without the blanks around them; lines without a word are
never touched. A sketch of the sites (HyperLogLog) per line hash merges on the
map side and again after the shuffle, so a line that stands everywhere costs one
row per task. Lines whose estimate is far from the threshold are decided by it;
those near it get an exact count of distinct sites, on their rows alone.

Lines on at least ``min_sites`` sites are boilerplate and are removed wherever
they stand. Only a proven copy is left whole: a document that would lose every
line with a word, and whose whole text stands in another row too. Its lines are
wide-spread because it is, and the near-duplicate stage keeps one of its group.

Lines are identified by two 64-bit hashes. Only hashes, sites and line numbers
are shuffled for the counts; texts move once, to meet the numbers of the lines
to remove, and only the rows that lose lines do. Lines are taken out of a text in
one pass, so a very long text costs what its length does.

Null texts stay null, with no lines. A null site is not a site. Repeated rows
have equal results and count as copies of each other; ids may repeat or be null,
as rows meet by id and text hash. A document that loses all its lines and has no
copy becomes the empty text. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import saved

MIN_SITES = 10
SKETCH_BITS = 12
# Estimates this far from the threshold, as a share of it, are counted exactly.
# A sketch of 2^12 registers errs by 1.6 % at one standard deviation.
MARGIN = 0.2

BLANKS = " \t\n\x0b\x0c\r"

# What tells a table's rows apart.
ROW = ("id", "t1", "t2")
# Names the documents' own columns cannot have by chance.
OWN = "__line_dedup_{}"


def text_lines(text: Column) -> Column:
    """Lines of a text; null has none."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def worded(text: Column) -> Column:
    """Number of lines with a word."""
    found = F.filter(text_lines(text), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return F.size(found).cast("bigint")


def keyed(docs: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    """What tells rows apart, their id and text hashes, and other columns."""
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), *others)


def lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row per line with a word: its document, number, hashes and site."""
    base = keyed(
        docs, id_col, text_col, F.col(f"`{site_col}`").alias("site"),
        F.posexplode(text_lines(F.col(f"`{text_col}`"))).alias("number", "raw"))
    line = F.btrim(F.col("raw"), F.lit(BLANKS))
    return base.select(*ROW, "site", "number", line.alias("line")).where("line <> ''").select(
        *ROW, "site", "number", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(found: DataFrame, min_sites: int) -> DataFrame:
    """Hashes of the lines that stand on at least ``min_sites`` sites."""
    key = ["h1", "h2"]
    margin = MARGIN * min_sites
    # Few lines come near the threshold. They are kept apart, so that the joins
    # with them are shuffles of their own, which the optimizer splits at lines
    # that stand almost everywhere.
    spread = saved(
        found.groupBy(*key)
        .agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
        .select(*key, F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites - margin))
    clear = spread.where(F.col("sites") > min_sites + margin).select(*key)
    near = spread.where(F.col("sites") <= min_sites + margin).select(*key)
    # Rows are combined by line and site before they meet the lines, so a line
    # with very many rows on a few sites is a few rows.
    exact = (
        found.where("site is not null").select(*key, "site").distinct()
        .join(near, key, "left_semi")
        .groupBy(*key).agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites).select(*key))
    return saved(clear.unionByName(exact))


def hit_rows(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """The rows with boilerplate lines: the numbers of these, and whether the row is a proven copy."""
    found = lines(docs, id_col, text_col, site_col)
    hits = saved(
        found.join(boilerplate(found, min_sites), ["h1", "h2"])
        # A repeated row has the same lines; its numbers count once.
        .groupBy(*ROW).agg(F.collect_set("number").alias("numbers")))
    # Copies have the same lines, so all of a group are candidates if one is.
    counted = keyed(docs, id_col, text_col, worded(F.col(f"`{text_col}`")).alias("worded"))
    lost = hits.select(*[F.col(c).alias(f"_{c}") for c in ROW], F.size("numbers").alias("n"))
    candidates = counted.join(lost, same_row("", "_") & (F.col("worded") == F.col("n")), "left_semi")
    copies = candidates.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select(
        "t1", "t2", F.lit(True).alias("is_copy"))
    # A copy's text has no line outside the boilerplate, so a row of its hashes is one.
    return hits.join(copies, ["t1", "t2"], "left")


def same_row(one: str, other: str) -> Column:
    """Whether two rows have one id and text hash, given the prefixes of their columns."""
    return F.col(f"{one}id").eqNullSafe(F.col(f"{other}id")) & (
        F.col(f"{one}t1") == F.col(f"{other}t1")) & (F.col(f"{one}t2") == F.col(f"{other}t2"))


def marked(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """The documents with the numbers of their boilerplate lines, null if none, and ``is_copy``."""
    own = {name: OWN.format(name) for name in [*ROW, "numbers", "is_copy"]}
    hits = hit_rows(docs, id_col, text_col, site_col, min_sites).withColumnsRenamed(own)
    text = F.col(f"`{text_col}`")
    same = (
        F.col(f"`{id_col}`").eqNullSafe(F.col(own["id"])) & (F.xxhash64(text) == F.col(own["t1"]))
        & (F.xxhash64(F.lit(1), text) == F.col(own["t2"])))
    return docs.join(hits, same, "left").drop(*[own[name] for name in ROW])


def is_copy() -> Column:
    """Whether a marked document is a proven copy."""
    return F.coalesce(F.col(OWN.format("is_copy")), F.lit(False))


def cleaned(text: Column) -> Column:
    """Text of a marked document without its boilerplate lines; copies stay whole."""
    numbers = F.col(OWN.format("numbers"))
    parts = text_lines(text)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), numbers)
    # The lines are named once and then read by number, not cut anew for each.
    boxed = F.array(F.struct(parts.alias("parts"), stay.alias("stay")))
    rest = F.transform(
        boxed, lambda b: F.array_join(F.transform(b["stay"], lambda k: F.get(b["parts"], k)), "\n"))
    return F.when(numbers.isNull() | is_copy(), text).otherwise(F.get(rest, F.lit(0)))


def with_clean_text(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """The documents with their text cleaned and all other columns as they were."""
    text = F.col(f"`{text_col}`")
    return marked(docs, id_col, text_col, site_col, min_sites).select(*[
        cleaned(text).alias(name) if name == text_col else F.col(f"`{name}`") for name in docs.columns])


def without_boilerplate(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """The documents' ids and cleaned texts, with what was found in each.

    Columns: the id, ``text``, ``n_lines`` (lines with a word), ``n_boilerplate``
    (of them on ``min_sites`` sites or more), ``n_removed`` and ``is_copy``.
    """
    few = docs.select(*[F.col(f"`{name}`") for name in (id_col, text_col, site_col)])
    text = F.col(f"`{text_col}`")
    numbers = F.col(OWN.format("numbers"))
    none = F.lit(0).cast("bigint")
    hits = F.when(numbers.isNull(), none).otherwise(F.size(numbers).cast("bigint"))
    return marked(few, id_col, text_col, site_col, min_sites).select(
        F.col(f"`{id_col}`"), cleaned(text).alias("text"), worded(text).alias("n_lines"),
        hits.alias("n_boilerplate"), F.when(is_copy(), none).otherwise(hits).alias("n_removed"),
        is_copy().alias("is_copy"))
