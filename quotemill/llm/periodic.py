"""Periodic runs of words, from maximal pairs in the tree of LCP intervals.

A run is a stretch of words with smallest period q, at least ``shortest`` words
and three periods long, that no neighbouring word extends. Two of its suffixes,
q words apart, agree on the whole run but its last q words, and differ in the
word before and the word after: they are a maximal pair, of length l = length -
q >= 2 q. The other way round, a maximal pair at distance q with l >= 2 q and l +
q >= ``shortest`` is a run with period q; nothing is left to extend. Pairs at a
multiple of the period span the same words, so the least distance counts.

Suffixes are ordered by doubling, for many texts at once: word numbers are of
one text each, so suffixes of different texts never meet. From the second round
on only those that still tie are sorted; ordinary texts drop out early, as a
pair is never shorter than two thirds of ``shortest``.

The tree is then visited bottom up. A node holds its suffixes by place and in
one list for each word on their left; joining two children gives the pairs whose
length is exactly the node's, and the smaller child looks for partners in the
larger. Occurrences of a string within half its length are one arithmetic
progression, so all but the first follow the same word: partners to the right
are of one class, and on the left only the outermost can be of another. Every
suffix is so met with a search, and with the pairs it makes.

A task holds ``HELD_WORDS`` words at a time, or one text if that is longer; time
grows with the words, times the logarithm of the longest repeat. Words are
separated by space and the ASCII control characters 9 to 13, and compared as
they are. Null and empty texts have no words and no runs; repeated rows have
equal results; other columns pass through if asked for.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quotemill.llm.common import give_back

SHORTEST = 24
# Words a task compares at a time.
HELD_WORDS = 1 << 18

RUN = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType())])


class Node:
    """Suffixes below a node of the tree: all in order, and in order for each word on their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.classes = {left: [place]}

    def absorb(self, other: Node) -> None:
        merge(self.places, other.places)
        for left, places in other.classes.items():
            own = self.classes.get(left)
            if own is None:
                self.classes[left] = places
            else:
                merge(own, places)


def merge(into: list[int], places: list[int]) -> None:
    """Adds sorted places to a sorted list."""
    if len(places) < 8:
        for place in places:
            insort(into, place)
    else:
        into += places
        into.sort()


def pairs(small: Node, large: Node, left: list[int], length: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Places of two children whose left words differ, at distances a run of this length allows."""
    reach, least = length // 2, shortest - length
    places = large.places
    for place in small.places:
        own = left[place]
        k = bisect_right(places, place)
        if k < len(places) and places[k] - place <= reach and left[places[k]] != own:
            partners = large.classes[left[places[k]]]
            for k in range(bisect_right(partners, place), bisect_right(partners, place + reach)):
                if partners[k] - place >= least:
                    yield place, partners[k]
        k = bisect_left(places, place - reach)
        if k < len(places) and places[k] < place and left[places[k]] != own and place - places[k] >= least:
            yield places[k], place


def maximal_pairs(
    order: list[int], common: list[int], left: list[int], shortest: int,
) -> Iterator[tuple[int, int, int]]:
    """Maximal pairs (place, later place, length) that are runs, from suffixes in order.

    ``common[k]`` is the length suffix k shares with the one before it; 0 parts trees.
    """
    stack: list[tuple[int, Node]] = []
    for place, shared in zip([*order, -1], [*common, 0]):
        while len(stack) > 1 and stack[-1][0] >= max(shared, 1):
            length, node = stack.pop()
            below, other = stack.pop()
            small, large = (node, other) if len(node.places) < len(other.places) else (other, node)
            for one, two in pairs(small, large, left, length, shortest):
                yield one, two, length
            large.absorb(small)
            stack.append((below, large))
        if shared == 0:
            stack.clear()
        if place >= 0:
            stack.append((shared, Node(place, left[place])))


class Suffixes:
    """Places of many texts' words, ordered by what follows them in their text."""

    def __init__(self, numbers: np.ndarray, ends: np.ndarray, least: int):
        """``ends`` has each place's end of text; repeats shorter than ``least`` words are not told apart."""
        self.ends = ends
        self.ranks = [numbers]
        self.size = len(numbers)
        # The longest power of two that every wanted repeat contains.
        self.floor = least.bit_length() - 1
        self.tied = np.arange(self.size)
        self.kept = self.tied[:0]
        while len(self.tied):
            self.double()
            if len(self.ranks) == self.floor + 1:
                self.kept = self.tied

    def double(self) -> None:
        """Orders the places that tie by twice as many words."""
        width = 1 << (len(self.ranks) - 1)
        rank, tied = self.ranks[-1], self.tied
        after = tied + width
        inside = after < self.ends[tied]
        following = np.zeros(len(tied), dtype=np.int64)
        following[inside] = rank[after[inside]].astype(np.int64) + 1
        key = rank[tied].astype(np.int64) * (self.size + 1) + following
        order = np.argsort(key, kind="stable")
        key, places = key[order], tied[order]
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        if width == 1:
            older = np.zeros(len(key), dtype=np.int64)
            first = 0
        else:
            # A place's rank is the number of places before its class.
            older = rank[places].astype(np.int64)
            parted = np.ones(len(key), dtype=bool)
            parted[1:] = older[1:] != older[:-1]
            first = np.maximum.accumulate(np.where(parted, np.arange(len(key)), 0))
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
        new = rank.copy()
        new[places] = older + start - first
        self.ranks.append(new)
        alone = fresh & np.append(fresh[1:], True)
        self.tied = places[~alone]

    def tree(self) -> tuple[np.ndarray, np.ndarray]:
        """Places with a repeat of the least length, in order, and what each shares with the one before."""
        if not len(self.kept):
            return self.kept, self.kept
        order = self.kept[np.argsort(self.ranks[-1][self.kept], kind="stable")]
        one, two = order[:-1], order[1:]
        shared = np.zeros(len(one), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            a, b = one + shared, two + shared
            inside = (a < self.ends[one]) & (b < self.ends[two])
            rank = self.ranks[level]
            same = np.zeros(len(one), dtype=bool)
            same[inside] = rank[a[inside]] == rank[b[inside]]
            shared += same.astype(np.int64) << level
        shared[shared < 1 << self.floor] = 0
        return order, np.append(0, shared)


def find_runs(texts: Sequence[Sequence[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """Runs of each text (a list of words): start, length and period, by start and then period."""
    sizes = [len(words) for words in texts]
    numbers: list[int] = []
    total = 0
    for words in texts:
        # Numbers go on from text to text, so texts share none.
        known: dict[bytes, int] = {}
        for word in words:
            numbers.append(known.setdefault(word, total + len(known)))
        total += len(known)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not numbers:
        return out
    starts = np.cumsum([0, *sizes])
    which = np.repeat(np.arange(len(sizes)), sizes)
    number = np.array(numbers, dtype=np.int32 if len(numbers) < 1 << 31 else np.int64)
    order, common = Suffixes(number, starts[which + 1], -(-2 * shortest // 3)).tree()
    if not len(order):
        return out
    before = np.append(-1, number[:-1])
    before[starts[:-1][np.array(sizes) > 0]] = -1
    least: dict[tuple[int, int], int] = {}
    for place, other, length in maximal_pairs(order.tolist(), common.tolist(), before.tolist(), shortest):
        period = other - place
        span = (place, length + period)
        if period < least.get(span, period + 1):
            least[span] = period
    for (place, length), period in least.items():
        text = which[place]
        out[text].append((int(place - starts[text]), length, period))
    for found in out:
        found.sort(key=lambda run: (run[0], run[2]))
    return out


def without_repeats(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    stays = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        stays[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(stays)]


def collapsed(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
    shortest: int = SHORTEST, change: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Every row's id and kept columns, its number of words, its runs and its text without repeats.

    ``change`` may rewrite a row's words, given its id, before they are searched.
    ``collapsed`` joins the words left by one space.
    """
    if shortest < 3:
        raise ValueError("a run has three words or more")
    names = [id_col, *keep]
    # Names of our own on the way: a dot in a name would be taken for a field.
    chosen = docs.select(
        F.col(f"`{text_col}`").alias("__text"), *[F.col(f"`{name}`").alias(f"__{k}") for k, name in enumerate(names)])
    schema = T.StructType([*chosen.schema.fields[1:], *FIELDS.fields])
    shape = to_arrow_schema(schema)
    own = list(shape)[len(names):]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(columns: list[pa.Array], held: list[list[bytes]]) -> pa.RecordBatch:
            found = find_runs(held, shortest)
            rest = [
                b" ".join(without_repeats(words, runs) if runs else words) for words, runs in zip(held, found)]
            values = [
                pa.array([len(words) for words in held], type=own[0].type),
                pa.array([[dict(zip(RUN.names, run)) for run in runs] for runs in found], type=own[1].type),
                pa.array(rest, type=pa.binary()).cast(own[2].type)]
            return pa.RecordBatch.from_arrays([*columns, *values], schema=shape)

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            ids = batch.column(1)
            start, held, size = 0, [], 0
            for place in range(len(texts)):
                words = (texts[place].as_py() or b"").split()
                if change is not None:
                    words = change(ids[place].as_py(), words)
                held.append(words)
                size += len(words)
                if size >= HELD_WORDS or place == len(texts) - 1:
                    yield made([column.slice(start, len(held)) for column in batch.columns[1:]], held)
                    start, held, size = place + 1, [], 0
        give_back()

    return chosen.mapInArrow(run, schema).toDF(*names, *FIELDS.names)
