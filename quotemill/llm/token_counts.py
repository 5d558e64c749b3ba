"""Exact token counts of every prefix of a text, by prefix dynamic programming.

For each piece that the tokenizer's pattern cuts, one pass over its bytes finds
the last token of every prefix: the vocabulary entry that ends there and stays
apart from the last token of the prefix before it. Two neighbouring tokens stay
apart if no merge across their border comes up before one of them is complete,
which follows from the merge tree of each token. The encoding of a prefix is
unique, so exactly one entry fits, and its count is one more than the count of
the shorter prefix. No piece is encoded for this.

A text's counts are the pieces' counts added up. Cutting a text can change how
the pattern cuts its end, and three cases are set right so that entry p equals
the count of the text's first p characters on their own: blanks before a word,
half an apostrophe ending, and half a special token.

The counts answer questions about budgets without encoding again: the total,
the count at any cut, the longest prefix within a budget.

Nulls count as the empty text: no bytes, no tokens. Repeated rows give repeated
rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T

from quotemill.llm.bpe import Pieces, Vocabulary, read_tokenizer
from quotemill.llm.common import per_value

# Pairs of tokens whose border a worker remembers.
KEPT_BORDERS = 1 << 19
COUNT = np.dtype("<i4")
BLANKS_BEFORE_WORD = regex.compile(r"\s{2,}(?=\S)")
# Endings the pattern takes whole, but which are cut in two while unfinished (fixed values).
ENDINGS = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Counts of a tokenizer's tokens in every prefix of a text."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        specials = set(vocab.special.values())
        self.halves = {
            vocab.merged[rank]: (rank, *vocab.halves[rank]) for rank in range(len(vocab.merged))}
        # Every ending of every token: its id, or -1 if it only ends longer ones.
        self.endings: dict[bytes, int] = {}
        for number, spelled in vocab.spelled.items():
            if number in specials or (len(spelled) > 1 and number not in self.halves):
                continue
            if not self.whole(number):
                continue
            self.endings[spelled] = number
            for start in range(1, len(spelled)):
                self.endings.setdefault(spelled[start:], -1)
        self.borders: dict[int, bool] = {}
        self.counts = Pieces(self.count_piece)

    def whole(self, number: int) -> bool:
        """Whether the token's own spelling encodes to it; others never occur."""
        if number not in self.halves:
            return True
        _, left, right = self.halves[number]
        # The halves stay apart until their own merge, the token's last.
        return self.first_merge(left, right) == number

    def spine(self, number: int, side: int) -> list[tuple[int, float]]:
        """Tokens at one edge of a token's merge tree, each with the rank that ends it."""
        out, ends = [], float("inf")
        while True:
            out.append((number, ends))
            if number not in self.halves:
                return out
            ends, number = self.halves[number][0], self.halves[number][side]

    def first_merge(self, left: int, right: int) -> int | None:
        """Token made across the border of two neighbours, or None if they stay apart."""
        for x, x_ends in self.spine(left, 2):
            for y, y_ends in self.spine(right, 1):
                rank = self.vocab.ranks.get(x << 32 | y)
                # Of equal merges the leftmost comes first.
                if rank is not None and rank < x_ends and rank <= y_ends:
                    return self.vocab.merged[rank]
        return None

    def apart(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.borders.get(key)
        if known is None:
            known = self.first_merge(left, right) is None
            if len(self.borders) >= KEPT_BORDERS:
                self.borders.clear()
            self.borders[key] = known
        return known

    def count_bytes(self, piece: bytes) -> list[int]:
        """Count of every byte prefix of a piece, from the empty one on."""
        endings, apart = self.endings, self.apart
        counts, last = [0], [-1]
        for end in range(1, len(piece) + 1):
            start = end - 1
            while start >= 0:
                token = endings.get(piece[start:end])
                if token is None:
                    raise ValueError("a prefix has no encoding under this vocabulary")
                if token >= 0 and (start == 0 or apart(last[start], token)):
                    break
                start -= 1
            else:
                raise ValueError("a prefix has no encoding under this vocabulary")
            counts.append(counts[start] + 1)
            last.append(token)
        return counts

    def count_piece(self, piece: str) -> bytes:
        """Packed counts at each character's end."""
        spelled = piece.encode("utf-8", "surrogatepass")
        counts = self.count_bytes(spelled)
        if len(spelled) == len(piece):
            ends = counts[1:]
        else:
            ends = [counts[k] for k in range(1, len(counts))
                    if k == len(spelled) or spelled[k] & 0xC0 != 0x80]
        if piece in ENDINGS:
            ends[1] = 2
        return np.array(ends, dtype=COUNT).tobytes()

    def plain(self, text: str) -> np.ndarray:
        """Counts of a text without special tokens, at each character's end."""
        pieces = self.vocab.pieces(text)
        if not pieces:
            return np.zeros(0, dtype=COUNT)
        counts = np.frombuffer(b"".join(map(self.counts.__getitem__, pieces)), dtype=COUNT).copy()
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        totals = counts[np.cumsum(sizes) - 1]
        counts += np.repeat(np.cumsum(totals) - totals, sizes).astype(COUNT)
        for blanks in BLANKS_BEFORE_WORD.finditer(text):
            start, end = blanks.span()
            ahead = counts[start - 1] if start else 0
            run = np.frombuffer(self.counts[blanks.group()], dtype=COUNT)
            counts[end - 1] = ahead + run[-1]
        return counts

    def prefixes(self, text: str | None) -> np.ndarray:
        """Token count of the first p characters, for p from 0 to the length."""
        parts = self.vocab.parts(text or "")
        out, total = [np.zeros(1, dtype=COUNT)], 0
        for place in range(0, len(parts), 2):
            special = parts[place + 1] if place + 1 < len(parts) else ""
            # An unfinished special token is ordinary text.
            counts = self.plain(parts[place] + special[:-1]) + total
            out.append(counts)
            size = len(parts[place])
            total = int(counts[size - 1]) if size else total
            if special:
                total += 1
                out.append(np.array([total], dtype=COUNT))
        return np.concatenate(out)


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Length of the longest prefix of at most ``budget`` tokens.

    Counts can fall when a text grows, so the last fitting place is searched.
    """
    return int(np.flatnonzero(counts <= budget)[-1])


def prefix_counter(
    spark: SparkSession, path: str, budgets: Sequence[int] = (), keep_prefixes: bool = False,
) -> Callable[..., Column]:
    """Column function: text to a struct of its counts.

    ``n_bytes`` and ``n_tokens`` describe the whole text; ``cuts`` holds, for
    every budget, the number of characters of the longest prefix within it;
    ``prefixes`` holds the count at every prefix as packed little-endian 32-bit
    integers if ``keep_prefixes`` is set, else null.
    """
    shared = spark.sparkContext.broadcast(read_tokenizer(path))
    wanted = list(budgets)
    if any(budget < 0 for budget in wanted):
        raise ValueError("a budget is at least 0 tokens")

    def make() -> Callable[[str | None], dict]:
        counts_of = PrefixCounter(Vocabulary(shared.value)).prefixes

        def one(text: str | None) -> dict:
            counts = counts_of(text)
            return {
                "n_bytes": len((text or "").encode("utf-8", "surrogatepass")),
                "n_tokens": int(counts[-1]),
                "cuts": [longest_within(counts, budget) for budget in wanted],
                "prefixes": counts.tobytes() if keep_prefixes else None,
            }

        return one

    return per_value(make, T.StructType([
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("cuts", T.ArrayType(T.LongType())),
        T.StructField("prefixes", T.BinaryType()),
    ]))
