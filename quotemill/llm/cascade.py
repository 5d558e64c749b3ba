"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Every text gets its base counts. Texts that fail the base rules are rejected at
once; the others pass through the cascade, which stops at the first rule that
rejects. The order is estimated on a sample: each rule is timed and asked on
every sampled text, and the next rule is always the one that rejects most of
the texts still left per second spent on them. A text is kept if no rule rejects
it, so the order changes what the cascade costs and never what it keeps.

Words are runs of characters other than space and the five ASCII control
characters from tab to carriage return. Null counts as the empty text: no words,
rejected by the base rules. Repeated rows give repeated rows; other columns
pass through. An empty table gives an empty sample and the rules in listed order.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import bounded_sample, per_value

# Rows the order is estimated on.
SAMPLE_ROWS = 2_000
SAMPLE_SEED = 7

BLANK_BYTES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
LETTERS = re.compile(r"[^\W\d_]")
UPPER = re.compile(r"[A-Z]")
LOWER = re.compile(r"[a-z]")

MIN_WORDS = 50
MAX_REPEATED = 50


class Facts:
    """What the rules ask of a text, computed when first asked."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.spelled = self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.spelled.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        blanks = len(self.spelled) - len(self.spelled.translate(None, BLANK_BYTES))
        return len(self.text) - blanks

    @cached_property
    def n_symbols(self) -> int:
        return len(self.spelled) - len(self.spelled.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.spelled.split(b"\n") if line.strip(BLANK_BYTES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen = Counter(windows)
        covered, last = 0, 0
        for start, window in enumerate(windows):
            if seen[window] > 1:
                covered += start + 3 - max(start, last)
                last = start + 3
        return covered

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEATED * self.n_words


@dataclass(frozen=True)
class Rule:
    """Rejects a text whose share of something passes a limit, in percent."""

    name: str
    rejects: Callable[[Facts], bool]


def many_symbols(facts: Facts) -> bool:
    return 100 * facts.n_symbols > 10 * facts.n_words


def odd_word_length(facts: Facts) -> bool:
    return not 2 * facts.n_words <= facts.word_chars <= 12 * facts.n_words


def repeated_lines(facts: Facts) -> bool:
    return 100 * facts.n_dup_lines > 60 * len(facts.lines)


def mostly_capitals(facts: Facts) -> bool:
    capitals = len(UPPER.findall(facts.text))
    return capitals > len(LOWER.findall(facts.text))


def shouted(facts: Facts) -> bool:
    return 100 * sum(word.endswith(b"!") for word in facts.words) > 20 * facts.n_words


def one_word_dominates(facts: Facts) -> bool:
    return 100 * max(Counter(facts.words).values()) > 25 * facts.n_words


def few_with_letters(facts: Facts) -> bool:
    lettered = sum(LETTERS.search(word) is not None for word in facts.text.split())
    return 100 * lettered < 70 * len(facts.text.split())


RULES = (
    Rule("many_symbols", many_symbols),
    Rule("odd_word_length", odd_word_length),
    Rule("repeated_lines", repeated_lines),
    Rule("mostly_capitals", mostly_capitals),
    Rule("shouted", shouted),
    Rule("one_word_dominates", one_word_dominates),
    Rule("few_with_letters", few_with_letters),
)


def profiler(rules: Sequence[Rule]) -> Callable[..., Column]:
    """Column function: per text the rules that reject it, as bits, and the seconds of each."""

    def make() -> Callable[[str | None], dict | None]:
        def one(text: str | None) -> dict | None:
            facts = Facts(text)
            if facts.base_failed:
                return None
            bits, seconds = 0, []
            for place, rule in enumerate(rules):
                # Base counts are known before the cascade starts.
                facts.word_chars, facts.n_symbols, facts.n_dup_lines
                began = time.perf_counter()
                bits |= rule.rejects(facts) << place
                seconds.append(time.perf_counter() - began)
            return {"rejects": bits, "seconds": seconds}

        return one

    return per_value(make, T.StructType([
        T.StructField("rejects", T.LongType()),
        T.StructField("seconds", T.ArrayType(T.DoubleType())),
    ]))


def best_order(groups: Sequence[tuple[int, int, Sequence[float]]], n_rules: int) -> list[int]:
    """Rules by rejection per cost among the texts that earlier rules leave.

    ``groups`` holds, per set of rejecting rules, the texts and each rule's
    total seconds on them.
    """
    left, order = list(groups), []
    while len(order) < n_rules:
        def worth(place: int) -> float:
            rejected = sum(texts for bits, texts, _ in left if bits >> place & 1)
            return rejected / (sum(seconds[place] for _, _, seconds in left) + 1e-9)

        rest = [place for place in range(n_rules) if place not in order]
        order.append(max(rest, key=lambda place: (worth(place), -place)))
        left = [group for group in left if not group[0] >> order[-1] & 1]
    return order


def estimated_order(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS,
) -> list[int]:
    """Order of the rules, from a sample of at most ``sample_rows`` rows.

    What reaches the driver is one row per combination of rejecting rules.
    """
    profile = profiler(rules)
    sampled = bounded_sample(docs.select(text), sample_rows, SAMPLE_SEED)
    profiled = sampled.select(profile(text).alias("p")).where("p is not null")
    groups = profiled.groupBy("p.rejects").agg(
        F.count(F.lit(1)).alias("texts"),
        *[F.sum(F.col("p.seconds")[k]).alias(f"s{k}") for k in range(len(rules))])
    return best_order(
        [(row.rejects, row.texts, [row[f"s{k}"] for k in range(len(rules))]) for row in groups.collect()],
        len(rules))


def cascade(order: Sequence[int], rules: Sequence[Rule] = RULES) -> Callable[..., Column]:
    """Column function: text to a struct of its base counts and the verdict."""
    ordered = [rules[place] for place in order]

    def make() -> Callable[[str | None], dict]:
        def one(text: str | None) -> dict:
            facts = Facts(text)
            failed = facts.base_failed
            return {
                "n_words": facts.n_words,
                "word_chars": facts.word_chars,
                "n_symbols": facts.n_symbols,
                "n_dup_lines": facts.n_dup_lines,
                "n_repeat_words": facts.n_repeat_words,
                "base_failed": failed,
                "kept": not failed and not any(rule.rejects(facts) for rule in ordered),
            }

        return one

    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return per_value(make, T.StructType(
        [T.StructField(name, T.LongType()) for name in counts]
        + [T.StructField(name, T.BooleanType()) for name in ("base_failed", "kept")]))
