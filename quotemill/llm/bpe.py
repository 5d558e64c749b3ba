"""Byte-level BPE: encoding with a priority queue of merge ranks, decoding by concatenation.

A text is cut into pieces by the tokenizer's pattern. The bytes of a piece are
symbols in a doubly linked list, and every adjacent pair that has a merge rank
stands in a priority queue. The lowest rank is merged first, the leftmost among
equal ranks. Merging changes two neighbourhoods, whose new pairs are pushed;
entries that no longer describe two neighbours are stale and are skipped when
they come up. Pieces repeat, so the ids of recent pieces are kept in a table of
bounded size.

Ids travel as packed little-endian unsigned 32-bit integers, the form in which
training shards store them; ``unpacked`` gives them as an array.

Nulls encode as the empty text. Empty texts have no ids. Special tokens that
stand in a text become their id, as the tokenizers library does by default.
Repeated rows give repeated rows, and other columns are passed through.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import mapped_texts, per_value

# Pieces of a generation whose ids a worker keeps, and the longest piece it keeps (characters).
KEPT_PIECES = 1 << 18
KEPT_LENGTH = 64

# Letters and numbers that Unicode 17 added, as inclusive ranges (fixed values).
# The tokenizers library follows Unicode 16, where they are neither.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)


def pattern_of(letter: str, number: str, other: str) -> str:
    """The pattern of byte-level tokenizers for three classes of characters."""
    return rf"'(?:[stmd]|re|ve|ll)| ?(?:{letter}+|{number}+|{other}+)|\s+(?!\S)|\s+"


class Splitter:
    """Cuts texts into pieces.

    The standard library's engine is the fastest but knows no classes of
    letters and numbers, so it serves texts whose characters it sorts alike.
    """

    def __init__(self) -> None:
        newer = "".join(f"\\U{low:08X}-\\U{high:08X}" for low, high in NEWER)
        alike = "".join(
            f"\\u{c:04x}" for c in range(0x600)
            if not 0x1C <= c <= 0x1F and unicodedata.category(chr(c)) not in ("No", "Nl", "Cn"))
        east = "\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
        self.unlike = re.compile(f"[^{alike}{east}]")
        self.newer = re.compile(f"[{newer}]")
        self.fast = re.compile(pattern_of(r"[^\W\d_]", r"\d", r"(?:[^\s\w]|_)"))
        self.full = regex.compile(pattern_of(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"))
        self.exact = regex.compile("(?V1)" + pattern_of(
            rf"[\p{{L}}--[{newer}]]", rf"[\p{{N}}--[{newer}]]",
            rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]"))

    def pieces(self, text: str) -> list[str]:
        if self.unlike.search(text) is None:
            return self.fast.findall(text)
        return (self.full if self.newer.search(text) is None else self.exact).findall(text)


def byte_letters() -> dict[str, int]:
    """Character that vocabulary files write for each byte, inverted.

    Printable Latin-1 characters stand for themselves, the other bytes for the
    code points from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pieces(dict):
    """Value of each recent piece; computes missing ones and stays bounded.

    When the table is full it becomes the older generation and a new one
    starts. Pieces met again move over, so frequent ones are never computed
    twice while rare ones are forgotten.
    """

    def __init__(self, compute: Callable[[str], bytes]):
        super().__init__()
        self.compute = compute
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        value = self.older.pop(piece, None)
        if value is None:
            value = self.compute(piece)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


@dataclass(frozen=True)
class Tables:
    """A tokenizer file's content, packed: what a worker needs and no more."""

    merges: bytes
    ids: bytes
    spelled: tuple[bytes, bytes]
    byte_ids: tuple[int, ...]
    special: tuple[tuple[str, int], ...]


class Vocabulary:
    """Tables of a byte-level BPE tokenizer, ready for lookups."""

    def __init__(self, tables: Tables):
        ids, ends = np.frombuffer(tables.ids, "<u4").tolist(), np.frombuffer(tables.spelled[1], "<u4").tolist()
        self.spelled: dict[int, bytes] = {
            number: tables.spelled[0][start:end] for number, start, end in zip(ids, [0, *ends], ends)}
        self.byte_ids = list(tables.byte_ids)
        left, right, self.merged = np.frombuffer(tables.merges, "<u4").reshape(3, -1).tolist()
        self.halves: list[tuple[int, int]] = list(zip(left, right))
        self.ranks: dict[int, int] = {}
        for rank, (x, y) in enumerate(self.halves):
            self.ranks.setdefault(x << 32 | y, rank)
        self.special = dict(tables.special)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None)
        self.pieces = Splitter().pieces
        self.packed = Pieces(lambda piece: pack(self.merge(piece.encode("utf-8", "surrogatepass"))))

    def parts(self, text: str) -> list[str]:
        """Plain stretches at even places, special tokens between them."""
        return self.special_pattern.split(text) if self.special_pattern else [text]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.byte_ids[b] for b in piece]
        size = len(symbols)
        if size < 2:
            return symbols
        ranks, merged = self.ranks, self.merged
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        # An entry is rank * size + place: lowest rank first, then leftmost.
        queue = []
        for place in range(size - 1):
            rank = ranks.get(symbols[place] << 32 | symbols[place + 1])
            if rank is not None:
                queue.append(rank * size + place)
        heapq.heapify(queue)
        while queue:
            rank, place = divmod(heapq.heappop(queue), size)
            follower = after[place]
            if symbols[place] < 0 or follower >= size:
                continue
            if ranks.get(symbols[place] << 32 | symbols[follower]) != rank:
                continue
            symbols[place], symbols[follower] = merged[rank], -1
            after[place] = beyond = after[follower]
            if beyond < size:
                before[beyond] = place
                rank = ranks.get(symbols[place] << 32 | symbols[beyond])
                if rank is not None:
                    heapq.heappush(queue, rank * size + place)
            ahead = before[place]
            if ahead >= 0:
                rank = ranks.get(symbols[ahead] << 32 | symbols[place])
                if rank is not None:
                    heapq.heappush(queue, rank * size + ahead)
        return [symbol for symbol in symbols if symbol >= 0]

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text."""
        out = []
        for place, part in enumerate(self.parts(text or "")):
            if place % 2:
                out.append(pack([self.special[part]]))
            else:
                out.extend(map(self.packed.__getitem__, self.pieces(part)))
        return b"".join(out)

    def decode(self, packed: bytes | None) -> str:
        """Text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        ids = struct.unpack(f"<{len(packed or b'') // 4}I", packed or b"")
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def read_tokenizer(path: str) -> Tables:
    """Tables of a tokenizer file, read on the driver.

    They travel to the executors with the function that uses them: their size
    is the vocabulary's, a few megabytes, whatever the size of the corpus.
    """
    with open(path, encoding="utf-8") as content:
        file = json.load(content)
    cut = file["pre_tokenizer"] or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError("only byte-level tokenizers without a prefix space are supported")
    if file.get("normalizer") or file["model"].get("ignore_merges") or file["model"].get("dropout"):
        raise ValueError("normalizers, ignored merges and dropout are not supported")
    letters = byte_letters()
    ids = file["model"]["vocab"]
    spelled = {
        number: bytes(letters[c] for c in token) for token, number in ids.items() if all(c in letters for c in token)}
    special = {}
    for token in file.get("added_tokens", []):
        if token["lstrip"] or token["rstrip"] or token["single_word"] or not token["content"]:
            raise ValueError("added tokens with stripping or word rules are not supported")
        special[token["content"]] = token["id"]
        spelled[token["id"]] = token["content"].encode()
    merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in file["model"]["merges"]]
    return Tables(
        np.array([
            [ids[left] for left, _ in merges], [ids[right] for _, right in merges],
            [ids[left + right] for left, right in merges]], "<u4").tobytes(),
        np.array(list(spelled), "<u4").tobytes(),
        (b"".join(spelled.values()), np.cumsum([len(x) for x in spelled.values()]).astype("<u4").tobytes()),
        tuple(ids[c] for c, _ in sorted(letters.items(), key=lambda item: item[1])),
        tuple(special.items()),
    )


def encoder(spark: SparkSession, path: str) -> Callable[..., Column]:
    """Column function: text to packed ids under the tokenizer file at ``path``."""
    shared = spark.sparkContext.broadcast(read_tokenizer(path))
    return per_value(lambda: Vocabulary(shared.value).encode, T.BinaryType())


def decoder(spark: SparkSession, path: str) -> Callable[..., Column]:
    """Column function: packed ids to text."""
    shared = spark.sparkContext.broadcast(read_tokenizer(path))
    return per_value(lambda: Vocabulary(shared.value).decode, T.StringType())


def codec(df: DataFrame, path: str, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The kept columns, ``token_ids`` (packed) of the text, and ``decoded``, the text of those ids."""
    shared = df.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def make() -> Callable[[str | None], dict]:
        vocab = Vocabulary(shared.value)

        def one(value: str | None) -> dict:
            packed = vocab.encode(value)
            return {"token_ids": packed, "decoded": vocab.decode(packed)}

        return one

    return mapped_texts(df, text, keep, make, T.StructType([
        T.StructField("token_ids", T.BinaryType()), T.StructField("decoded", T.StringType())]))


def token_count(packed: Column) -> Column:
    """Number of ids in a packed column."""
    return (F.octet_length(packed) / 4).cast("bigint")


def unpacked() -> Callable[..., Column]:
    """Column function: packed ids to an array of longs."""
    return per_value(
        lambda: lambda packed: None if packed is None else list(struct.unpack(f"<{len(packed) // 4}I", packed)),
        T.ArrayType(T.LongType()))
