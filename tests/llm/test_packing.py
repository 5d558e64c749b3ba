"""Packing: ids against the library, pieces against the whole, BM25 against its formula."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.helpers import ODD_TEXTS, frame, stored
from quotemill.llm import packing, word_ids
from quotemill.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ODD_TEXTS + [
    "á ́b é x y　z\u0085w v", "I'll don't WE'VE 'S O'Re 12³ ٣४ ǅ ß İstanbul ΑΣ ΑΣ.",
    "<|startoftext|> x<|endoftext|>y <|ENDOFTEXT|> <|endof text|>", "\x00 \x1c\x1d\x1e\x1f \x7f ﻿ ​‍",
    "日本語 テキスト 한국어 👩‍👩‍👧 ﬁ ﷺ", "...!!! ---- $$$ a.b,c;d", "'s't're", " ' s ", "\r\n\r\n a\vb\fc"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(rows, texts, library, sequence=4096):
    """Every id once, gapless sequences, and padding only where a sequence is no power of two."""
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_document[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert set(by_document) == set(texts)
    for number, pieces in by_document.items():
        ids = ids_of(library, texts[number])
        place = 0
        for piece in sorted(pieces, key=lambda p: p.start):
            assert piece.start == place and piece.length > 0 and piece.doc_tokens == len(ids)
            part = ids[place:place + piece.length]
            assert piece.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            place += piece.length
        assert place == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        place = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == place
            place += piece.length
        assert place <= sequence
        padding += 0 if place & (place - 1) == 0 else sequence - place
    assert padding == 0
    return by_sequence


def test_query_on_the_documents(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    df = QUERIES["op12_packing"](spark, sf_dir)
    assert df.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
                         ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]
    found = check_pieces(df.collect(), texts, library)
    sizes = [sum(p.length for p in pieces) for pieces in found.values()]
    assert sum(size == 4096 for size in sizes) >= sum(sizes) // 4096 - 2


def test_words_encode_alone_and_odd_rows(spark, tmp_path, monkeypatch, library):
    monkeypatch.setattr(packing, "HELD_BYTES", 900)
    # Every code point beside a blank, between letters and after another of its kind.
    every = [chr(k) for k in range(0x3000) if not 0xD800 <= k < 0xE000]
    texts = ODD + ["".join(f" {c}a{c}{c} " for c in every[k:k + 256]) for k in range(0, len(every), 256)]
    docs = frame(spark, texts).withColumns({"ids": F.lit("x"), "row": F.lit(1), "key": F.lit(2), "a.b": F.lit(0)})
    rows = QUERIES["op12_packing"](spark, stored(docs, tmp_path)).collect()
    check_pieces(rows, dict(enumerate(texts)), library)


def test_plain_texts_encode_as_the_library_does(library):
    draw = random.Random(13)
    signs = [chr(k) for k in [*range(9, 14), *range(32, 127), *range(0xA1, 0x100)]]
    texts = [f"{a}{b}a {a}'{b}" for a in signs for b in draw.sample(signs, 12)]
    for size in (1, 3, 8, 30, 200):
        texts += ["".join(draw.choices(signs, k=size)) for _ in range(300)]
        texts += ["".join(draw.choices("aeEéÉßs't 1.,-\n", k=size)) for _ in range(300)]
    assert all(word_ids.PLAIN.fullmatch(text) for text in texts)
    encode = word_ids.Words(word_ids.library(open(WORDS, encoding="utf-8").read()), "<u2")
    found = encode([*texts, "", "  ", "x<|endoftext|>", "日"])
    expected = [library.encode(text, add_special_tokens=False).ids for text in [*texts, "", "  ", "x<|endoftext|>", "日"]]
    assert [list(np.frombuffer(ids, "<u2")) for ids in found] == expected
    assert encode([]) == [] and encode(["", ""]) == [b"", b""]
    with pytest.raises(ValueError):
        word_ids.Words(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), "<u2")


def test_null_ids_repeated_rows_and_no_rows(spark, tmp_path):
    docs = frame(spark, ["same words here"] * 50 + [None] * 30, ids=[None] * 80)
    rows = QUERIES["op12_packing"](spark, stored(docs, tmp_path)).collect()
    assert sum(r.start == 0 for r in rows) == 80
    assert sum(r.length for r in rows) == 50 * 4 + 30
    assert QUERIES["op12_packing"](spark, stored(docs.limit(0), tmp_path)).collect() == []


def test_hot_keys_and_long_texts_are_spread(spark, monkeypatch):
    draw = random.Random(5)
    texts = ["alpha beta gamma delta"] * 3000 + ["word " * 30_000] + [
        " ".join(draw.choice(["red", "green", "blue", "cat", "dog", "bird"]) for _ in range(60)) for _ in range(300)]
    found = packing.corpus(frame(spark, texts), WORDS, 2, by_word=True)
    rows = packing.pack(found, sequence=64, shard_tokens=2000).collect()
    assert sum(r.length for r in rows) == sum(len(t.split()) + 1 for t in texts)
    shards = Counter()
    for row in rows:
        shards[row.sequence_id >> 32] += row.length
    copies = Counter(r.sequence_id >> 32 for r in rows if r.id < 3000)
    assert len(copies) >= 5 and max(copies.values()) < 1000
    assert sorted(shards.values())[-2] <= 2 * 2000 + 64


def test_any_tokenizer_encodes_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    found = packing.corpus(frame(spark, ODD), path, 0)
    ids = {r.id: list(np.frombuffer(bytes(r.ids), dtype=found.width)) for r in found.tokens.collect()}
    assert ids == {k: [*other.encode(text or "", add_special_tokens=False).ids, 0] for k, text in enumerate(ODD)}


def bm25(documents, weights, mean, seed):
    scores = []
    for ids in documents:
        times, length = Counter(ids[:-1].tolist()), len(ids) - 1
        drag = 1.2 * (0.25 + 0.75 * length / mean)
        scores.append(sum(
            weights[t] * times[t] * 2.2 / (times[t] + drag) for t in set(documents[seed][:-1].tolist()) if times[t]))
    return scores


def test_index_ranks_by_bm25():
    draw = random.Random(7)
    documents = [np.array([draw.randrange(30) for _ in range(draw.randint(1, 40))] + [2]) for _ in range(60)]
    weights = np.array([math.log(2 + draw.random() * 5) for _ in range(40)])
    index = packing.Index(documents, weights, 17.0)
    for seed in range(60):
        unused = np.array([draw.random() < 0.7 for _ in documents])
        scores = bm25(documents, weights, 17.0, seed)
        ranked = index.ranked(seed, unused).tolist()
        assert set(ranked) == {k for k in range(60) if unused[k] and scores[k] > 0}
        assert all(scores[a] >= scores[b] - 1e-9 for a, b in zip(ranked, ranked[1:]))


def test_counts_cover_all_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packing.corpus(docs, WORDS, 2, by_word=True)
    holders, terms = Counter(), 0
    rows = docs.collect()
    for row in rows:
        ids = ids_of(library, row.text)[:-1]
        holders.update(set(ids))
        terms += len(ids)
    assert {k: int(n) for k, n in enumerate(found.holders) if n} == dict(holders)
    assert found.documents == len(rows) and math.isclose(found.mean, terms / len(rows))


def test_neighbours_share_a_sequence_more_than_chance(spark):
    draw = random.Random(11)
    topics = [[f"{chr(97 + k)}{chr(97 + j)}x{chr(97 + (k * j) % 26)}" for j in range(26)] for k in range(12)]
    texts = [" ".join(draw.choice(topics[k % 12]) for _ in range(40)) for k in range(600)]
    rows = packing.pack(packing.corpus(frame(spark, texts), WORDS, 2, by_word=True), sequence=512).collect()
    by_sequence = defaultdict(set)
    for row in rows:
        by_sequence[row.sequence_id].add(row.id % 12)
    full = [kinds for number, kinds in by_sequence.items()]
    # Dealt at random, nearly every sequence would hold four topics or more.
    assert sum(len(kinds) <= 2 for kinds in full) > 0.8 * len(full)
