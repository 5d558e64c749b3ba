"""BPE codec and prefix counts against the tokenizers library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.helpers import ODD_TEXTS, frame, stored
from quotemill.llm import bpe, queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "b", " ", "  ", "\n", "'", "'re", "'s", "'ll", "'v", "'ve", "!", "1", "é", "ß", "日", "🙂", "²", "Ⅷ",
    "<|endoftext|>", "<|endof", "the", " the", "\t", "\x1c", "\xa0", "\U0003d001", "́", "aaaa", "    ", "\r\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(bpe.read_tokenizer(PATH))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def texts(count, seed=5):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 14))) for _ in range(count)]


def test_encoding_and_decoding_equal_the_library(library, vocab):
    for text in [*texts(1500), *ODD_TEXTS]:
        ids = ids_of(library, text)
        packed = vocab.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids
        assert vocab.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_every_token_encodes_to_itself_or_is_unreachable(library, vocab):
    counter = token_counts.PrefixCounter(vocab)
    for number, spelled in list(vocab.spelled.items())[::97]:
        if number in counter.halves:
            assert counter.whole(number) == (vocab.merge(spelled) == [number])


def test_character_classes_equal_the_library(library, vocab):
    splitter = bpe.Splitter()
    for code in [*range(0x20, 0x3000, 7), *[low for low, _ in bpe.NEWER], 0x4E00, 0xAC00, 0x1F600, 0x1E5F9]:
        for text in (f"a{chr(code)}a", f"1{chr(code)}1", f" {chr(code)} "):
            theirs = [text[start:end] for _, (start, end) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert splitter.pieces(text) == theirs


def test_counts_at_every_prefix_equal_the_library(library, vocab):
    counter = token_counts.PrefixCounter(vocab)
    for text in [*texts(300, seed=6), "don't we'll they've it's  \n\n so", "a   b\n\n\nc", None]:
        counts = counter.prefixes(text)
        assert [len(ids_of(library, (text or "")[:p])) for p in range(len(text or "") + 1)] == counts.tolist()


def test_stale_entries_and_ties(library, vocab):
    for text in ("aaaaaaaaaaaaa", "ababababab", "thethethethe", "........", "0000000000"):
        packed = vocab.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids_of(library, text)


def test_full_table_of_pieces_is_dropped_not_wrong(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    small = bpe.Vocabulary(bpe.read_tokenizer(PATH))
    for text in texts(50, seed=7):
        assert len(small.encode(text)) == 4 * len(ids_of(library, text))
        assert len(small.packed) <= 3 and len(small.packed.older) <= 3


def test_unsupported_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))


def test_budgets_are_answered_from_the_counts(spark, library):
    text = "The quick brown fox doesn't jump over   the lazy dog.\n" * 5
    count = token_counts.prefix_counter(spark, PATH, budgets=[0, 1, 7, 1000], keep_prefixes=True)
    row = frame(spark, [text]).select(count("text").alias("c")).first().c
    fits = [max(p for p in range(len(text) + 1) if len(ids_of(library, text[:p])) <= b) for b in (0, 1, 7, 1000)]
    assert row.cuts == fits
    assert len(row.prefixes) == 4 * (len(text) + 1)
    with pytest.raises(ValueError):
        token_counts.prefix_counter(spark, PATH, budgets=[-1])


def test_unpacked_ids(spark, library):
    encode = bpe.encoder(spark, PATH)
    rows = frame(spark, ["The fox", None]).select(bpe.unpacked()(encode("text")).alias("ids")).collect()
    assert [row.ids for row in rows] == [ids_of(library, "The fox"), []]


def check_queries(spark, library, folder, rows):
    counted = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op9_token_counts(spark, folder).collect()}
    coded = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
             for r in queries.op10_bpe_codec(spark, folder).collect()}
    for number, text in rows:
        ids = ids_of(library, text)
        assert (number, len((text or "").encode()), len(ids), len(ids) > 512) in counted
        packed = struct.pack(f"<{len(ids)}I", *ids)
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert (number, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()) in coded


def test_queries_equal_the_library(spark, library, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_queries(spark, library, sf_dir, rows)


def test_queries_on_odd_texts(spark, library, tmp_path):
    clashing = frame(spark, ODD_TEXTS).withColumns({"ids": F.lit(1), "n_tokens": F.lit("x"), "counts": F.lit(None)})
    check_queries(spark, library, stored(clashing, tmp_path), list(enumerate(ODD_TEXTS)))


@pytest.mark.parametrize("name", ["op9_token_counts", "op10_bpe_codec"])
def test_empty_table(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, stored(frame(spark, []), tmp_path)).count() == 0
