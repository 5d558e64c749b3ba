"""The pipeline against a plain composition of its decisions."""

import hashlib
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm.helpers import ODD_TEXTS, brute_components, frame, stored, words
from quotemill.llm import mixing, quality


def written(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def stages(spark, docs, sf_dir, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), folder, name))
    return out


def trimmed(line):
    return line.strip(" \t\n\x0b\x0c\r")


def clean(rows):
    """Texts without lines on ten sources or more; whole if no line is left and the text stands twice."""
    sites, times = {}, Counter(row.text for row in rows)
    for row in rows:
        for line in (row.text or "").split("\n"):
            if row.source is not None:
                sites.setdefault(trimmed(line), set()).add(row.source)
    out = {}
    for row in rows:
        lines = (row.text or "").split("\n")
        hit = [bool(trimmed(line)) and len(sites.get(trimmed(line), ())) >= 10 for line in lines]
        copy = times[row.text] > 1 and sum(hit) == sum(bool(trimmed(line)) for line in lines)
        whole = not any(hit) or copy
        out[row.doc_id] = row.text if whole else "\n".join(line for line, h in zip(lines, hit) if not h)
    return out


def readings(rows):
    """Copies of each document in the mix."""
    sizes = Counter()
    for row in rows:
        sizes[row.source] += len(words(row.text))
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    targets = dict(zip(names, mixing.quotas([sizes[n] for n in names], [k % 3 + 1 for k in range(len(names))])))
    out = {}
    for name in names:
        whole, rest = divmod(round(targets[name]), sizes[name]) if sizes[name] else (0, 0)
        group = []
        for row in rows:
            if row.source == name:
                size = len(words(row.text))
                rank = hashlib.md5(f"{mixing.SEED}:{row.doc_id}:{size}".encode()).hexdigest()
                buckets = max(1, -(-sum(r.source == name for r in rows) // mixing.BUCKET_ROWS))
                group.append((int(rank[:8], 16) % buckets, rank, row.doc_id, size))
        before = 0
        for _, _, number, size in sorted(group):
            out[number] = (whole + (rest > 0 and before + size / 2 <= rest)) if size else 0
            before += size
    return out


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return stages(spark, docs, sf_dir, tmp_path_factory.mktemp("pipeline"))


def test_stage_names_and_columns(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mix", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(df.schema == results[0].schema for df in results[1:-1])


def test_quality_stage(spark, sf_dir, results):
    rows = results[0].collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(results[0].select("doc_id", "text"), labels)
    sizes = quality.Sizes(model.good, model.bad)
    kept = {r.doc_id for r in rows if quality.probability(sizes.features(r.text), model.weights) >= 0.5}
    assert {r.doc_id for r in results[1].collect()} == kept
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([(r.doc_id in kept) == (known[r.doc_id] == 1) for r in rows if r.doc_id in known]) > 0.95


def test_line_stage(results):
    rows = results[1].collect()
    out = results[2].collect()
    assert {r.doc_id: r.text for r in out} == clean(rows)
    assert all(r.n_chars == len(r.text) for r in out)


def test_near_duplicate_stage(results):
    rows = results[2].collect()
    expected = brute_components([(r.doc_id, r.text) for r in rows])
    assert sorted(r.doc_id for r in results[3].collect()) == sorted(set(expected))


def test_mix_stage(results):
    rows = results[3].collect()
    expected = {number: times for number, times in readings(rows).items() if times}
    assert Counter(r.doc_id for r in results[4].collect()) == Counter(expected)


def test_token_stage(results):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in results[4].collect()}
    rows = results[5].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in results[4].collect())
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.round_trip and row.n_tokens == len(ids)
        assert bytes(row.token_ids) == struct.pack(f"<{len(ids)}I", *ids)


def test_run_equals_its_stages(spark, sf_dir, results):
    ours = Counter((r.doc_id, bytes(r.token_ids)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert ours == Counter((r.doc_id, bytes(r.token_ids)) for r in results[5].collect())


def test_copies_go_and_clean_documents_stay(spark, sf_dir, tmp_path):
    base = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars > 2000").limit(30).collect()]
    near = [text.replace(" the ", " that ", 1) for text in base[:10]]
    texts = base[:10] + near + base[:10]
    docs = frame(spark, texts, [f"s{k}" for k in range(30)])
    stay = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()}
    assert stay == set(brute_components(list(enumerate(texts))))


def test_stages_on_odd_and_empty_tables(spark, sf_dir, tmp_path):
    odd = frame(spark, ODD_TEXTS * 2, ids=[k if k % 4 else None for k in range(2 * len(ODD_TEXTS))])
    odd = odd.withColumns({"score": F.lit("x"), "node": F.lit(1), "size": F.lit(None).cast("int"), "label": F.lit(2)})
    for number, docs in enumerate((odd, odd.limit(0))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, docs, sf_dir), tmp_path, f"{number}-{name}")
            assert out.columns == docs.columns
            assert out.count() <= docs.count() * 3
        stored(docs, tmp_path, f"odd{number}")
        assert corpus_pipeline.encode_tokens(spark, docs, sf_dir).count() == docs.count()
