"""The Merkle manifest against a plain tree, on odd rows and with split trees."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm.helpers import LOWER, ODD_TEXTS, frame, stored
from quotemill.llm import merkle
from quotemill.llm.queries import QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root and, for every node, the siblings left and right of it on each level."""
    paths = [[] for _ in nodes]
    members = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for start in range(0, len(nodes), 16):
            run = nodes[start:start + 16]
            for slot in range(len(run)):
                for k in members[start + slot]:
                    paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            above.append(h(*run))
            joined.append([k for part in members[start:start + 16] for k in part])
        nodes, members = above, joined
    return nodes[0], paths


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row.source, []).append(row)
    names = sorted(by_source, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in names:
        own = sorted(by_source[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[name] = (own, *tree([leaf_of(r, r.text) for r in own]))
    root, tops = tree([trees[name][1] for name in names])
    out = []
    for name, top in zip(names, tops):
        own, subroot, paths = trees[name]
        for row, path in zip(own, paths):
            path = path + top
            hit = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
            seen = row.text.translate(LOWER) if hit and row.text is not None else row.text
            node = leaf_of(row, seen)
            for left, right in path:
                node = h(left, node, right)
            proof = h(*(part for step in path for part in step))
            out.append((row.doc_id, leaf_of(row, row.text), subroot, root, proof, node, node == root))
    return out


def found(spark, docs, folder):
    df = QUERIES["op11_merkle"](spark, stored(docs, folder))
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(row) for row in df.collect()]


def odd_documents(spark):
    # A hot source, sources of 1, 16, 17, 256 and 257 leaves, a null and an empty one, more sources than a run.
    sources = ["hot"] * 600 + [None] * 40 + [""] * 16 + ["é"] * 17 + ["one"] + ["a"] * 256 + ["b"] * 257
    sources += [f"s{k}" for k in range(30)]
    texts = [(ODD_TEXTS + ["Upper CASE Text É"])[k % (len(ODD_TEXTS) + 1)] for k in range(len(sources))]
    return frame(spark, texts, sources).withColumns({
        "tree": F.lit(1), "pos": F.lit("x"), "hash": F.lit(None).cast("int"), "a.b": F.lit(2)})


def test_manifest_equals_a_plain_tree(spark, tmp_path):
    docs = odd_documents(spark)
    ours = found(spark, docs, tmp_path)
    assert Counter(ours) == Counter(expected(docs.collect()))
    broken = [row for row in ours if not row[-1]]
    assert broken and all(zlib.crc32(str(row[0]).encode()) % 5 == 0 for row in broken)


@pytest.mark.parametrize("span, rows", [(16, 2_000_000), (4096, 2_000_000), (256, 50)])
def test_blocks_and_pieces_do_not_change_the_result(spark, tmp_path, monkeypatch, span, rows):
    monkeypatch.setattr(merkle, "SPAN", span)
    monkeypatch.setattr(merkle, "PIECE_ROWS", rows)
    docs = odd_documents(spark)
    assert Counter(found(spark, docs, tmp_path)) == Counter(expected(docs.collect()))


def test_null_and_repeated_rows(spark, tmp_path):
    docs = frame(spark, ["Aa", "Aa", "Aa", None, None, "b"] * 9, ["x"] * 54, [1, 1, None, None, 7, 1] * 9)
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    assert Counter(found(spark, docs, tmp_path)) == Counter(expected(docs.collect()))


def test_one_row_and_no_row(spark, tmp_path):
    one = frame(spark, ["Text"], ["x"], [10])
    (row,) = found(spark, one, tmp_path)
    assert row[1] == row[2] == row[3] and row[4] == h("")
    assert found(spark, one.limit(0), tmp_path) == []


def test_other_columns_serve_as_tree_and_order(spark):
    docs = spark.createDataFrame([(k, f"t{k}", f"g{k % 2}") for k in range(40)], "`n.o` int, body string, grp string")
    out = merkle.manifest(docs, ["n.o", "body"], tree_col="grp", order_col="n.o", seen={"body": F.lit("x")},
                          when=F.col("`n.o`") == 3).collect()
    assert [r["n.o"] for r in out if not r.verified] == [3]
    assert len({r.root for r in out}) == 1 and len({r.subroot for r in out}) == 2
