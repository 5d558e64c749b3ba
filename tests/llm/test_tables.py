"""Operators that move rows between tasks, against plain references on small tables."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import ODD_TEXTS, brute_components, frame, shingle_set, stored, words
from quotemill.llm import bit_slices, line_dedup, mixing, near_dups, quality, queries
from quotemill.llm.sql import SQL

QUALITY = "doc_id bigint, quality int"


def plain(rows):
    return Counter(tuple(row) for row in rows)


def against_sql(spark, name, folder, tables):
    db = duckdb.connect()
    for table in tables:
        path = f"{folder}/{table}.parquet"
        spark_folder = not path_is_file(path)
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}{'/*.parquet' if spark_folder else ''}'")
    ours = queries.QUERIES[name](spark, folder)
    theirs = db.sql(SQL[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = theirs.select(", ".join(columns)).fetchall()
    assert plain(ours.select(*columns).collect()) == Counter(map(tuple, rows))


def path_is_file(path):
    import os
    return os.path.isfile(path)


# Lines by distinct sites.

def test_lines_against_sql(spark, sf_dir):
    against_sql(spark, "op4_line_spread", sf_dir, ["documents"])


def test_lines_near_the_threshold_and_odd_texts(spark, tmp_path):
    draw = random.Random(1)
    texts, sources = [], []
    for number in range(300):
        lines = [f"own line {number} {draw.random()} with some more words so that it weighs enough here"] * 2
        # Shared line k stands on k sites.
        lines += [f"shared {k}" for k in range(8, 13) if number < 200 and number % 20 < k and draw.random() < 0.9]
        draw.shuffle(lines)
        texts.append("\n".join(lines))
        sources.append(f"s{number % 20}" if number % 37 else None)
    texts += ODD_TEXTS + [ODD_TEXTS[-1]] * 3 + ["hot"] * 150
    sources += [f"s{k % 20}" for k in range(len(texts) - len(sources))]
    docs = frame(spark, texts, sources).withColumns({"id": F.lit(1), "h1": F.lit("x"), "numbers": F.lit(None).cast("int")})
    folder = stored(docs, tmp_path)
    against_sql(spark, "op4_line_spread", folder, ["documents"])


def test_clean_text_keeps_other_columns(spark):
    texts = ["banner\n" + f"text number {k} with enough words of its own to stay a text" for k in range(30)]
    docs = frame(spark, texts, [f"s{k}" for k in range(30)]).withColumn("site", F.lit(7))
    out = line_dedup.with_clean_text(docs)
    assert out.columns == docs.columns
    assert {r.text for r in out.collect()} == {t.split("\n")[1] for t in texts}


def test_copies_stay_whole_and_marked(spark):
    same = "first line of a copied text\nsecond line of it"
    docs = frame(spark, [same] * 12 + ["other"], [f"s{k}" for k in range(13)])
    rows = line_dedup.without_boilerplate(docs).collect()
    assert all(r.is_copy and r.n_removed == 0 and r.n_boilerplate == 2 for r in rows if r.doc_id < 12)
    assert {r.text for r in rows} == {same, "other"}


def test_only_proven_copies_stay_whole(spark):
    """Boilerplate goes from short texts too, and from a lone text that has nothing else."""
    notice = "a long shared notice of many more words than the page that carries it has of its own"
    texts = [f"own words {k}\n{notice}" for k in range(20)] + [notice, f"{notice}\n\n{notice}", "lone", notice + "\n"]
    rows = line_dedup.without_boilerplate(frame(spark, texts, [f"s{k}" for k in range(24)])).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [f"own words {k}" for k in range(20)] + ["", "", "lone", ""]
    assert not any(r.is_copy for r in rows)
    twice = frame(spark, [*texts, notice], [f"s{k}" for k in range(25)])
    found = {r.doc_id: r for r in line_dedup.without_boilerplate(twice).collect()}
    assert [number for number, r in found.items() if r.is_copy] == [20, 24] and found[24].text == notice


def test_many_boilerplate_lines_of_one_text(spark):
    shared = [f"line {k} of a very long page" for k in range(30_000)]
    texts = ["\n".join(["top", *shared, f"end {k}"]) for k in range(10)]
    rows = line_dedup.with_clean_text(frame(spark, texts, [f"s{k}" for k in range(10)])).collect()
    assert {r.text for r in rows} == {f"end {k}" for k in range(10)}


def test_names_with_dots_and_own_names(spark):
    docs = frame(spark, ["both\nx1", "both\nx2", "both"] * 6, [f"s{k}" for k in range(18)]).withColumns({
        "a.b": F.lit(1), "t1": F.lit("x"), "is_copy": F.lit(None).cast("int")})
    out = line_dedup.with_clean_text(docs.withColumnRenamed("text", "the.text"), text_col="the.text")
    assert out.columns == [c if c != "text" else "the.text" for c in docs.columns]
    assert sorted(r["the.text"] for r in out.collect()) == ["both"] * 6 + ["x1"] * 6 + ["x2"] * 6


def test_line_plan_is_native(spark, sf_dir):
    plan = queries.op4_line_spread(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert slow not in plan


# Exact top k.

def brute_top(rows, k, every=50):
    kept = {}
    for number, vector in rows:
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        kept[number, tuple(int(np.floor(256 * float(x))) for x in vector)] = number
    out = set()
    for (own, query) in kept:
        if own % every:
            continue
        found = sorted(
            (-sum(a * b for a, b in zip(query, other)), number) for (number, other) in kept if number != own)
        out |= {(own, rank + 1, number, -score) for rank, (score, number) in enumerate(found[:k])}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_top_k_against_sql(spark, sf_dir):
    against_sql(spark, "op5_top_k", sf_dir, ["embeddings"])


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 40, "chunk_queries": 3}])
def test_top_k_with_ties_nulls_and_lengths(spark, blocks):
    draw = random.Random(2)
    rows = [(k, [draw.choice([-1.5, -0.25, 0.0, 0.25, 3.0]) for _ in range(4)]) for k in range(200)]
    rows += [(1000, None), (1050, [None, 1.0, 1.0, 1.0]), (1100, [float("nan")] * 4), (1150, [float("inf")] * 4)]
    rows += [(1200, []), (1201, [1.0]), (1250, [2.0, 2.0]), rows[50], rows[50], rows[3]]
    found = bit_slices.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, **blocks).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == brute_top(rows, 5)
    assert len(found) == len(set(found))


def test_top_k_keeps_large_components(spark, tmp_path):
    draw = random.Random(16)
    sizes = [0.5, 3.0, 262_144.0, -262_144.0, 1e6, -3e5, 1e7]
    rows = [(k, [draw.choice(sizes) for _ in range(3)]) for k in range(120)]
    rows += [(200, [2.0 ** 22, 1.0, 0.0]), (201, [-2.0 ** 22, 0.25, 1.0]), (250, [0.0, 1.0, 0.0]), (300, [float("inf")] * 3)]
    found = bit_slices.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == brute_top(rows, 5)
    # The contract's SQL sums in 64 bits and keeps the same vectors.
    folder = stored(vectors(spark, rows[:120]), tmp_path, "embeddings")
    against_sql(spark, "op5_top_k", folder, ["embeddings"])


def test_scores_are_exact_or_an_error():
    values = np.array([[2**62, -2**62], [-2**63, 2**63 - 1], [2**62, -2**62 + 1], [5, 3]])
    block = bit_slices.Block.of(np.arange(4), values)
    ids, scores = block.best(9, np.array([1, 1]), 4)
    assert list(zip(ids.tolist(), scores.tolist())) == [(3, 8), (2, 1), (0, 0), (1, -1)]
    with pytest.raises(OverflowError):
        block.best(9, np.array([4, 0]), 1)


def test_components_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="does not fit 64 bits"):
        bit_slices.top_k(vectors(spark, [(0, [1e30]), (1, [1.0])]), F.col("vec_id") % 50 == 0, 5).collect()


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, [1.0]), (1, [0.5])], [(k, [0.0, 0.0]) for k in range(101)]])
def test_top_k_of_few_or_equal_rows(spark, rows):
    found = bit_slices.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5)
    assert {tuple(r) for r in found.collect()} == brute_top(rows, 5)


def test_sliced_sums_equal_integers():
    draw = np.random.default_rng(3)
    values = draw.integers(-700, 700, size=(130, 9))
    block = bit_slices.Block.of(np.arange(130), values)
    for query in draw.integers(-300, 300, size=(20, 9)):
        scores = sum(
            np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << bit
            for bit, s in enumerate(block.score(query)))
        shift = scores - values @ query
        assert (shift == shift[0]).all()


# Quality.

def labelled(n, draw, junk=lambda w: w.upper() + "!!"):
    made = ["".join(draw.choice(["th", "er", "on", "an", "re", "he"]) for _ in range(draw.randint(1, 4))) for _ in range(400)]
    texts, marks = [], []
    for _ in range(n):
        bad = draw.random() < 0.3
        chosen = [draw.choice(made) for _ in range(draw.randint(30, 120))]
        texts.append(" ".join(map(junk, chosen)) if bad else " ".join(chosen))
        marks.append(int(not bad))
    return texts, marks


def test_quality_on_held_out_rows(spark, tmp_path):
    texts, marks = labelled(600, random.Random(5))
    folder = stored(frame(spark, texts), tmp_path)
    stored(spark.createDataFrame(list(enumerate(marks)), QUALITY), tmp_path, "labels")
    rows = {r.doc_id: r for r in queries.op3_quality(spark, folder).collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert [k for k in range(600) if rows[k].held_out] == held
    assert np.mean([rows[k].predicted == marks[k] for k in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    # Labels of held-out rows, and rows' sources and languages, say nothing.
    flipped = [(k, 1 - m if k in set(held) else m) for k, m in enumerate(marks)]
    stored(spark.createDataFrame(flipped, QUALITY), tmp_path, "labels")
    again = {r.doc_id: r.score for r in queries.op3_quality(spark, folder).collect()}
    assert again == {k: r.score for k, r in rows.items()}


@pytest.mark.parametrize("marks", [[], [(k, 1) for k in range(9)], [(0, None), (None, 1), (1, 5), (2, 0), (2, 1)]])
def test_quality_without_two_labels(spark, tmp_path, marks):
    folder = stored(frame(spark, ODD_TEXTS).withColumn("score", F.lit(3)), tmp_path)
    stored(spark.createDataFrame(marks, QUALITY), tmp_path, "labels")
    rows = queries.op3_quality(spark, folder).collect()
    assert len(rows) == len(ODD_TEXTS) and len({r.score for r in rows}) == 1


def test_quality_of_odd_texts_and_empty_table(spark, tmp_path):
    texts, marks = labelled(60, random.Random(6))
    folder = stored(frame(spark, texts + ODD_TEXTS), tmp_path)
    stored(spark.createDataFrame(list(enumerate(marks)), QUALITY), tmp_path, "labels")
    assert all(0 <= r.score <= 1 for r in queries.op3_quality(spark, folder).collect())
    stored(frame(spark, []), tmp_path)
    assert queries.op3_quality(spark, folder).count() == 0


def test_training_sample_is_bounded(spark):
    texts, marks = labelled(200, random.Random(7))
    labels = spark.createDataFrame(list(enumerate(marks)), QUALITY)
    rows, share = quality.training_rows(frame(spark, texts), labels, rows_per_label=10, longest_text=500)
    assert Counter(label for _, label in rows)[1] <= 10 and all(len(text) <= 500 for text, _ in rows)
    assert share == pytest.approx(np.mean(marks))


# Mixing.

def test_quotas_are_capped_and_reshared():
    assert mixing.quotas([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    # The small third source takes at most three times its size; the rest is shared 1 : 2.
    assert mixing.quotas([500, 490, 10], [1, 2, 3]) == pytest.approx([970 / 3, 1940 / 3, 30])
    assert mixing.quotas([], []) == [] and mixing.quotas([0, 5], [1, 1]) == pytest.approx([0, 5])


def cost_of(given, patterns, repeats=3):
    """Repetition cost: 0 for the first reading of a text, then 1, 2, and 3 for all further ones."""
    return sum(max(0, given[key] - r * patterns[key]) for key in patterns for r in range(1, repeats + 1))


def cheapest(patterns, targets, repeats=3):
    """Most flow at least repetition cost, by trying all amounts."""
    import itertools
    best = None
    pairs = [(key, name) for key in patterns for name in key]
    for choice in itertools.product(*[range(repeats * patterns[key] + 1) for key, _ in pairs]):
        got, given = Counter(), Counter()
        for (key, name), amount in zip(pairs, choice):
            got[name] += amount
            given[key] += amount
        if any(got[name] > targets[name] for name in targets):
            continue
        rank = (-sum(got.values()), cost_of(given, patterns))
        best = rank if best is None else min(best, rank)
    return best


def routed(patterns, targets):
    """The flow of patterns with one copy of each text in each of their sources."""
    keys, names = list(patterns), sorted(targets)
    pairs = [(k, names.index(name), patterns[key]) for k, key in enumerate(keys) for name in key]
    amounts = mixing.routed([patterns[key] for key in keys], [targets[name] for name in names], pairs)
    got, given = Counter(), Counter()
    for (k, source, held), amount in zip(pairs, amounts):
        assert 0 <= amount <= 3 * held
        got[names[source]] += amount
        given[keys[k]] += amount
    assert all(got[name] <= targets[name] for name in names)
    return given


def test_flow_is_the_cheapest():
    draw = random.Random(8)
    for _ in range(40):
        patterns = {("a",): draw.randint(0, 3), ("a", "b"): draw.randint(0, 2), ("b",): draw.randint(0, 2)}
        targets = {"a": draw.randint(0, 9), "b": draw.randint(0, 9)}
        given = routed(patterns, targets)
        assert (-sum(given.values()), cost_of(given, patterns)) == cheapest(patterns, targets)


def test_flow_of_a_large_group_ends_soon():
    draw = random.Random(9)
    names = [f"s{k}" for k in range(300)]
    patterns = {tuple(sorted(draw.sample(names, draw.randint(1, 6)))): draw.randint(1, 10**6) for _ in range(5000)}
    total = sum(patterns.values())
    given = routed(patterns, {name: total // 300 for name in names})
    assert sum(given.values()) <= total // 300 * 300


def copies(spark, groups):
    """Rows of (text, sources), one row for each source, every text of ten words."""
    rows, number = [], 0
    for text, sources in groups:
        for source in sources:
            rows.append((number, " ".join([text] * 10), source))
            number += 1
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_the_flow_decides_which_copy_is_read(spark):
    """Source a has fresh text of its own, b has only copies: a leaves the shared texts to b."""
    groups = [(f"both{k}", ["a", "b"]) for k in range(100)] + [(f"own{k}", ["a"]) for k in range(100)]
    docs = copies(spark, groups)
    mix = mixing.Mix(docs, F.col("source"), F.lit(10), F.col("text"), weight=F.lit(1))
    targets = {r.source: r.target for r in mix.sources.collect()}
    assert targets == pytest.approx({"a": 1500, "b": 1500})
    read = Counter()
    for r in mix.readings(docs, "n").collect():
        read[r.text.split()[0], r.source] += r.n
        assert 0 <= r.n <= 3
    shared_by_a = sum(n for (text, source), n in read.items() if source == "a" and text.startswith("both"))
    got = {name: 10 * sum(n for (_, source), n in read.items() if source == name) for name in "ab"}
    assert got == {"a": 1500, "b": 1500}
    # 3000 words of 2000 fresh ones: at best every text is read and a third of the words repeat. Sources go around
    # the shared texts one after another, by hash, which is not exact to the text.
    per_text = Counter()
    for (text, _), n in read.items():
        per_text[text] += n
    assert 1000 <= cost_of({t: 10 * n for t, n in per_text.items()}, {t: 10 for t in per_text}) <= 1100
    # Each for itself, a would read half of its shared and half of its own texts, and b all of its own once and more.
    assert shared_by_a < 60


def test_sources_without_overlap_are_decided_in_closed_form(spark):
    docs = copies(spark, [(f"t{k}", [f"s{k % 7}"]) for k in range(700)])
    mix = mixing.Mix(docs, F.col("source"), F.lit(10), F.col("text"))
    assert mix.shared.isEmpty()
    got = {r.source: r.n for r in mix.readings(docs, "n").groupBy("source").agg(F.sum(10 * F.col("n")).alias("n")).collect()}
    targets = dict(zip(sorted(got), mixing.quotas([1000] * 7, [1, 2, 3, 1, 2, 3, 1])))
    assert all(abs(got[name] - target) <= 5 for name, target in targets.items())


def test_mix_of_very_many_sources(spark):
    """A million sources, each a table row; the driver holds none of them."""
    n = 1_000_000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("source"),
        F.col("id").cast("string").alias("text"))
    mix = mixing.Mix(docs, F.col("source"), F.lit(12), F.col("text"))
    found = mix.readings(docs, "n").join(mix.sources, "source")
    rows, sources, off = found.agg(
        F.count(F.lit(1)), F.count_distinct("source"), F.max(F.abs(12 * F.col("n") - F.col("target")))).first()
    assert (rows, sources) == (n, n) and off <= 6.5
    # Weights 1, 2, 3 in turn over a mean of 2.
    assert mix.sources.agg(F.sum("target")).first()[0] == pytest.approx(12 * n)


def test_readings_replace_a_column_of_their_name(spark):
    docs = copies(spark, [("x", ["a"]), ("y", ["a"])]).withColumns({"n": F.lit("old"), "a.b": F.lit(1), "edge": F.lit(2)})
    out = mixing.Mix(docs, F.col("source"), F.lit(10), F.col("text")).readings(docs, "n")
    assert sorted(out.columns) == sorted(docs.columns) and {r.n for r in out.collect()} == {1}


def check_mix(rows, n_rows, pairs=1):
    """Sums by source; ``pairs`` sets of copies have no other text in the source to make good what they miss."""
    assert len(rows) == n_rows
    by_source = {}
    for r in rows:
        assert r.size == 0 and r.taken == 0 or r.taken % r.size == 0 and r.taken <= 3 * r.size
        by_source.setdefault((r.source_size, r.target), []).append(r)
    largest = max((r.size for r in rows), default=0)
    for (source_size, target), group in by_source.items():
        assert target <= 3 * source_size + 1e-6
        assert abs(sum(r.taken for r in group) - target) <= pairs * largest / 2 + 1


def test_mix_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op7_source_mix(spark, sf_dir).collect()
    check_mix(rows, docs.count())
    sizes = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == sizes
    assert sum({(r.source_size, r.target) for r in rows} and [r.size for r in rows]) == sum(sizes.values())
    assert plain(queries.op7_source_mix(spark.newSession(), sf_dir).collect()) == plain(rows)


def test_mix_of_skewed_null_and_repeated_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    texts = ["word " * (k % 17 + 1) for k in range(900)] + ODD_TEXTS + ["same same"] * 5
    sources = ["hot" if k % 3 else ["a", "b", None, "Z"][k % 4] for k in range(len(texts))]
    ids = [k if k < 900 else None for k in range(len(texts))]
    docs = frame(spark, texts, sources, ids).withColumns({"size": F.lit("x"), "members": F.lit(1), "readings": F.lit(0)})
    folder = stored(docs, tmp_path)
    rows = queries.op7_source_mix(spark, folder).collect()
    # All but a few texts stand in several sources.
    check_mix(rows, len(texts), pairs=10)
    expected = Counter()
    for text, source in zip(texts, sources):
        expected[source] += len(words(text))
    assert Counter(r.source_size for r in rows) == Counter(expected[source] for source in sources)
    names = sorted((s for s in expected if s is not None)) + [None]
    targets = dict(zip(names, mixing.quotas([expected[n] for n in names], [1, 2, 3, 1, 2])))
    assert {round(r.target, 6) for r in rows} == {round(t, 6) for t in targets.values()}


def test_mix_of_nothing(spark, tmp_path):
    assert queries.op7_source_mix(spark, stored(frame(spark, []), tmp_path)).count() == 0
    rows = queries.op7_source_mix(spark, stored(frame(spark, [None, ""]), tmp_path)).collect()
    assert [(r.size, r.taken) for r in rows] == [(0, 0)] * 2


# Near duplicates.

def variants(draw, base, count, edits):
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = f"w{draw.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


def near_texts(draw):
    texts = []
    for size, count, edits in ((60, 40, 4), (120, 60, 8), (30, 10, 2), (400, 6, 20)):
        texts += variants(draw, [f"b{draw.randrange(10_000)}" for _ in range(size)], count, edits)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} " + " ".join(f"q{draw.randrange(10_000)}" for _ in range(draw.randint(5, 60))) for _ in range(60)]
    texts += ["exact copy of one text in many rows"] * 30 + ["Exact  COPY of one\ttext in many rows", "a b c", "A b C", "a b c d"]
    return texts + ODD_TEXTS


@pytest.mark.parametrize("work, block", [(near_dups.WORK, near_dups.BLOCK), (40, 7)])
def test_components_equal_comparing_all_pairs(spark, tmp_path, monkeypatch, work, block):
    monkeypatch.setattr(near_dups, "WORK", work)
    monkeypatch.setattr(near_dups, "BLOCK", block)
    texts = near_texts(random.Random(9))
    random.Random(10).shuffle(texts)
    docs = frame(spark, texts).withColumns({"node": F.lit(1), "label": F.lit("x"), "kept": F.lit(2)})
    folder = stored(docs, tmp_path)
    rows = {r.doc_id: r for r in queries.op8_near_duplicates(spark, folder).collect()}
    expected = brute_components(list(enumerate(texts)))
    assert [rows[k].component_id for k in range(len(texts))] == expected
    assert [rows[k].n_shingles for k in range(len(texts))] == [len(shingle_set(text)) for text in texts]
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_a_pair_whose_only_common_band_is_a_wide_bucket_is_linked(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "WORK", 0)
    monkeypatch.setattr(near_dups, "PIVOTS", 0)
    draw = random.Random(14)
    pair = [f"b{k}" for k in range(100)]
    texts = [" ".join(pair), " ".join([*pair[:-2], "x", "y"])]
    texts += [" ".join(f"w{draw.randrange(10**6)}" for _ in range(100)) for _ in range(40)]
    sign = near_dups.signatures()
    docs = frame(spark, texts)
    signed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), sign("text").alias("s"))
    # All share the first band and no other.
    own = F.transform(F.sequence(F.lit(2), F.lit(near_dups.BANDS)), lambda band: 100 * (F.col("doc_id") + 1) + band)
    reps = signed.select(
        "text_hash", "s.node", F.col("s.n_shingles").alias("n"), "s.planes",
        F.concat(F.array(F.lit(1).cast("bigint")), own).alias("bands")).localCheckpoint()
    nodes = [r.node for r in signed.orderBy("doc_id").select("s.node").collect()]
    assert min(nodes) not in nodes[:2]
    links = near_dups.Search(docs, reps, near_dups.SIMILARITY).run()
    assert {(r.node, r.label) for r in links.collect()} == {(max(nodes[:2]), min(nodes[:2]))}


def test_one_of_each_component_stays(spark):
    texts = near_texts(random.Random(11))
    docs = frame(spark, texts + texts[:3], ids=[*range(len(texts)), 0, 1, 2])
    stay = near_dups.one_of_each(docs)
    assert stay.columns == docs.columns
    expected = brute_components(list(enumerate(texts)))
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(expected))


def test_null_ids_and_chains(spark):
    draw = random.Random(12)
    chain = [[f"c{k}" for k in range(100)]]
    for k in range(30):
        chain.append([*chain[-1][:k * 3], f"x{k}", *chain[-1][k * 3 + 1:]])
    texts = [" ".join(words) for words in chain] + ["lone text without id", None]
    ids = [None if k % 3 == 0 else draw.randrange(10**6) for k in range(31)] + [None, None]
    rows = near_dups.near_duplicates(frame(spark, texts, ids=ids)).collect()
    expected = brute_components(list(zip(ids, texts)))
    assert plain((r.doc_id, r.component_id) for r in rows) == plain(zip(ids, expected))


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 4999), (7, 7)]
    found = near_dups.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    expected = {k: 0 for k in range(1, 61)} | {k: 1000 for k in range(1001, 1200)} | {5000: 4999}
    assert {r.node: r.label for r in found.collect()} == expected
    assert near_dups.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_estimates_are_near_the_similarity(spark):
    draw = random.Random(13)
    pairs = []
    for _ in range(60):
        base = [f"e{draw.randrange(10**6)}" for _ in range(400)]
        pairs.append((" ".join(base), variants(draw, base, 1, 40)[0]))
    sign = near_dups.signatures()
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", sign("a")["planes"].alias("x"), sign("b")["planes"].alias("y"))
    rows = df.select("a", "b", near_dups.estimate(F.col("x"), F.col("y")).alias("e")).collect()
    errors = [r.e - len(shingle_set(r.a) & shingle_set(r.b)) / len(shingle_set(r.a) | shingle_set(r.b)) for r in rows]
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.25


def test_near_duplicates_of_nothing(spark, tmp_path):
    assert queries.op8_near_duplicates(spark, stored(frame(spark, []), tmp_path)).count() == 0
    rows = queries.op8_near_duplicates(spark, stored(frame(spark, [None, "", " "]), tmp_path)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == [(k, 0, k, True) for k in range(3)]


def templated(count, draw):
    """Pages of one template at similarity about 0.6: alike enough to share bands, too far apart to link."""
    shared = [f"t{k}" for k in range(150)]
    return [" ".join(shared + [f"o{number}-{k}" for k in range(50)]) for number in range(count)] + [
        " ".join(shared + [f"o{draw.randrange(count)}-{k}" for k in range(50)])]


@pytest.mark.parametrize("count", [300, 1200])
def test_cells_of_a_wide_bucket_stay_small(spark, monkeypatch, count):
    """However many members ask in a bucket, a cell holds two blocks at most; every pair meets once."""
    monkeypatch.setattr(near_dups, "BLOCK", 64)
    rows = [(7, number, number if number % 3 else 0, count, count // 3, 0, [number] * 2) for number in range(count)]
    opened = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows], "bucket bigint, node bigint, label bigint, all bigint, top bigint, major bigint")
    search = near_dups.Search.__new__(near_dups.Search)
    search.reps = spark.range(count).select(
        F.col("id").alias("node"), F.lit(10).alias("n"), F.array(F.lit(0)).alias("planes"), F.array(F.lit(7)).alias("bands"))
    cells = search.cells(opened).collect()
    sizes = Counter((r.block, r.asking) for r in cells)
    assert max(sizes.values()) <= 2 * 64
    stands, asks = {}, {}
    for r in cells:
        (asks if r.asks else stands).setdefault((r.block, r.asking), []).append(r.node)
    met = Counter((a, s) for cell, askers in asks.items() for a in askers for s in stands.get(cell, []))
    assert met == Counter((a, s) for a in range(count) if a % 3 for s in range(count))


def test_templated_pages_equal_comparing_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 32)
    texts = templated(150, random.Random(3))
    docs = frame(spark, texts)
    out = {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs).collect()}
    assert out == dict(enumerate(brute_components(list(enumerate(texts)))))


def test_near_duplicates_of_names_with_dots_and_own_names(spark):
    docs = frame(spark, ["one two three four five six"] * 3 + ["other words stand here alone now"], ids=[1, 1, 2, 3])
    docs = docs.withColumnsRenamed({"doc_id": "doc.id", "text": "the.text"}).withColumns({
        "__hash": F.lit("x"), "__id": F.lit(1), "node": F.lit(2), "label": F.lit("y")})
    out = near_dups.one_of_each(docs, id_col="doc.id", text_col="the.text")
    assert out.columns == docs.columns
    assert sorted((r["doc.id"], r["__hash"]) for r in out.collect()) == [(1, "x"), (3, "x")]


def test_quality_fits_beside_columns_of_any_name(spark):
    docs = frame(spark, [f"text {k} of some length" for k in range(60)]).withColumns({"label": F.lit(1), "_id": F.lit("x"), "other": F.lit(0)})
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], QUALITY)
    assert quality.fit(docs, labels) == quality.fit(docs.select("doc_id", "text"), labels)
