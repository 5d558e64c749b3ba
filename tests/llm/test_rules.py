"""License scan, rule cascade and personal data against plain references."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm.helpers import LOWER, ODD_TEXTS, frame, stored, words
from quotemill.llm import cascade, licenses, pii, queries

LICENSE_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LICENSE_TEXTS = [
    *ODD_TEXTS,
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. cc by cc by",
    "Apache License, Version 2.0 or MIT License or GPL v2 or later",
    "SPDX-License-Identifier: LGPL-2.1-or-later",
    "mit\nlicense MIT LICENSES gnu general public",
]


def base_places(text):
    found = LICENSE_WORD.findall((text or "").translate(LOWER))
    out = []
    for phrase, label in licenses.PHRASES:
        part = phrase.split()
        out += [(k, label) for k in range(len(found)) if found[k:k + len(part)] == part]
    return len(found), sorted(out)


def test_there_are_hundreds_of_rules_with_sound_gates():
    rules = licenses.rules()
    assert len(rules) > 300 and len({rule.name for rule in rules}) == len(rules)
    gates = {rule.gate for rule in rules}
    for phrase, _ in licenses.PHRASES:
        assert gates & {word.encode() for word in phrase.split()}


def spellings(parsed):
    """Every text an expression without unbounded repeats matches."""
    out = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            found = [chr(value)]
        elif name == "IN":
            found = [chr(c) for _, c in value]
        elif name == "MAX_REPEAT":
            least, most, part = value
            assert (least, most) == (0, 1)
            found = ["", *spellings(part)]
        elif name == "BRANCH":
            found = [text for part in value[1] for text in spellings(part)]
        elif name == "SUBPATTERN":
            found = spellings(value[-1])
        else:
            assert name in ("ASSERT", "ASSERT_NOT")
            continue
        out = [start + end for start in out for end in found]
    return out


HEADS = [
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991"),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("lgpl-2.1", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"),
    ("lgpl-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007"),
    ("gfdl-1.3", "GNU Free Documentation License\nVersion 1.3, 3 November 2008"),
    ("apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/"),
    ("mpl-2.0", "Mozilla Public License Version 2.0\n=================================="),
    ("mpl-1.1", "Mozilla Public License Version 1.1"),
    ("epl-2.0", "Eclipse Public License - v 2.0"),
    ("epl-1.0", "Eclipse Public License - v 1.0"),
    ("cddl-1.0", "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0"),
    ("mit", "The MIT License (MIT)\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("isc", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("bsd-2-clause", "BSD 2-Clause License"),
    ("bsd-3-clause", "BSD 3-Clause License"),
    ("bsd-4-clause", "All advertising materials mentioning features or use of this software must display the following "
                     "acknowledgement:"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("bsl-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("artistic-2.0", "The Artistic License 2.0\n\nCopyright (c) 2000-2006, The Perl Foundation."),
    ("ofl-1.1", "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"),
    ("eupl-1.2", "EUROPEAN UNION PUBLIC LICENCE v. 1.2"),
    ("mulanpsl-2.0", "Mulan Permissive Software License, Version 2"),
    ("blueoak-1.0.0", "# Blue Oak Model License\n\nVersion 1.0.0"),
    ("busl-1.1", "Business Source License 1.1"),
    ("sspl-1.0", "Server Side Public License\nVERSION 1, OCTOBER 16, 2018"),
    ("elastic-2.0", "Elastic License 2.0"),
    ("cc0-1.0", "CC0 1.0 Universal"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("upl-1.0", "The Universal Permissive License (UPL), Version 1.0"),
    ("python-2.0", "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2"),
    ("mit", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
            "THE WARRANTIES OF MERCHANTABILITY"),
]


@pytest.mark.parametrize("label, head", HEADS)
def test_heads_of_licenses_give_exact_ids(label, head):
    found = licenses.Scanner()(f"Some project.\n\n{head}\n\nMore text follows here")
    assert label in {detection["label"] for detection in found["detections"]}
    assert found["score"] >= (0.9 if "." in label else 0.6)


@pytest.mark.parametrize("label", sorted({"-".join(w.decode() for w in words) for words in licenses.identifiers()})[:400])
def test_tags_give_their_identifier(label):
    known = {"-".join(w.decode() for w in words): rule.label for words, rule in licenses.identifiers().items()}
    (found,) = licenses.Scanner()(f"// SPDX-License-Identifier: {known[label].upper()}\n")["detections"]
    assert found["label"] == known[label]


def test_every_spelling_of_a_rule_passes_its_gate():
    scan = licenses.Scanner()
    for rule in licenses.rules():
        texts = spellings(re._parser.parse(rule.pattern.pattern.decode()))
        for text in texts:
            assert set(rule.gates) & set(text.encode().translate(scan.table).split()), (rule.name, text)
        assert rule.pattern.search(f" {texts[0]} ".encode())


@pytest.mark.parametrize("text, labels", [
    ("released under GPLv3", ["gpl-3.0"]),
    ("GNU GPLv2", ["gpl-2.0"]),
    ("LGPLv2.1+ and AGPLv3 or later", ["lgpl-2.1-or-later", "agpl-3.0-or-later"]),
    ("GPL-2.0+ or GPL-2.0", ["gpl-2.0-or-later", "gpl-2.0"]),
    ("1+1 and 2 + 2 C++11 code under GPLv3+, not GPL 3", ["gpl-3.0-or-later", "gpl-3.0"]),
    ("the GPL version 3 29 words on", []),
    ("GPL version 2 of 3 June 1999, LGPL version 3, 4 July 2007", ["gpl-2.0", "lgpl-3.0"]),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT\nor ISC", ["apache-2.0", "mit", "isc"]),
    ("SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0 OR BSD-3-Clause) */ mit",
     ["gpl-2.0-or-later", "bsd-3-clause"]),
    ("SPDX-License-Identifier: BUSL-1.1", ["busl-1.1"]),
    ("SPDX-License-Identifier: LicenseRef-Own", []),
    ("GPL3 only, MPLv2 and Apache2", ["gpl-3.0-only", "mpl-2.0", "apache-2.0"]),
    ("GPLv2, which is GPL version 2", ["gpl-2.0", "gpl-2.0"]),
    ("the beer ware license", ["beerware"]),
    ("the Unlicence", ["unlicense"]),
])
def test_a_name_in_another_word_is_found(text, labels):
    assert [found["label"] for found in licenses.Scanner()(text)["detections"]] == labels


@pytest.mark.parametrize("text, labels", [
    ("licensed under the GNU General Public License, version 3", ["gpl-3.0"]),
    ("GNU GPL version 2 or any later version", ["gpl-2.0-or-later"]),
    ("CC BY-NC 4.0", ["cc-by-nc-4.0"]),
    ("Creative Commons Attribution ShareAlike 3.0", ["cc-by-sa-3.0"]),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", ["lgpl-2.1-or-later"]),
    ("the MIT License and the BSD 3-clause", ["mit", "bsd-3-clause"]),
    ("apache tomcat, a library with a public face", []),
    ("", []), (None, []),
])
def test_contained_detections_are_suppressed(text, labels):
    assert [found["label"] for found in licenses.Scanner()(text)["detections"]] == labels


def test_suppression_equals_comparing_all_pairs():
    draw = random.Random(3)
    rules = licenses.rules()
    for _ in range(200):
        found = []
        for _ in range(draw.randint(0, 12)):
            start = draw.randint(0, 8)
            found.append((draw.choice(rules[::40]), start, start + draw.randint(1, 6)))
        found = list(set(found))
        rank = sorted(found, key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name))
        plain = [
            d for k, d in enumerate(rank)
            if not any(e[1] <= d[1] and e[2] >= d[2] for e in rank[:k])]
        assert sorted(plain, key=lambda d: (d[1], d[2])) == licenses.unsuppressed(found)


def test_license_query(spark, tmp_path, sf_dir):
    given = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + LICENSE_TEXTS
    folder = stored(frame(spark, given).withColumn("labels", F.lit("x")), tmp_path)
    rows = {r.doc_id: r for r in queries.op2_license_scan(spark, folder).collect()}
    assert len(rows) == len(given)
    for number, text in enumerate(given):
        row, (n_words, places) = rows[number], base_places(text)
        starts = [start for start, _ in places]
        assert (row.n_words, row.n_base) == (n_words, len(places))
        assert (row.first_word, row.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        base = sorted({label for _, label in places})
        assert row.base_labels == ",".join(base)
        assert set(base) <= set(row.labels.split(",") if row.labels else [])
        assert 0 <= row.score <= 1


def base_counts(text):
    found = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = [tuple(found[k:k + 3]) for k in range(len(found) - 2)]
    seen = Counter(windows)
    covered = {k + j for k, window in enumerate(windows) if seen[window] > 1 for j in range(3)}
    return (
        len(found), sum(map(len, found)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered))


def test_cascade_query(spark, tmp_path, sf_dir):
    draw = random.Random(4)
    repeats = [" ".join(draw.choice("abc") for _ in range(draw.randint(1, 90))) for _ in range(60)]
    given = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD_TEXTS + repeats
    folder = stored(frame(spark, given).withColumn("kept", F.lit(1)), tmp_path)
    rows = {r.doc_id: r for r in queries.op6_rule_cascade(spark, folder).collect()}
    for number, text in enumerate(given):
        row, counts = rows[number], base_counts(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert row.base_failed == failed
        rejected = failed or any(rule.rejects(cascade.Facts(text)) for rule in cascade.RULES)
        assert row.kept == (not rejected)


def test_order_changes_cost_and_never_the_verdict(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    listed = list(range(len(cascade.RULES)))
    verdicts = [
        [r.k for r in docs.select(cascade.cascade(order)("text")["kept"].alias("k")).collect()]
        for order in (listed, listed[::-1], cascade.estimated_order(docs, sample_rows=50))]
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_order_is_by_rejection_per_cost_among_the_texts_left():
    # Rule 0 rejects most at high cost, rule 1 half of them for little, rule 2 what rule 1 does.
    groups = [(0b001, 40, (4.0, 0.1, 0.1)), (0b111, 40, (4.0, 0.1, 0.2)), (0, 20, (2.0, 0.1, 0.1))]
    assert cascade.best_order(groups, 3) == [1, 0, 2]
    assert cascade.best_order([], 3) == [0, 1, 2]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for match in CARD.finditer(text):
        digits = [int(c) for c in match.group() if c.isdigit()]
        odd, even = digits[-1::-2], digits[-2::-2]
        if 14 <= len(digits) <= 19 and (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0:
            out.append((match.start(), 2, match.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def fuzzed(count, seed=3):
    draw = random.Random(seed)
    parts = [*"ab1234567890..@@--++ ()%_é", "4111 1111 1111 1111", "+1 (706) 555-6754", "1.2.3.4", "a@b.c", "256.1.1.1"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(count)]


def test_base_spans_equal_the_patterns():
    for text in [*fuzzed(5000), "1" * 400, "a@b..c@d.e", "x@y.z@w.v", "007.0.0.0255"]:
        assert [(n.start, pii.KINDS.index(n.kind), n.end) for n in pii.base_spans(text)] == brute_spans(text)


def known_potentials():
    counts = Counter()
    for text in ["call +1 (706) 555-6754 now", "mail a.b12@c.example.com", "card 4111 1111 1111 1111", "ip 1.2.3.4"] * 50:
        for c in pii.counts_of(text):
            counts[c["name"], c["x"], c["y"]] += c["n"]
    return pii.potentials((*key, n) for key, n in counts.items())


@pytest.mark.parametrize("text, added", [
    ("Call +1 (706) 555-6754. Much later: (706) 555-6754 or 706.555.6754.", [("phone", "(706) 555-6754"), ("phone", "706.555.6754")]),
    ("kate.smith77@mail.example.com wrote; so did kate.smith77", [("email", "kate.smith77")]),
    ("card 4111 1111 1111 1111 again 4111/1111/1111/1111", [("card", "4111/1111/1111/1111")]),
    ("order 20240101123 of +1 (706) 555-6754", []),
    ("number 12345678 and 12345678", []),
    ("", []), (None, []),
])
def test_distant_repeats_get_the_label_of_the_known_entity(text, added):
    assert [(n.kind, n.text) for n in pii.spans_of(text, known_potentials())[1]] == added


def test_messages_on_a_tree_are_exact():
    import itertools

    import numpy as np
    draw = np.random.default_rng(1)
    unary, pair = draw.normal(size=(3, 3)), draw.normal(size=(2, 3, 3))
    joint = np.zeros((3, 3, 3))
    for x in itertools.product(range(3), repeat=3):
        joint[x] = np.exp(unary[0, x[0]] + unary[1, x[1]] + unary[2, x[2]] + pair[0, x[0], x[1]] + pair[1, x[1], x[2]])
    joint /= joint.sum()
    exact = np.stack([joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))])
    assert np.allclose(pii.beliefs(unary, np.array([[0, 1], [1, 2]]), pair), exact, atol=2e-3)


def test_skip_edges_grow_with_the_nodes():
    text = " ".join(["+1 (706) 555-6754"] * 300)
    nodes = pii.base_spans(text)
    assert len(nodes) == 300 and len(pii.skip_edges(nodes)) <= 2 * len(nodes)


def test_potentials_count_every_document(spark):
    texts = ["call +1 (706) 555-6754 now"] * 5000 + ["ip 1.2.3.4"]
    counts = Counter()
    for text in texts:
        for c in pii.counts_of(text):
            counts[c["name"], c["x"], c["y"]] += c["n"]
    expected = pii.potentials((*key, n) for key, n in counts.items())
    # Sums do not depend on which rows arrive first.
    for parts in (1, 7):
        model = pii.estimated(frame(spark, texts).repartition(parts))
        assert model.features.keys() == expected.features.keys()
        for ours, theirs in [
            (model.prior, expected.prior), (model.chain, expected.chain), (model.skip, expected.skip),
            *[(model.features[name], expected.features[name]) for name in expected.features],
        ]:
            assert (ours == theirs).all()


def test_personal_data_query(spark, tmp_path, sf_dir):
    given = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + ODD_TEXTS + fuzzed(80, 9)
    folder = stored(frame(spark, given).withColumn("spans", F.lit(1)), tmp_path)
    rows = {r.doc_id: r for r in queries.op1_pii(spark, folder).collect()}
    assert len(rows) == len(given)
    for number, text in enumerate(given):
        row, base = rows[number], brute_spans(text or "")
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        named = [f"{pii.KINDS[k]}:{start}:{end}" for start, k, end in base]
        assert row.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(row.spans.split(",") if row.spans else [])


@pytest.mark.parametrize("name", ["op1_pii", "op2_license_scan", "op6_rule_cascade"])
def test_empty_table(spark, tmp_path, name):
    assert queries.QUERIES[name](spark, stored(frame(spark, []), tmp_path)).count() == 0


# Credentials.

def hexes(draw, size=40):
    return "".join(draw.choice("0123456789abcdef") for _ in range(size))


def planted(draw, count=300):
    """Texts with credentials announced, repeated without announcement, and look-alikes that are none."""
    texts, truth = [], []
    names = ['token = "{}"', "api_key: {}", "password={}", 'SECRET => "{}"', "Bearer {}", "access token '{}'"]
    for k in range(count):
        value = draw.choice([hexes(draw), hexes(draw, 32), "".join(
            draw.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(36))])
        words = [f"word{draw.randrange(50)}" for _ in range(30)]
        spots = []
        if k % 3 == 0:
            words.insert(draw.randrange(10), draw.choice(names).format(value))
            spots = [value]
        if k % 6 == 0:
            # The same credential far off, with nothing before it.
            words.insert(len(words) - draw.randrange(5), value)
            spots = [value, value]
        if k % 3 == 1:
            words.insert(5, f"commit {value}")
        if k % 3 == 2:
            words.insert(3, draw.choice(["supercalifragilisticexpialidocious", "1234567890123456789", "a" * 40, "the-long-name-of-a-thing"]))
        texts.append(" ".join(words))
        truth.append(spots)
    return texts, truth


def secrets_found(texts):
    counts = Counter()
    for text in texts:
        for c in pii.counts_of(text):
            counts[c["name"], c["x"], c["y"]] += c["n"]
    model = pii.potentials((*key, n) for key, n in counts.items())
    return [[n.text for n in pii.spans_of(text, model)[1] if n.kind == "secret"] for text in texts]


def test_credentials_are_found_and_skip_edges_find_their_repeats(monkeypatch):
    texts, truth = planted(random.Random(3))
    found = secrets_found(texts)
    wanted = sum(map(len, truth))
    hit = sum(len(Counter(a) & Counter(b) and list((Counter(a) & Counter(b)).elements())) for a, b in zip(found, truth))
    assert hit / wanted > 0.9 and hit / sum(map(len, found)) > 0.98
    # Without skip edges the announced ones stay and the repeats are lost.
    monkeypatch.setattr(pii, "skip_edges", lambda nodes: [])
    alone = secrets_found(texts)
    once = sum(bool(t) for t in truth)
    assert 0.97 * once <= sum(map(len, alone)) <= once < 0.8 * hit


def test_documents_without_a_known_node_are_left_alone():
    draw = random.Random(4)
    texts, _ = planted(draw)
    plain = [f"commit {hexes(draw)} by someone", "id 550e8400-e29b-41d4-a716-446655440000", "x" * 50, "", None]
    assert secrets_found([*texts, *plain])[-5:] == [[]] * 5


def test_secrets_of_the_documents(spark, sf_dir):
    rows = {r.doc_id: r.spans for r in queries.op1_pii(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for match in re.finditer(r'token = "([0-9a-f]{40})"', r.text or ""):
            assert f"secret:{match.start(1)}:{match.end(1)}" in rows[r.doc_id].split(",")
