"""License scan: ordered signature rules behind a keyword gate.

A text is lower-cased (A-Z) and cut into words of digits, letters a-z and
non-ASCII characters. Rules are regular expressions over the words joined by
single blanks: some two hundred hand-written signatures of license texts, heads
and notices, and the names of license families with their versions and
qualifiers. A plus sign after a version means that or a later one. Expressions
after an SPDX tag are read identifier by identifier. Each rule lists whole words, one of which every
match of it holds, with a version joined to a short name ("gplv2", "gpl3")
among them; only rules with such a word are run, which leaves most texts
without any.

Detections overlap: "gnu general public license version 3 or later" also holds
the name alone. Rules have a priority, and a detection is suppressed if another
of higher precedence (priority, then length, then place) contains its words.

Base places are where the words of four fixed phrases stand consecutively; they
are reported apart and never suppressed.

Null and empty texts have no words and no detections. Repeated rows give
repeated rows; other columns pass through. Cost is linear in the text for the
gate, and n log n in the number of detections.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import types as T

from quotemill.llm.common import per_value
from quotemill.llm.license_sentences import IDENTIFIERS, SENTENCES

# Phrases and their labels (fixed values).
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Family: label stem, names, versions, whether "or later" and "only" occur.
# Names are regular expressions over words; the gate word follows the name, or
# several of them, if a spelling of the name has another word instead.
FAMILIES: tuple[tuple[str, tuple[tuple[str, str], ...], tuple[str, ...], bool], ...] = (
    ("gpl", (("gnu general public licen[cs]e", "gnu"), ("gnu gpl", "gpl"), ("gpl", "gpl"),
             ("general public licen[cs]e", "general")), ("1.0", "2.0", "3.0"), True),
    ("lgpl", (("gnu lesser general public licen[cs]e", "lesser"),
              ("gnu library general public licen[cs]e", "library"), ("gnu lgpl", "lgpl"), ("lgpl", "lgpl")),
     ("2.0", "2.1", "3.0"), True),
    ("agpl", (("gnu affero general public licen[cs]e", "affero"),
              ("affero general public licen[cs]e", "affero"), ("agpl", "agpl")), ("1.0", "3.0"), True),
    ("gfdl", (("gnu free documentation licen[cs]e", "gnu"), ("gfdl", "gfdl")), ("1.1", "1.2", "1.3"), True),
    ("apache", (("apache licen[cs]e", "apache"), ("apache software licen[cs]e", "apache"),
                ("apache", "apache")), ("1.0", "1.1", "2.0"), False),
    ("mpl", (("mozilla public licen[cs]e", "mozilla"), ("mpl", "mpl")), ("1.0", "1.1", "2.0"), False),
    ("epl", (("eclipse public licen[cs]e", "eclipse"), ("epl", "epl")), ("1.0", "2.0"), False),
    ("cddl", (("common development and distribution licen[cs]e", "distribution"), ("cddl", "cddl")),
     ("1.0", "1.1"), False),
    ("cpl", (("common public licen[cs]e", "common"),), ("1.0",), False),
    ("ipl", (("ibm public licen[cs]e", "ibm"),), ("1.0",), False),
    ("eupl", (("european union public licen[cs]e", "european"), ("eupl", "eupl")), ("1.0", "1.1", "1.2"), False),
    ("osl", (("open software licen[cs]e", "open"), ("osl", "osl")), ("1.0", "2.0", "2.1", "3.0"), False),
    ("afl", (("academic free licen[cs]e", "academic"), ("afl", "afl")),
     ("1.1", "1.2", "2.0", "2.1", "3.0"), False),
    ("artistic", (("artistic licen[cs]e", "artistic"),), ("1.0", "2.0"), False),
    ("bsl", (("boost software licen[cs]e", "boost"),), ("1.0",), False),
    ("ofl", (("sil open font licen[cs]e", "sil"), ("open font licen[cs]e", "font"), ("ofl", "ofl")),
     ("1.0", "1.1"), False),
    ("zpl", (("zope public licen[cs]e", "zope"), ("zpl", "zpl")), ("1.1", "2.0", "2.1"), False),
    ("psf", (("python software foundation licen[cs]e", "python"), ("psf licen[cs]e", "psf")), ("2.0",), False),
    ("php", (("php licen[cs]e", "php"),), ("3.0", "3.01"), False),
    ("odbl", (("open database licen[cs]e", "database"), ("odbl", "odbl")), ("1.0",), False),
    ("lppl", (("latex project public licen[cs]e", "latex"), ("lppl", "lppl")), ("1.0", "1.2", "1.3"), False),
    ("ms-pl", (("microsoft public licen[cs]e", "microsoft"), ("ms pl", "ms")), (), False),
    ("ms-rl", (("microsoft reciprocal licen[cs]e", "microsoft"), ("ms rl", "ms")), (), False),
    ("mit", (("mit licen[cs]e", "mit"), ("expat licen[cs]e", "expat"), ("x11 licen[cs]e", "x11"),
             ("licen[cs]e mit", "mit")), (), False),
    ("isc", (("isc licen[cs]e", "isc"),), (), False),
    ("zlib", (("zlib licen[cs]e", "zlib"), ("zlib libpng licen[cs]e", "zlib")), (), False),
    ("unlicense", (("the unlicen[cs]e", "unlicense unlicence"),), (), False),
    ("wtfpl", (("wtfpl", "wtfpl"), ("do what the fuck you want to public licen[cs]e", "fuck")), (), False),
    ("ncsa", (("university of illinois ncsa open source licen[cs]e", "ncsa"), ("ncsa licen[cs]e", "ncsa")),
     (), False),
    ("postgresql", (("postgresql licen[cs]e", "postgresql"),), (), False),
    ("openssl", (("openssl licen[cs]e", "openssl"),), (), False),
    ("w3c", (("w3c software notice and licen[cs]e", "w3c"), ("w3c licen[cs]e", "w3c")), (), False),
    ("vim", (("vim licen[cs]e", "vim"),), (), False),
    ("beerware", (("beer ?ware licen[cs]e", "beerware beer"),), (), False),
)

# Creative Commons: short clauses and the words they are spelled with.
CLAUSES = (
    ("by", "attribution"),
    ("by-sa", "attribution share ?alike"),
    ("by-nc", "attribution non ?commercial"),
    ("by-nd", "attribution no ?deriv(?:ative)?s(?: works)?"),
    ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
BSD_CLAUSES = (("0", "zero"), ("1", "one"), ("2", "two"), ("3", "three"), ("4", "four"))

# Sentences of license texts: label, expression, gate word (fixed values).
SIGNATURES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "granted"),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or "
            "without fee is hereby granted", "granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("apache-2.0", "licensed under the apache licen[cs]e version 2 0 the licen[cs]e you may not use this file "
                   "except in compliance", "apache"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e",
     "redistribute"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public "
             "licen[cs]e", "redistribute"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public "
             "licen[cs]e", "redistribute"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the "
             "authors be held liable", "warranty"),
    ("proprietary", "all rights reserved", "reserved"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain"),
)

MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"

# Priorities: a whole sentence, a qualified version, a version, a bare name.
SENTENCE, QUALIFIED, VERSIONED, NAMED = 4, 3, 2, 1
STRENGTH = {SENTENCE: 1.0, QUALIFIED: 0.95, VERSIONED: 0.9, NAMED: 0.6}
BASE_STRENGTH = 0.5


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    # Every match holds one of them as a whole word.
    gates: tuple[bytes, ...]
    pattern: re.Pattern[bytes]

    @property
    def gate(self) -> bytes:
        return self.gates[0]


def rule(name: str, label: str, priority: int, gate: str, words: str) -> Rule:
    return Rule(name, label, priority, tuple(gate.encode().split()), re.compile(f"(?<= )(?:{words})(?= )".encode()))


def joined_gate(name: str, gate: str, version: str) -> str:
    """Gate words of a name with a version, which may be joined to the name's last word."""
    major = version.split(".")[0]
    return f"{gate} {gate}{major} {gate}v{major}" if name.split()[-1] == gate else gate


def version_words(version: str) -> str:
    """Words a version is written with; a zero minor number may be missing."""
    major, minor = version.split(".")
    # Another number may be the minor one, unless it is the day of a date.
    digits = f"{major}(?: 0)?(?! [0-9]{{1,2}} (?!(?:{MONTHS}) ))" if minor == "0" else f"{major} {minor}"
    return f"(?: (?:version|ver|v))? ?v?{digits}"


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in order."""
    out = []
    for label, words, gate in SIGNATURES:
        out.append(rule(f"text:{label}:{len(out)}", label, SENTENCE, gate, words))
    for label, words, gate in SENTENCES:
        out.append(rule(f"text:{label}:{len(out)}", label, SENTENCE, gate, words))
    for stem, names, versions, qualified in FAMILIES:
        for place, (name, gate) in enumerate(names):
            for version in versions:
                here, label = f"{stem}:{place}:{version}", f"{stem}-{version}"
                words = f"{name},?{version_words(version)}"
                gates = joined_gate(name, gate, version)
                if qualified:
                    out.append(rule(f"{here}:later", f"{label}-or-later", QUALIFIED, gates,
                                    f"{words}(?: of the licen[cs]e)?(?: or| and) (?:at your option )?"
                                    "(?:any )?(?:later|newer|higher)(?: version)?"))
                    out.append(rule(f"{here}:only", f"{label}-only", QUALIFIED, gates, f"{words} only"))
                out.append(rule(here, label, VERSIONED, gates, words))
            # A short name alone says too little.
            if " " in name or not versions:
                out.append(rule(f"{stem}:{place}", stem, NAMED, gate, name))
    for clauses, spelled in CLAUSES:
        short = f"cc {clauses.replace('-', ' ')}"
        for place, (name, gate) in enumerate(((short, "cc"), (f"creative commons {spelled}", "creative"))):
            for version in CC_VERSIONS:
                out.append(rule(f"cc-{clauses}:{place}:{version}", f"cc-{clauses}-{version}", VERSIONED, gate,
                                f"{name}(?: (?:international|unported|generic))?(?: licen[cs]e)?"
                                f"{version_words(version)}"))
            out.append(rule(f"cc-{clauses}:{place}", f"cc-{clauses}", NAMED, gate, name))
    out.append(rule("cc0", "cc0-1.0", VERSIONED, "cc0", "cc0(?: 1 0)?"))
    out.append(rule("cc0:spelled", "cc0-1.0", VERSIONED, "creative", "creative commons zero(?: v?1 0)?"))
    for digit, spelled in BSD_CLAUSES:
        for place, words in enumerate((f"bsd {digit} clause", f"{digit} clause bsd", f"{spelled} clause bsd")):
            out.append(rule(f"bsd-{digit}:{place}", f"bsd-{digit}-clause", VERSIONED, "bsd", words))
    out.append(rule("bsd", "bsd", NAMED, "bsd", "bsd licen[cs]e"))
    return tuple(out)


def spelled(label: str) -> tuple[bytes, ...]:
    """An identifier as the words it is cut into."""
    return tuple(re.split(rb"[-.]", label.encode()))


@lru_cache(maxsize=1)
def identifiers() -> dict[tuple[bytes, ...], Rule]:
    """Known SPDX identifiers by their words."""
    labels = [*IDENTIFIERS]
    for stem, _, versions, qualified in FAMILIES:
        for version in versions or ("",):
            label = f"{stem}-{version}" if version else stem
            labels += [label, *[f"{label}-{suffix}" for suffix in ("only", "or-later") if qualified]]
    labels += [f"cc-{clauses}-{version}" for clauses, _ in CLAUSES for version in CC_VERSIONS]
    found = {}
    for label in labels:
        words = spelled(label)
        found[words] = rule(f"spdx:{label}", label, SENTENCE, "spdx", " ".join(word.decode() for word in words))
    return found


TAG = (b"spdx", b"license", b"identifier")
LONGEST = 6
LATER = {f"{stem}-{version}" for stem, _, versions, qualified in FAMILIES if qualified for version in versions}


def tagged(words: list[bytes]) -> list[tuple[Rule, int, int]]:
    """Identifiers of the expressions after SPDX tags, each with the words it stands in."""
    known, out = identifiers(), []
    for place in [k for k, word in enumerate(words) if word == TAG[0] and tuple(words[k:k + 3]) == TAG]:
        start = place + 3
        while True:
            sizes = [n for n in range(LONGEST, 0, -1) if tuple(words[start:start + n]) in known]
            if not sizes:
                break
            end = start + sizes[0]
            # The first identifier owns the tag.
            out.append((known[tuple(words[start:end])], place if start == place + 3 else start, end))
            if words[end:end + 1] == [b"with"]:
                # An exception's name, up to the next operator.
                end = next((k for k in range(end + 1, min(end + 9, len(words))) if words[k] in (b"or", b"and")), len(words))
            if words[end:end + 1] not in ([b"or"], [b"and"]):
                break
            start = end + 1
    return out


def word_bytes() -> bytes:
    """Byte table: A-Z to lower case, bytes outside words to a blank."""
    return bytes(
        b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
        for b in range(256))


def unsuppressed(found: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """Detections that none of higher precedence contains, by start.

    In precedence order, the largest end among earlier detections that start
    no later decides; a prefix-maximum tree keeps it.
    """
    ranked = sorted(found, key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name))
    starts = sorted({start for _, start, _ in ranked})
    tree = [-1] * (len(starts) + 1)
    kept = []
    for detection in ranked:
        _, start, end = detection
        place = bisect_left(starts, start) + 1
        reach, k = -1, place
        while k:
            reach, k = max(reach, tree[k]), k & (k - 1)
        if reach >= end:
            continue
        kept.append(detection)
        while place < len(tree):
            tree[place], place = max(tree[place], end), place + (place & -place)
    return sorted(kept, key=lambda d: (d[1], d[2]))


class Scanner:
    """Finds licenses in one text."""

    def __init__(self) -> None:
        self.table = word_bytes()
        self.by_gate: dict[bytes, list[Rule]] = {TAG[0]: []}
        for known in rules():
            for gate in known.gates:
                self.by_gate.setdefault(gate, []).append(known)
        self.gates = frozenset(self.by_gate)
        self.phrases = [(f" {words} ".encode(), len(words.split()), label) for words, label in PHRASES]

    def __call__(self, text: str | None) -> dict:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.translate(self.table).split()
        gates = self.gates.intersection(words)
        places: list[dict] = []
        found: list[tuple[Rule, int, int]] = []
        # Every phrase holds the gate word of some rule.
        if gates:
            joined = b" " + b" ".join(words) + b" "
            number = Numbering(joined)
            for phrase, size, label in self.phrases:
                at = joined.find(phrase)
                while at >= 0:
                    start = number.word(at + 1)
                    places.append({"label": label, "start": start, "end": start + size})
                    at = joined.find(phrase, at + 1)
            # A rule runs once, however many of its words occur.
            for known in {known.name: known for gate in gates for known in self.by_gate[gate]}.values():
                for match in known.pattern.finditer(joined):
                    start = number.word(match.start())
                    found.append((known, start, start + match.group().count(b" ") + 1))
            found += tagged(words) if TAG[0] in gates else []
            if b"+" in raw:
                found = self.or_later(found, raw)
        kept = unsuppressed(found)
        strengths = [STRENGTH[known.priority] for known, _, _ in kept] + [BASE_STRENGTH] * bool(places)
        return {
            "n_words": len(words),
            "places": sorted(places, key=lambda place: (place["start"], place["end"])),
            "detections": [
                {"rule": known.name, "label": known.label, "priority": known.priority, "start": start, "end": end}
                for known, start, end in kept],
            "score": max(strengths, default=0.0),
        }


    def or_later(self, found: list[tuple[Rule, int, int]], raw: bytes) -> list[tuple[Rule, int, int]]:
        """The detections, with those whose last word a plus sign follows labelled as that version or later."""
        signs = [match.end() for match in re.finditer(rb"[0-9](?=\+)", raw)]
        plus, done, number = set(), 0, 0
        for end in signs:
            number += len(raw[done:end].translate(self.table).split())
            # A word cut by the border would count twice.
            plus.add(number - 1)
            done = end
        return [
            (replace(known, label=f"{known.label}-or-later", name=f"{known.name}+", priority=max(known.priority, QUALIFIED))
             if end - 1 in plus and known.label in LATER else known, start, end)
            for known, start, end in found]


class Numbering:
    """Word number of a place in the joined words."""

    def __init__(self, joined: bytes):
        self.blanks = [match.start() for match in re.finditer(b" ", joined)]

    def word(self, at: int) -> int:
        return bisect_left(self.blanks, at) - 1


def scanner() -> Callable[..., Column]:
    """Column function: text to a struct of word count, base places, detections and score.

    Places and detections give word numbers from 0, ends exclusive. ``score`` is
    the strength of the strongest evidence, from 0 (none) to 1 (a sentence of a
    license text).
    """
    span = [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    return per_value(Scanner, T.StructType([
        T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(T.StructType([T.StructField("label", T.StringType()), *span]))),
        T.StructField("detections", T.ArrayType(T.StructType([
            T.StructField("rule", T.StringType()), T.StructField("label", T.StringType()),
            T.StructField("priority", T.IntegerType()), *span]))),
        T.StructField("score", T.DoubleType()),
    ]))
