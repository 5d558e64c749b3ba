"""Personal data in texts: base patterns and a skip-chain conditional random field.

Base spans come from four patterns, each applied leftmost and non-overlapping;
a match that fails its check is dropped. They are never removed.

The field decides on what the patterns miss: numbers and addresses written in
another way, repeats of an entity in part, and credentials, for which there is
no base pattern (kind ``secret``). A credential is a long run of letters and
digits of high entropy; one that a word such as ``token`` or ``password``
announces is known, and what it looks like and where it is repeated tells others.
The field's nodes, in text order, are the known ones (base spans and announced
credentials), whose labels are fixed, and the candidates. Neighbours are joined
in a chain, unless a skip edge joins them. Skip edges join nodes that are far apart but repeat each other: the
same digits, the same last digits, the same account name, the same credential. A key's nodes are
joined in a row and to the key's first node, so edges grow with the nodes.
Loopy sum-product message passing with damping runs over both kinds of edges, so
an entity recognised in one place raises its label wherever it is repeated. A
candidate becomes a span if a skip edge joins it to another node and some label's
belief passes ``MIN_BELIEF``. Documents without a known node are left alone.

The potentials are estimated, not set: features of spans and candidates are
counted with the known labels as supervision, over all documents, and smoothed.
Features never say whether a pattern matched, nor what announced a credential.

Null and empty texts have no spans. Cost is linear in the text plus a constant
number of message rounds over its nodes. Repeated rows give repeated rows;
other columns pass through. On an empty table the potentials are those of the
smoothing alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.common import per_value

# Kinds of base spans, and all that the field tells apart.
KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "secret")
SECRET = LABELS.index("secret")
OTHER = len(LABELS)

ROUNDS = 12
DAMPING = 0.5
MIN_BELIEF = 0.6
SMOOTHING = 0.5
# Agreeing repeats assumed besides the counted ones, per label.
AGREEMENT = 100.0
# Share of the chain's potentials that counts: neighbours say less than repeats.
CHAIN_WEIGHT = 0.5
# Shared digits that make two numbers similar, and the least letters of an account name.
TAIL = 7
NAME_LENGTH = 5

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Parts are digits only, so a match that starts inside a run of digits adds nothing.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What the patterns may miss: other spellings of numbers and addresses.
NUMBER = re.compile(r"\(?[0-9](?:[\x20().+/-]{0,2}[0-9]){6,18}(?![0-9])")
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: ?(?:\(at\)|\[at\]|\{at\}) ?| at )"
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|(?: ?(?:\(dot\)|\[dot\]) ?)| dot )[A-Za-z0-9-]{1,63}){1,8}")
# Words that announce personal data (fixed values).
CUES = {
    "mail": "mail", "email": "mail", "e-mail": "mail", "contact": "contact", "write": "contact",
    "call": "call", "phone": "call", "tel": "call", "telephone": "call", "mobile": "call", "fax": "call",
    "card": "card", "visa": "card", "credit": "card", "account": "card", "ip": "ip", "host": "ip",
    "server": "ip", "address": "contact",
}
BEFORE = 40
# Credentials: runs of letters, digits and signs of base 64, and what announces one (fixed values).
RUN = re.compile(r"[A-Za-z0-9_+/-]{16,}+=*")
ANNOUNCED = re.compile(
    r"(?:api|access|private|secret|auth|client|account|session|service)?[_ -]?"
    r"(?:key|secret|token|password|passwd|pwd|passphrase|credentials?|bearer)(?:[_ -]?id)?"
    r"[\"'`]?\s{0,3}(?:[=:]|=>|:=)?\s{0,3}[\"'`]?\Z", re.IGNORECASE)
# Bits a character carries at least: random hexadecimal has near 4, words of a language about 3.
LEAST_BITS = 2.6
DIGITS = re.compile(r"[0-9]+")


@dataclass(frozen=True)
class Node:
    kind: str | None
    start: int
    end: int
    text: str


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Found from each @ outwards, so a long run of letters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1] in LOCAL_CHARS):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            # What stands before this @ cannot start a later match.
            done = max(done, at + 1)
        at = text.find("@", done)


LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def base_spans(text: str) -> list[Node]:
    """Spans of the four patterns, by start and then by kind as listed."""
    found = [Node("email", start, end, text[start:end]) for start, end in emails(text)]
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in match.group().split(".")):
            found.append(Node("ip", *match.span(), match.group()))
    for match in CARD.finditer(text):
        if match.end() - match.start() < 14:
            continue
        digits = digits_of(match.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(Node("card", *match.span(), match.group()))
    for match in PHONE.finditer(text):
        if 10 <= len(digits_of(match.group())) <= 15:
            found.append(Node("phone", *match.span(), match.group()))
    return sorted(found, key=lambda node: (node.start, KINDS.index(node.kind)))


def bits(text: str) -> float:
    """Entropy of the text's characters."""
    total = len(text)
    return -sum(n / total * math.log2(n / total) for n in Counter(text).values())


def credentials(text: str) -> list[tuple[int, int]]:
    """Runs that may be credentials: letters and digits mixed, in no order a word has."""
    out = []
    for match in RUN.finditer(text):
        run = match.group()
        digits = sum(c.isdigit() for c in run)
        if digits >= 3 and digits < len(run) - 2 and bits(run) >= LEAST_BITS:
            out.append(match.span())
    return out


def announced(text: str, start: int) -> bool:
    """Whether the words before a place announce a credential there."""
    return ANNOUNCED.search(text, max(0, start - BEFORE), start) is not None


def candidates(text: str, base: list[Node]) -> list[Node]:
    """Stretches outside base spans that the field decides on."""
    found = credentials(text)
    secret = set(found)
    if not base:
        return [Node(None, start, end, text[start:end]) for start, end in found]
    found += [match.span() for match in NUMBER.finditer(text)]
    if "at" in text:
        found += [match.span() for match in SPELLED.finditer(text)]
    names = {account(node.text) for node in base if node.kind == "email"}
    names = {name for name in names if len(name) >= NAME_LENGTH and not name.isalpha()}
    if names:
        found += [match.span() for match in NAME.finditer(text) if match.group().strip(".") in names]
    out, taken, place = [], 0, 0
    ordered = sorted(base, key=lambda node: node.start)
    # A number inside a credential is part of it, so credentials come first.
    for start, end in sorted(set(found), key=lambda span: (span[0], span not in secret, -span[1])):
        while place < len(ordered) and ordered[place].end <= start:
            place += 1
        clear = place >= len(ordered) or ordered[place].start >= end
        if start >= taken and clear:
            out.append(Node(None, start, end, text[start:end]))
            taken = end
    return out


HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
NAME = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]+(?![A-Za-z0-9_%+@-])")


def account(address: str) -> str:
    """Name before the @, however the @ is written."""
    return re.split(r"@| ?[(\[{]at[)\]}]| at ", address, maxsplit=1)[0]


def features(text: str, node: Node) -> list[str]:
    """Shape of a node and the cue words before it."""
    digits = sum(c.isdigit() for c in node.text)
    letters = sum(c.isalpha() for c in node.text)
    out = [
        f"digits:{min(digits, 20)}",
        f"letters:{'none' if not letters else 'few' if letters < digits else 'most'}",
        f"dots:{min(node.text.count('.'), 4)}",
        f"gaps:{min(sum(c in ' -()' for c in node.text), 6)}",
    ]
    if RUN.fullmatch(node.text):
        out += [
            f"run:{'hex' if HEX.fullmatch(node.text) else 'mixed' if node.text.isalnum() else 'signs'}",
            f"length:{min(len(node.text) // 8, 10)}", f"bits:{int(2 * bits(node.text))}"]
    for word in re.findall(r"[A-Za-z-]+", text[max(0, node.start - BEFORE):node.start])[-3:]:
        cue = CUES.get(word.lower())
        if cue:
            out.append(f"cue:{cue}")
    return out


def keys(node: Node) -> list[str]:
    """What two nodes must share to be joined by a skip edge."""
    if RUN.fullmatch(node.text) and any(c.isalpha() for c in node.text):
        return [f"secret:{node.text}"]
    digits = digits_of(node.text)
    out = []
    if len(digits) >= TAIL and sum(c.isalpha() for c in node.text) == 0:
        out += [f"tail:{digits[-TAIL:]}", f"same:{digits}"]
    name = account(node.text).strip(".").lower()
    if len(name) >= NAME_LENGTH and any(c.isalpha() for c in name):
        out.append(f"name:{name}")
    return out


def skip_edges(nodes: list[Node]) -> list[tuple[int, int]]:
    """Pairs of nodes that repeat each other: neighbours in a key's row and its first node."""
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    edges = set()
    for place, node in enumerate(nodes):
        for key in keys(node):
            if key in first:
                edges.add((first[key], place))
                edges.add((last[key], place))
            first.setdefault(key, place)
            last[key] = place
    return sorted(edges)


def all_nodes(text: str, base: list[Node]) -> list[Node]:
    """Base spans and candidates in text order."""
    return sorted([*base, *candidates(text, base)], key=lambda node: (node.start, node.end))


@dataclass(frozen=True)
class Potentials:
    """Log-potentials: per feature and label, per pair of labels on either kind of edge."""

    prior: np.ndarray
    features: Mapping[str, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, text: str, node: Node) -> np.ndarray:
        """Features of a node depend on each other, so their mean counts, not their sum."""
        unknown = np.zeros(OTHER + 1)
        return self.prior + np.mean([self.features.get(f, unknown) for f in features(text, node)], axis=0)


def label_of(text: str, node: Node) -> int:
    """Label of a known node: of its kind, or a credential that is announced; else ``OTHER``."""
    if node.kind is not None:
        return LABELS.index(node.kind)
    return SECRET if RUN.fullmatch(node.text) and announced(text, node.start) else OTHER


def counts_of(text: str | None) -> list[dict]:
    """Counts a document adds to the estimate: features by label, labels by edge."""
    nodes = all_nodes(text or "", base_spans(text or ""))
    labels = [label_of(text or "", node) for node in nodes]
    out: dict[tuple[str, int, int], int] = {}

    def add(name: str, x: int, y: int) -> None:
        out[name, x, y] = out.get((name, x, y), 0) + 1

    for node, label in zip(nodes, labels):
        add("prior", label, 0)
        for name in features(text or "", node):
            add(f"f:{name}", label, 0)
    for x, y in zip(labels, labels[1:]):
        add("chain", x, y)
    for i, j in skip_edges(nodes):
        # Agreement is learnt among known entities; a candidate may be either.
        if OTHER not in (labels[i], labels[j]):
            add("skip", labels[i], labels[j])
            add("skip", labels[j], labels[i])
    return [{"name": name, "x": x, "y": y, "n": n} for (name, x, y), n in out.items()]


def potentials(counts: Iterable[tuple[str, int, int, int]]) -> Potentials:
    """Smoothed log-potentials from counts."""
    size = OTHER + 1
    prior, chain, skip = np.full(size, SMOOTHING), np.full((size, size), SMOOTHING), np.full((size, size), SMOOTHING)
    by_feature: dict[str, np.ndarray] = {}
    for name, x, y, n in counts:
        if name == "prior":
            prior[x] += n
        elif name == "chain":
            chain[x, y] += n
        elif name == "skip":
            skip[x, y] += n
        else:
            by_feature.setdefault(name[2:], np.full(size, SMOOTHING))[x] += n
    # Repeats agree even before any is counted.
    skip += AGREEMENT * np.eye(size)
    share = prior / prior.sum()
    # A feature's potential is how much more often it goes with a label than labels do at large.
    return Potentials(
        np.log(share),
        {name: np.log(seen / seen.sum()) - np.log(share) for name, seen in by_feature.items()},
        CHAIN_WEIGHT * np.log(chain * chain.sum() / np.outer(chain.sum(1), chain.sum(0))),
        np.log(skip / skip.sum(axis=1, keepdims=True)),
    )


def beliefs(unary: np.ndarray, edges: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Node marginals after loopy message passing.

    ``edges`` holds node pairs, ``pair`` a matrix of log-potentials per edge.
    Each edge carries a message either way; all are updated at once.
    """
    if not len(edges):
        return normal(unary)
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    potential = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(source), unary.shape[1]))
    for _ in range(ROUNDS):
        total = unary.copy()
        np.add.at(total, target, messages)
        scores = (total[source] - messages[back])[:, :, None] + potential
        top = scores.max(axis=1)
        fresh = top + np.log(np.exp(scores - top[:, None, :]).sum(axis=1))
        fresh -= fresh.max(axis=1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * fresh
    total = unary.copy()
    np.add.at(total, target, messages)
    return normal(total)


def normal(logs: np.ndarray) -> np.ndarray:
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def spans_of(text: str | None, model: Potentials) -> tuple[list[Node], list[Node]]:
    """Base spans and the spans the field adds."""
    text = text or ""
    base = base_spans(text)
    nodes = all_nodes(text, base)
    if len(nodes) == len(base):
        return base, []
    fixed = np.array([label_of(text, node) for node in nodes])
    # Only a repeat of a known entity, however distant, can be recognised.
    if (fixed == OTHER).all():
        return base, []
    unary = np.stack([model.unary(text, node) for node in nodes])
    known = fixed != OTHER
    unary[known] = -50.0
    unary[known, fixed[known]] = 0.0
    skips = skip_edges(nodes)
    joined = set(skips)
    chain = [(k, k + 1) for k in range(len(nodes) - 1) if (k, k + 1) not in joined]
    edges = np.array(chain + skips, dtype=np.int64).reshape(-1, 2)
    pair = np.concatenate([
        np.broadcast_to(model.chain, (len(chain), *model.chain.shape)),
        np.broadcast_to(model.skip, (len(skips), *model.skip.shape))])
    linked = np.zeros(len(nodes), dtype=bool)
    for i, j in skips:
        linked[[i, j]] = True
    belief = beliefs(unary, edges, pair)
    best = belief[:, :OTHER].argmax(axis=1)
    added = [
        Node(LABELS[best[k]], node.start, node.end, node.text)
        for k, node in enumerate(nodes)
        if node.kind is None and (known[k] or linked[k] and belief[k, best[k]] >= MIN_BELIEF)]
    return base, added


def estimated(docs: DataFrame, text: str = "text") -> Potentials:
    """Potentials from all rows.

    What reaches the driver is one row per feature and label, and per pair of
    labels: a few hundred, whatever the table.
    """
    count = per_value(lambda: counts_of, T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("x", T.IntegerType()),
        T.StructField("y", T.IntegerType()), T.StructField("n", T.LongType())])))
    counted = docs.select(F.explode(count(text)).alias("c")).groupBy("c.name", "c.x", "c.y").agg(F.sum("c.n"))
    return potentials(tuple(row) for row in sorted(counted.collect()))


def finder(spark: SparkSession, model: Potentials) -> Callable[..., Column]:
    """Column function: text to its spans by start, then by kind as listed.

    ``added`` tells the field's spans from base spans.
    """
    shared = spark.sparkContext.broadcast(model)

    def make() -> Callable[[str | None], list[dict]]:
        def one(text: str | None) -> list[dict]:
            base, added = spans_of(text, shared.value)
            spans = [(node, False) for node in base] + [(node, True) for node in added]
            spans.sort(key=lambda span: (span[0].start, LABELS.index(span[0].kind)))
            return [
                {"kind": node.kind, "start": node.start, "end": node.end, "added": extra}
                for node, extra in spans]

        return one

    return per_value(make, T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("added", T.BooleanType())])))
