"""Small tables and plain references the corpus tests share."""

from __future__ import annotations

import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

# Nulls, blanks, ties, repeated rows, long words and texts.
ODD_TEXTS = [
    None, "", " ", "\n\n", "\t \x0b\x0c\r\n", "a", "a b c d", "word " * 60, "x" * 5000, "é ß 日本 🙂 é",
    "\x1c\x1d\x85\xa0 ", "<|endoftext|>", "a" * 3 + " " * 40 + "b", "Same text here.", "Same text here.",
]


def frame(spark, texts, sources=None, ids=None):
    """Documents with the given texts; ids count up unless given."""
    rows = [
        (k if ids is None else ids[k], text, "en", f"s{k % 3}" if sources is None else sources[k],
         None if text is None else len(text))
        for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def stored(df, folder, name="documents"):
    """Writes a table where a query finds it; returns the folder."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def words(text):
    return WORD.findall(text or "")


def shingle_set(text):
    found = words((text or "").translate(LOWER))
    if not found:
        return frozenset()
    size = min(5, len(found))
    return frozenset(tuple(found[k:k + size]) for k in range(len(found) - size + 1))


def brute_components(rows, similarity=75):
    """Smallest reachable id of each (id, text), by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= similarity * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for k, (number, _) in enumerate(rows):
        known = least.get(root(k))
        least[root(k)] = number if known is None else known if number is None else min(known, number)
    return [least[root(k)] for k in range(len(rows))]
