"""Small tables with the awkward cases, and plain versions of the operators to compare with."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PASSAGE = "this passage of more than thirteen words stands in several of the documents here today and again"
DOCS = [
    (1, "Alpha beta gamma delta. " * 8, "en", "a", 1),
    (2, f"one two three {PASSAGE} four five", "en", "a", 1),
    (3, f"{PASSAGE}\nand then some other words follow here", "en", "b", 1),
    (4, f"one two three {PASSAGE} four five", "en", None, 1),
    (4, f"one two three {PASSAGE} four five", "en", None, 1),
    (5, None, "en", "b", None),
    (6, "", None, "b", 0),
    (7, " \t\n ", "en", "c", 4),
    (8, "word " * 5000, "de", "c", 25000),
    (9, "Ünïcödé 漢字 😀 text's end<|im_end|>", "fr", "d", 3),
    (10, "x", "en", "d", 1),
    (None, f"{PASSAGE} without an id", "en", "d", 1),
    (None, "another without an id", None, None, 1),
    (11, "A" * 3000, "en", "a", 3000),
    (12, PASSAGE.upper(), "en", "a", 90),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("size", "copies", "target", "source_size", "n_words", "N_REMOVED", "factors", "score", "ids", "decoded", "n_tokens")


def documents(spark, rows=DOCS, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def clashing(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("clash") for c in CLASH})


def words(text):
    return WORD.findall((text or "").encode())


def removed(rows, window=13):
    """Per row the kept words: those in no run that stands in a document with a smaller id."""
    order = [float("inf") if i is None else i for i, _ in rows]
    low = {}
    for at, (_, text) in zip(order, rows):
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            low[key] = min(low.get(key, at), at)
    out = []
    for at, (_, text) in zip(order, rows):
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if low[tuple(w[k:k + window])] < at:
                gone.update(range(k, k + window))
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def simhash(text, shingle=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(shingle, len(w))
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k:k + n]), 42) for k in range(len(w) - n + 1)] if n else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def linked(prints, bits=3):
    """The root (smallest position) of every fingerprint's component, by comparing all with all."""
    f, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]
