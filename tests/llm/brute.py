"""Plain Python versions of what the operators must give."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

TRICKY = [
    (1, "The quick brown fox jumps over the lazy dog. " * 12),
    (2, "the QUICK brown fox jumps over the lazy dog. " * 12),
    (3, None),
    (4, ""),
    (5, " \n\t \n"),
    (6, "one two"),
    (7, "one two"),
    (8, "one two three"),
    (None, "no id here but some words in a row"),
    (9, "é" * 450),
    (10, "x" * 1200),
    (11, "ab" * 600 + " tail"),
    (12, " ".join(f"w{i}" for i in range(3000))),
    (13, " ".join(f"w{i}" for i in range(1, 3000))),
    (14, "line one is here\nline two is here\nline three is here"),
    (14, "line one is here\nline two is here\nline three is here"),
    (15, "LINE one is here\na line of its own, never seen\n\nline two is here"),
    (16, "don't stop <|endoftext|> 3.14 naïve?! Á ok"),
]
SCHEMA = "doc_id bigint, text string, row string, label int, node string, n string"


def frame(spark, rows=TRICKY):
    """The rows with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "r", 1, "x", None) for i, t in rows], SCHEMA)


def words(text: str | None) -> list[bytes]:
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", low)


def shingles(text: str | None, k: int = 5) -> set:
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def joined(n: int, links) -> list[int]:
    """For each of n items the smallest item it is connected with."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def similar(sets: list[set], test) -> list[tuple[int, int]]:
    return [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and test(len(sets[a] & sets[b]), len(sets[a] | sets[b]))]


def without_repeats(texts: list[bytes], window: int = 200) -> list[tuple]:
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out
