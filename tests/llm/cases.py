"""Documents with every awkward case, and plain-Python versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, _hits string, k int, tokens string, label string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def awkward():
    """(doc_id, text): NULLs, empty and blank texts, repeated rows and ids, ties, a very long text."""
    long_text = " ".join(f"w{i % 997}x{i % 13}" for i in range(40_000))
    prose = "One two three four five. " * 3 + "Six seven, eight nine; ten eleven twelve."
    return [(1, None), (2, ""), (3, " \n\t "), (4, prose), (4, prose), (5, prose), (None, prose), (None, None),
            (6, long_text), (7, "É ß 日本語   \u0085 𝒳\n\nx"), (8, "a"), (9, "A b C"), (10, "a b c d"),
            (11, prose.upper()), (12, "a" * 1500)]


def frame(spark, rows):
    """The rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "h", 7, "t", "l") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *cols):
    """The rows as a multiset."""
    return Counter(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def repeats(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) by comparing all strings of ``length`` bytes."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p: p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        cover = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p: p + length]] > 1:
                cover[p: p + length] = b"\1" * length
        runs = sum(1 for p, c in enumerate(cover) if c and not (p and cover[p - 1]))
        kept = bytes(b for b, c in zip(r, cover) if not c)
        out.append((len(r), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingle_set(text, width=4):
    w = words((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i: i + width]) for i in range(max(1, len(w) - width + 1))}


def components(ids, texts, percent=85, width=4):
    """(n_shingles, smallest id of the component) of each row by comparing all pairs."""
    sets = [shingle_set(t, width) for t in texts]
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b:
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(least.get(root(i), x), x)
    return [(len(s), least.get(root(i)) if s else ids[i]) for i, s in enumerate(sets)]
