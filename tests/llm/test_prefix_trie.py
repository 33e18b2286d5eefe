from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from dispersa.llm import prefix_trie as P
from tests.llm import cases

SCHEMA = "conv_id long, turn long, role string, text string, path string, words string, depth int, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "w", 3, 4) for r in rows], SCHEMA)


def brute(rows, every=20, borrowed=4):
    """Nodes of the trie from dictionaries of whole prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % borrowed
        rest = abs(c) % every * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(c - rest, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in built.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    out = set()
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ids = ",".join(map(str, sorted(ends[p])))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]),
                 sum(1 for q in below if not children[q]), saved, hashlib.sha256(ids.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


def made(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 7])):
            rows.append((c, t, ("user", "assistant")[t % 2], " ".join(["word"] * rng.choice([1, 1, 1, 2, 3]))))
    return rows


AWKWARD = [(301, None, None, None), (301, 0, "user", None), (301, 4, "a", "b c"), (302, 0, "user", "x \t y\n\u0085z"),
           (None, 0, "user", "no id"), (303, 1, "user", "same"), (303, 2, "user", "same"), (303, 2, "user", "same"),
           (-7, 0, "user", "word"), (-19, 0, "u", "v"), (305, 0, "user", "q " * 30000)]


@pytest.mark.parametrize("shard_turns", [1 << 17, 40, 3])
def test_trie_equals_dictionaries(spark, shard_turns):
    rows = made(shard_turns) + AWKWARD + [(1000 + c, t, "user", f"copy {t}") for c in range(90) for t in range(6)]
    got = P.prefix_trie(P.rebuild(frame(spark, rows).repartition(6)), shard_turns=shard_turns).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(rows)


def test_long_paths_and_many_splitters(spark):
    # Conversations that part after more turns than a splitter has, and one long one.
    rows = [(c, t, "user", "deep" if t < 100 else f"{c}") for c in range(20, 40) for t in range(104)]
    rows += [(40, t, "assistant", f"{t} word") for t in range(300)]
    got = P.prefix_trie(P.rebuild(frame(spark, rows)), shard_turns=50).collect()
    assert {tuple(r) for r in got} == brute(rows)


def test_ids_are_joined_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "ID_BLOCK", 16)
    rows = [(c, 0, "user", "one text") for c in range(-40, 200)]
    got = P.prefix_trie(P.rebuild(frame(spark, rows))).collect()
    assert {tuple(r) for r in got} == brute(rows)


def test_empty_table(spark):
    empty = frame(spark, AWKWARD).where("conv_id > 1000")
    assert P.prefix_trie(P.rebuild(empty)).count() == 0
    only_null = frame(spark, [(None, 0, "user", "x")])
    assert P.prefix_trie(P.rebuild(only_null)).count() == 0


def test_awkward_documents_as_turns(spark):
    rows = [(i, 0, "user", t) for i, t in {i: t for i, t in cases.awkward()}.items()]
    assert {tuple(r) for r in P.prefix_trie(P.rebuild(frame(spark, rows))).collect()} == brute(rows)
