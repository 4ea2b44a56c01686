"""The conversation trie against a dictionary of prefixes."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_util import SF

from venuelens.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """rows: (conv_id, turn, role, text); the contract's columns of every node."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))  # as SQL has it below zero
        path = tuple(convs.get(base, [])[:h] + own[h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("least", [4096, 3])
def test_query_matches_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(T, "LEAST_SHARD", least)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(T.QUERIES["op11_prefix_trie"](spark, SF)) == brute(rows)


@pytest.mark.parametrize("least", [4096, 5])
def test_hot_prefixes_ties_nulls_and_clashing_names(spark, monkeypatch, least):
    monkeypatch.setattr(T, "LEAST_SHARD", least)
    monkeypatch.setattr(T, "SHARDS", 1)
    monkeypatch.setattr(T, "BLOCK", 4)
    rng = np.random.default_rng(1)
    rows = [(c, t, "user", "common %d" % t) for c in range(200, 320) for t in range(int(rng.integers(1, 9)))]  # a hot prefix
    rows += [(c, t, "user", "ab"[int(rng.integers(2))]) for c in range(400, 520) for t in range(int(rng.integers(1, 12)))]
    rows += [(700, t, "user", "long %d" % (t % 3)) for t in range(60)] + [(701, t, "user", "long %d" % (t % 3)) for t in range(60)]
    rows += [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (1, 0, "a", "z"), (1, 0, "a", "\U0001F600 y"), (1, None, "b", "x" * 5000)]
    rows += [(None, 0, "user", "nobody's"), (-5, 0, "user", "below zero"), (-105, 1, "user", "below zero"), (0, 0, "user", ""), (150, 0, "user", "turnless without its base")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("c", "i", "n", "h", "depth", "parent", "root", "own", "y1", "base"):
        df = df.selectExpr("*", f"1 as `{name}`")
    assert rows_of(T.trie(df)) == brute(rows)


def test_no_rows_no_nodes(spark):
    assert T.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_spilling_queue_gives_the_same_sums():
    rng = np.random.default_rng(2)
    queue, want = T.Queue(held=50), defaultdict(int)
    for _ in range(40):
        part = np.zeros(17, T._MESSAGE)
        part["to"], part["saved"] = rng.integers(0, 300, 17), rng.integers(0, 9, 17)
        for to, s in zip(part["to"].tolist(), part["saved"].tolist()):
            want[to] += s
        queue.push(part)
    assert any(isinstance(r, np.memmap) for r in queue.runs)
    got = {}
    for last in (20, 21, 150, 299):
        for m in queue.take(last):
            assert m["to"] not in got and m["to"] <= last
            got[int(m["to"])] = int(m["saved"])
    assert got == dict(want)
