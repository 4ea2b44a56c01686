"""SimHash groups against brute force."""

import numpy as np
import pandas as pd
import xxhash
from llm_util import SF, awkward, empty

from venuelens.llm import simhash as S
from venuelens.llm.components import components


def spec(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def brute(prints):
    """prints: (doc_id, fp); the least doc_id reachable."""
    fps = sorted({f for _, f in prints})
    u = np.array(fps, np.uint64)
    root = list(range(len(u)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= 4) + i + 1:
            root[find(int(j))] = find(i)
    at = {f: find(i) for i, f in enumerate(fps)}
    least = {}
    for i, f in prints:
        if i is not None:
            least[at[f]] = min(least.get(at[f], i), i)
    return sorted((i, least.get(at[f])) for i, f in prints if i is not None)


def test_words_two_bits_apart_share_an_index_and_prints_four_bits_apart_a_key():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for bits in range(5):
        y = x.copy()
        for _ in range(bits):
            y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        first = S.first_common_key(x, y)
        assert (first >= 0).all()
        rows, keys = S.keys_of(x[:50])
        for i in range(50):
            other = S.keys_of(y[i: i + 1])[1]
            assert min(set(keys[rows == i]) & set(other)) == first[i]


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = [(i, spec(t)) for i, t in docs]
    got = S.QUERIES["op9_simhash_golay"](spark, SF).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(prints) and all(len(r.fingerprint) == 16 for r in got)
    assert sorted((r.doc_id, r.component_id) for r in got) == brute(prints)


def test_large_keys_get_the_second_pass(spark, monkeypatch):
    """Two dense clusters that meet in one pair only, with a window far below the keys' sizes."""
    monkeypatch.setattr(S, "WINDOW", 2)
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**62))
    near = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (150, 2)) if a != b}
    far = {f ^ 0b111 << 40 ^ 1 << 5 for f in list(near)[:60]}
    prints = [(i, f) for i, f in enumerate(sorted(near | far))]
    frame = pd.DataFrame({"doc_id": [p[0] for p in prints], "fp": np.array([p[1] for p in prints], np.uint64).view(np.int64)})
    got = S.groups(spark.createDataFrame(frame)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == brute(prints)


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    got = S.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == brute([(r[0], spec(r[1])) for r in rows])
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(i for i, c in brute([(r[0], spec(r[1])) for r in rows]) if i == c)
    assert S.near_duplicates(empty(spark)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
