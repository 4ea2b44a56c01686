"""Suffix dedup against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
from llm_util import LOREM, SF, awkward, empty

from venuelens.llm import suffix_dedup as S


def brute(docs):
    """docs: (doc_id, bytes) in order; kept bytes, removed, spans."""
    seen, out = {}, []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - S.MATCH + 1):
            s = t[p: p + S.MATCH]
            if seen.setdefault(s, (i, p)) != (i, p):
                gone[p: p + S.MATCH] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_equal_windows_are_the_classes():
    rng = np.random.default_rng(0)
    base = rng.integers(97, 100, 400).astype(np.uint8)
    data = np.concatenate([base, base[50:300], base[10:200], rng.integers(97, 99, 200).astype(np.uint8), np.full(150, 97, np.uint8), np.zeros(8, np.uint8)])
    place = np.arange(len(data) - 8 - S.MATCH + 1)
    want, got = defaultdict(set), defaultdict(set)
    for p in place:
        want[data[p: p + S.MATCH].tobytes()].add(int(p))
    members, classes = S.equal_windows(data, place, np.zeros(len(place), np.int64))
    for p, c in zip(place[members], classes):
        got[c].add(int(p))
    assert {frozenset(v) for v in want.values() if len(v) > 1} == {frozenset(v) for v in got.values()}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = S.QUERIES["op2_suffix_dedup"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(docs))


def test_awkward_rows_shared_middles_and_cuts(spark):
    df, rows = awkward(spark)
    extra = [(100 + i, "start %d " % i * 9 + LOREM * 2 + " end %d" % i * 9, "en", "z", 1) for i in range(30)]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.unionByName(more, allowMissingColumns=True)
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in S.deduplicate(df).collect()}
    assert got == set(brute([(r[0], (r[1] or "").encode()) for r in rows + extra]))
    stripped = S.strip(df)
    assert stripped.columns == df.columns and stripped.count() == df.count()
    assert {r.text for r in stripped.where("doc_id = 3").collect()} == {""}
    assert S.deduplicate(empty(spark)).count() == 0


def test_a_hot_anchor_is_sorted_by_place(spark, monkeypatch):
    monkeypatch.setattr(S, "SORT_WINDOWS", 50)
    rng = np.random.default_rng(5)
    line = bytes(rng.integers(97, 123, 120).astype(np.uint8))
    docs = [(i, bytes(rng.integers(97, 123, 80).astype(np.uint8)) + line + bytes(rng.integers(97, 99, 60).astype(np.uint8))) for i in range(40)]
    parts = []
    for i, t in docs:
        data = np.frombuffer(t, np.uint8)
        b = S.blocks(np.array([0, len(t)]), data)
        parts.append([np.full(len(b["row"]), i), np.zeros(len(b["row"]), np.int32), b["first"], b["last"] - b["first"], b["off"], b["anchor"],
                      np.concatenate([data[f: l + S.MATCH] for f, l in zip(b["first"], b["last"])])])
    gone = {i: np.zeros(len(t), bool) for i, t in docs}
    for batch in S._sort_blocks(parts):
        for kid, blob in zip(batch.column("kid").to_pylist(), batch.column("blob").to_pylist()):
            for a, b in S._pairs([blob]):
                gone[kid][a:b] = True
    want = {i: n for i, _, n, _, _ in brute(docs)}
    assert {i: int(g.sum()) for i, g in gone.items()} == want


def test_first_differing_byte_of_every_complementary_pattern():
    for lead in range(8):
        for tail in (0x00, 0x01, 0x7F, 0x80, 0xFE, 0xFF):
            for first in (0x01, 0x7F, 0x80, 0xFF):
                raw = bytes(lead) + bytes([first]) + bytes([tail]) * (7 - lead)
                assert S.leading_zero_bytes(np.array([int.from_bytes(raw, "big")], np.uint64)).tolist() == [lead]


def test_complementary_bytes_end(spark):
    """Two documents whose texts go on with complementary bytes after an equal passage."""
    passage = LOREM[:120]
    docs = [(1, passage + "é" * 80), (2, passage + "<V" * 80), (3, passage + "é" * 80 + passage), (4, "é" * 300), (5, "<V" * 200)]
    df = spark.createDataFrame([(*d, "en", "z", 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in S.deduplicate(df).collect()}
    assert got == set(brute([(i, t.encode()) for i, t in docs]))
