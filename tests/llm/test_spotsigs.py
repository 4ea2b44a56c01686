"""SpotSigs against sets in Python."""

import hashlib

import pytest
import regex
import xxhash
from llm_util import SF, awkward, empty

from venuelens.llm import spotsigs as S


def spec(text):
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).strip(" ").split(" ")
    content = [(i, w) for i, w in enumerate(words) if w and w not in S.ANCHORS]
    chains = {" ".join(w for _, w in content[j: j + S.CHAIN]) for j, (i, _) in enumerate(content) if i and words[i - 1] in S.ANCHORS}
    return {xxhash.xxh64_intdigest(c.encode(), 42) >> 24 for c in chains or {" " + " ".join(words) + " "}}


def spell(sigs):
    return "".join(f"{x:010x}" for x in sorted(sigs))


def alike(a, b):
    return len(a & b) / len(a | b)


def check(rows, docs):
    """docs: (doc_id, text), ids distinct."""
    docs = sorted(((i, t or "") for i, t in docs), reverse=True, key=lambda d: (d[0] is not None, d[0]))
    got = {r.doc_id: r for r in rows}
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r, own = got[i], spec(text)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (spell(own), spell(spec(edited)))
        assert r.near_edited == pytest.approx(alike(own, spec(edited))) and r.near_next == pytest.approx(alike(own, spec(following)))


def test_query_matches_sets(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(S.QUERIES["op4_spotsigs_fingerprints"](spark, SF).collect(), docs)


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    assert S.compare_edits(df).count() == len(rows)
    single = df.dropDuplicates(["doc_id"])
    check(S.compare_edits(single).collect(), [(r.doc_id, r.text) for r in single.collect()])
    one = df.where("doc_id = 8")
    assert [r.near_next for r in S.compare_edits(one).collect()] == [1.0]
    assert S.compare_edits(empty(spark)).count() == 0


def test_near_duplicates_match_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").collect()]
    members, links = S.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'"))
    of = {r.doc_id: r.class_id for r in members.collect()}
    sets = {of[i]: spec(t) for i, t in docs}
    names = sorted(sets)
    want = {
        (a, b) for x, a in enumerate(names) for b in names[x + 1:]
        if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and alike(sets[a], sets[b]) >= 0.8
    }
    assert {(r.a, r.b) for r in links.collect()} == want and want
    assert all((of[i] == of[j]) == (spec(t) == spec(u)) for i, t in docs[:40] for j, u in docs[:40])
