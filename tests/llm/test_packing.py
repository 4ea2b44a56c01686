"""Packing: pieces cover their documents, sequences are gapless, little padding."""

import zlib

import numpy as np
import pytest
from llm_util import SF, awkward, empty
from tokenizers import Tokenizer

from venuelens.llm import packing as P


def check(rows, texts):
    """rows of pack(); texts: {doc_id: text}, ids distinct. The share of padding."""
    tokenizer = Tokenizer.from_file(P.default_vocabulary())
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], np.uint32) for i, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i]) and r.length > 0
            at += r.length
            assert zlib.crc32(ids[i][r.start: at].tobytes()) == r.ids_crc32
        assert at == len(ids[i])
    padding = total = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= P.CAPACITY
        total += at
        padding += 0 if at & (at - 1) == 0 else P.CAPACITY - at
    return padding / max(total, 1)


def test_query_covers_and_packs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert check(P.QUERIES["op3_packing_harmonic"](spark, SF).collect(), texts) < 0.03


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    single = df.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(P.pack(single).collect(), {r.doc_id: r.text for r in single.collect()})
    assert P.pack(df).groupBy().sum("length").head()[0] == sum(P.token_ids([(r[1] or "").encode() for r in rows], P.default_vocabulary())[0][-1:])
    assert P.pack(empty(spark)).count() == 0
    out = {r.sequence_id: np.frombuffer(r.ids, np.uint32) for r in P.sequences(single).collect()}
    assert sum(map(len, out.values())) == P.pack(single).groupBy().sum("length").head()[0] and max(map(len, out.values())) <= P.CAPACITY


def test_words_apart_give_the_ids_of_the_whole_text():
    texts = ["ΟΔΟΣ Σ ΣΑΣ", "x <|endoftext|> y", "Ⅷ ½ ǅ ﬁ e\u0301 \u0301", "it'LL don'T ''s", "Hello  World\n it's", "a\x1cb c d", "á b ́c", "", " ", "don 't İI ẞ", "日本 12 3"]
    tokenizer = Tokenizer.from_file(P.default_vocabulary())
    edge, ids = P.token_ids([t.encode() for t in texts], P.default_vocabulary(), None)
    for t, a, b in zip(texts, edge, edge[1:]):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_cuts_are_whole_classes():
    lengths = np.arange(1, 13000, 7)
    doc, start, size = P.cuts(lengths)
    assert (np.bincount(doc, weights=size) == lengths).all() and size.max() <= P.CAPACITY
    k = P.CAPACITY // size
    assert (k * size <= P.CAPACITY).all()
    assert (P.CAPACITY - k * size).mean() < 40


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_never_overfills(seed):
    lengths = np.random.default_rng(seed).integers(1, 4097, 300)
    found = P._best_fit(lengths, P.CAPACITY)
    assert np.bincount(found, weights=lengths).max() <= P.CAPACITY
