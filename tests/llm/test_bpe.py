"""Byte-level BPE against the library on whole texts."""

import hashlib
import random

import numpy as np
from llm_util import SF, awkward, empty

from venuelens.llm import bpe as B


def check(rows, texts):
    """rows (ids, decoded) against texts, as multisets."""
    encoder = B._encoder(B.default_vocabulary(), B.default_pattern())
    want = sorted((np.array(encoder.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for t in texts)
    assert sorted((bytes(r.ids), bytes(r.decoded)) for r in rows) == want


def test_query_matches_the_library(spark):
    encoder = B._encoder(B.default_vocabulary(), B.default_pattern())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = B.QUERIES["op5_bpe_distinct_words"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = encoder.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_texts(spark):
    rng = random.Random(3)
    parts = [" ", "\n", "'", "s", "a", "é", "1", "ß", " ", "　", "​", "!", "\x1f", "­", "\U0001D7D8", "ʼ", "\t", "ོ", "ิ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += [" " * 3000 + "b", "a" * 5000, "<|endoftext|>", "it's 's don't", "\U0001F600\U0001F600"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(B.decode(B.encode(df)).collect(), texts)


def test_awkward_rows_and_chunks_of_equal_content(spark, monkeypatch):
    df, rows = awkward(spark)
    check(B.decode(B.encode(df)).collect(), [r[1] for r in rows])
    monkeypatch.setattr(B, "CHUNK_BYTES", 1)
    twice = df.repartition(3).unionAll(df)
    check(B.decode(B.encode(twice)).collect(), [r[1] for r in rows] * 2)
    assert B.decode(B.encode(empty(spark))).count() == 0
