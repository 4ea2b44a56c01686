"""De Bruijn dedup over words against brute force."""

import hashlib
import re

import numpy as np
import pytest
from llm_util import LOREM, SF, awkward, empty
from pyspark.sql import functions as F

from venuelens.llm import debruijn as D

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    """docs: (doc_id, text); the contract's columns."""
    seen, out = {}, []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        w = WORD.findall(t or "")
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - D.K + 1):
            if seen.setdefault(tuple(w[p: p + D.K]), (i, p)) != (i, p):
                gone[p: p + D.K] = True
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in D.QUERIES["op12_de_bruijn_dedup"](spark, SF).collect()), key=repr) == want
    # many packs and folds: blocks and edges settled across them
    assert result(D.deduplicate(docs, pack_bytes=20_000, fold_edges=50)) == want


@pytest.fixture
def apart(spark):
    """Small partitions stay tasks of their own, so that equal edges meet across tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def planted(rng):
    """Passages shared whole and in part, inside changing text, over many documents; periodic text."""
    vocabulary = ["w%d" % i for i in range(400)] + ["é x", "\U0001F600", "a,b"]
    draw = lambda n: [vocabulary[i] for i in rng.integers(0, len(vocabulary), n)]
    passage, line, other = draw(90), draw(24), draw(45)
    docs = []
    for i in range(120):
        w = draw(int(rng.integers(0, 40)))
        if i % 3 == 0:
            w += line
        if i % 4 == 1:
            a = int(rng.integers(0, 40))
            w += passage[a: a + int(rng.integers(15, 60))]
        w += draw(int(rng.integers(0, 30)))
        if i % 5 == 2:
            w += other + draw(3) + other[:25]
        docs.append((i, "\t \n".join(w)))
    docs += [(1000 + i, " ".join((["x", "y", "z"] * 40)[i: 60 + 7 * i])) for i in range(8)]
    docs += [(2000, " ".join(passage * 3)), (2001, " ".join(passage[:19])), (2002, " ".join(passage[:20]))]
    return docs


@pytest.mark.parametrize("seed", [0, 1])
def test_shared_passages_over_many_tasks(spark, apart, seed):
    docs = planted(np.random.default_rng(seed))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(24)
    assert result(D.deduplicate(df, pack_bytes=300 if seed else 2000, fold_edges=40)) == brute(docs)


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    extra = [(100 + i, "start %d " % i * 9 + LOREM * 2 + " end %d" % i * 9, "en", "z", 1) for i in range(30)]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.unionByName(more, allowMissingColumns=True)
    assert result(D.deduplicate(df)) == brute([(r[0], r[1]) for r in rows + extra])
    assert D.deduplicate(empty(spark)).count() == 0


def test_long_spans_equal_their_source(spark, apart):
    docs = planted(np.random.default_rng(7))
    words = {i: WORD.findall(t) for i, t in docs}
    found = D.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(24), 500, 40).collect()
    assert any(s.end - s.first > 25 for s in found) and len({s.path for s in found if s.path is not None}) > 1
    for s in found:
        n = s.end - s.first
        assert words[s.kid][s.first: s.end] == words[s.src_kid][s.src_first: s.src_first + n] and (s.src_kid, s.src_first) < (s.kid, s.first)


def test_paths_stop_where_the_graph_branches(spark):
    """a-b-c-d over four pieces, a branch after b, and a cycle."""
    rows = [(h, n, m, h, 0, 1) for h, n, m in [(1, 10, 11), (2, 11, 12), (3, 12, 13), (4, 12, 14), (5, 14, 15), (6, 20, 21), (7, 21, 20)]]
    df = spark.createDataFrame(rows, "h long, enters long, leaves long, kid long, first int, n int").withColumns(
        {"is_source": F.lit(True), "tag": F.lit(0)})
    got = {r.h: r.path for r in D.paths(df).collect()}
    assert got[1] == got[2] and got[4] == got[5] and got[6] == got[7]
    assert len({got[1], got[3], got[4], got[6]}) == 4
