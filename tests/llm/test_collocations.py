"""Collocations against counters of tuples."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_util import SF, awkward, empty

from venuelens.llm import collocations as C

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, least=30, limit=2000):
    """docs: (lang, text); the contract's rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i: i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        gone = set()
        for longer, c in found.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    g = longer[i: i + k]
                    if 100 * c >= 80 * counts[g]:
                        gone.add(g)
        rows = []
        for g, a in found.items():
            if g not in gone:
                score, _, l, r = min((2000000 * a // (counts[g[:k]] + counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:limit])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_matches_counters(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert len(want) > 20 and rows_of(C.QUERIES["op13_collocations"](spark, SF)) == want


@pytest.mark.parametrize("pack,buckets,limit", [(2000, 23, 2000), (500, 9, 12)])
def test_hot_words_over_many_packs_and_buckets(spark, pack, buckets, limit):
    rng = np.random.default_rng(pack)
    words = ["The", "the", "of", "é", "x\x85y", "\U0001F600", "new", "York", "A", "b", "c", "d", "e"]
    draw = lambda n: [words[i] for i in rng.choice(len(words), n, p=[0.2, 0.2, 0.1] + [0.05] * 10)]
    docs = [(["en", "de", None, "und"][i % 4], "".join(w + [" ", "  ", "\t", ". ", "\n", ","][int(rng.integers(6))] for w in draw(int(rng.integers(0, 80))))) for i in range(150)]
    docs += [("en", "same line again and again\n" * 200), ("en", None), ("de", ""), ("fr", "one two three four five six. " * 35), ("fr", "two three " * 31)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(12)
    table = C.counts(df, 5, pack, buckets)
    assert rows_of(C.top(table, C.candidates(table), limit)) == brute(docs, 5, limit)


def test_awkward_rows_and_no_rows(spark):
    df, rows = awkward(spark)
    assert rows_of(C.collocations(df, 3)) == brute([(r[2], r[1]) for r in rows], 3)
    assert C.collocations(empty(spark)).count() == 0
