"""The Kneser-Ney model against a dictionary version, and its accuracy on labels."""

import math
from collections import Counter

import numpy as np
import pytest
from llm_util import awkward, empty

from venuelens.llm import quality_lm as Q

TRAIN = ["the cat sat on the mat", "the dog sat on the log 12", "a cat and a dog", "the end of the day\n"]


def reference(texts):
    """gram -> log probability of its last unit, by the textbook formulas."""
    fold = [t.translate({**dict.fromkeys(range(48, 58), "0"), 10: " "}) for t in texts]
    top = Counter()
    for t in fold:
        padded = "\0" * (Q.ORDER - 1) + t
        top.update(padded[i: i + Q.ORDER] for i in range(len(t)))
    tables = {Q.ORDER: top}
    for order in range(Q.ORDER - 1, 0, -1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])
    discounts = {}
    for order, table in tables.items():
        t = {k: sum(v == k for v in table.values()) for k in (1, 2, 3, 4)}
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else None
        d = [0.0]
        for k in (1, 2, 3):
            raw = k - (k + 1) * y * t[k + 1] / t[k] if y is not None and t[k] else 0.5 * k
            d.append(min(max(raw, 0.05), k - 0.05))
        discounts[order] = d

    def p(gram):
        order = len(gram)
        if order == 0:
            return 1 / (len(tables[1]) + 1)
        table, d = tables[order], discounts[order]
        after = [n for g, n in table.items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        weight = sum(d[min(n, 3)] for n in after) / sum(after)
        n = table.get(gram, 0)
        return (n - d[min(n, 3)] if n else 0) / sum(after) + weight * p(gram[1:])

    return p, fold


def rows_of(spark, rows):
    return spark.createDataFrame([(i, f"={lang}", m, t) for i, (lang, m, t) in enumerate(rows)], "doc_id long, _lang string, _m int, text string")


@pytest.mark.parametrize("chunk_bytes", [Q.CHUNK_BYTES, 1])
def test_probabilities_match_the_formulas_whole_and_without_each_fold(spark, chunk_bytes):
    Q.prepare(spark)
    folds = [1, 2, 2, 4]
    table = Q.model(Q.counts(rows_of(spark, [("en", f, t) for f, t in zip(folds, TRAIN)]), chunk_bytes))
    tests = ["the cat sat", "zebra 99", "dog on a day", "\U0001F600 the", ""]
    got = Q.score(rows_of(spark, [("en", m, t) for m in range(Q.MODELS) for t in tests] + [("xx", 0, "no model")]), table, chunk_bytes).collect()
    assert len(got) == Q.MODELS * len(tests) + 1
    models = [reference([t for f, t in zip(folds, TRAIN) if f != m])[0] for m in range(Q.MODELS)]
    for r in got:
        if r._lang == "=xx":
            assert r._n == 0
            continue
        units = "".join(chr(Q._FOLD[u]) for u in np.frombuffer(r.text.encode("utf-16-le"), np.uint16))
        padded = "\0" * (Q.ORDER - 1) + units
        want = sum(math.log(models[r._m](padded[i: i + Q.ORDER])) for i in range(len(units)))
        assert r._n == len(units) and r._ll == pytest.approx(want, rel=1e-5)


def test_grams_by_places_and_by_sorting_agree(monkeypatch):
    rng = np.random.default_rng(4)
    units, at, _ = Q.units_of(["".join(map(chr, rng.integers(97, 110, n))) for n in (0, 3, 50, 400)] + ["香港\U0001F600" * 9])
    first = Q.grams_of(units, at)
    monkeypatch.setattr(Q, "PLACES", 10)
    second = Q.grams_of(units, at)
    assert all((a == b).all() for a, b in zip(first, second))
    assert (np.diff(first[0].astype(object)) > 0).all()
    wide = [sum(int(units[i - j]) << (Q.BITS * j) for j in range(Q.ORDER)) for i in at]
    assert [int(x) for x in first[0][first[1]]] == wide


def test_probabilities_sum_to_one(spark):
    p, _ = reference(TRAIN)
    units = sorted({c for t in TRAIN for c in t.replace("\n", " ").replace("1", "0").replace("2", "0")})
    for context in ("\0\0\0\0", "the ", "zzzz", " cat"):
        assert sum(p(context + u) for u in units) + p(context + "香") == pytest.approx(1)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.1"
    got = Q.QUERIES["op1_quality_kneser_ney"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    clean, junk = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.25 * len(junk)


def test_every_trusted_document_counts_and_calibrates(spark):
    words = ["alpha", "bravo", "carol", "delta", "ember", "fjord", "grape", "heron", "ivory", "joker", "kayak", "lemon"]
    rows = [(i, "en", f"{w} {w} the end") for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    folds = {r._id: r._fold for r in Q._trusted(labels).collect()}
    assert len(set(folds.values())) == Q.FOLDS

    def perplexity(train, text):
        p, _ = reference(train)
        padded = "\0" * (Q.ORDER - 1) + text
        return math.exp(-sum(math.log(p(padded[i: i + Q.ORDER])) for i in range(len(text))) / len(text))

    got = {r.doc_id: r for r in Q.classify(docs, labels).collect()}
    left_out = [perplexity([t for j, _, t in rows if folds[j] != folds[i]], text) for i, _, text in rows]
    for i, _, _ in rows:
        assert got[i].perplexity == pytest.approx(left_out[i], rel=1e-5) and got[i].kept
    assert all(r.threshold == pytest.approx(max(left_out), rel=1e-5) for r in got.values())


def test_a_null_language_is_not_the_empty_one(spark):
    rows = [(i, None if i % 2 else "", ("abc abc " if i % 2 else "xyz xyz ") * 5) for i in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 16, 2)], "doc_id long, quality int, toxic int")
    got = Q.classify(docs, labels).collect()
    assert all((r.perplexity is None) == (r.lang == "") and r.kept for r in got)


def test_awkward_rows(spark):
    df, rows = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (8, 1, None), (10, 0, 0), (None, 1, 0), (2, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    got = Q.classify(df, labels).collect()
    assert len(got) == len(rows)
    assert all(not r.kept and r.perplexity is None for r in got if not r.text)
    assert Q.keep(df, labels).columns == df.columns
    assert Q.keep(df, labels.limit(0)).count() == sum(bool(r[1]) for r in rows)
    assert Q.keep(empty(spark), labels).count() == 0
