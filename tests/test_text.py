"""Text mining: lexicon longest match on Chinese, keyword priority, TextRank vs NumPy."""

import math
import os
import time

import numpy as np
from pyspark.sql import functions as F

from venuelens import dims
from venuelens.operators import text as T


def test_lexicon_longest_match_chinese(spark):
    df = spark.createDataFrame([(1, "这家的麻婆豆腐不好吃，红烧肉好吃")], "id long, text string")
    terms = [t for ts in dims.SENTIMENT_DICT["负面"].values() for t in ts] + \
            [t for ts in dims.SENTIMENT_DICT["正面"].values() for t in ts]
    toks = [r.token for r in T.tokenize_lexicon(df, "id", "text", terms).collect()]
    assert toks == ["不好吃", "好吃"]                     # the longer overlapping term wins at a position
    dishes = [r.dish for r in T.extract_dishes(df, "id", "text", dims.POPULAR_DISHES_DICT, mode="longest").collect()]
    assert sorted(dishes) == ["红烧肉", "麻婆豆腐"]


def test_cjk_token_rule_drops_single_characters(spark):
    df = spark.createDataFrame([(1, "香 好吃 我们 很好 a 服务员热情")], "id long, text string")
    toks = T.remove_stopwords(T.tokenize(df, "id", "text"), dims.STOP_WORDS)
    assert sorted(r.token for r in toks.collect()) == ["好吃", "很好", "服务员热情"]   # one-character words never match (Q17)


def test_prioritized_topn_ties_by_word(spark):
    counts = spark.createDataFrame([("b", 5), ("a", 5), ("lex", 1), ("c", 9)], "word string, count long")
    got = [(r.word, r.rank) for r in T.prioritized_topn(counts, ["lex"], 3).orderBy("rank").collect()]
    assert got == [("lex", 1), ("c", 2), ("a", 3)]


def test_lexicon_sentiment_score(spark):
    lex = {"pos": {"x": ["good"]}, "neg": {"x": ["bad"]}}
    df = spark.createDataFrame([(1, "good good bad"), (2, "nothing"), (3, "Bad")], "id long, text string")
    got = {r.id: r.score for r in T.lexicon_sentiment(df, "id", "text", lex, "pos", "neg").collect()}
    assert got == {1: round(1 / 3, 4), 2: 0.0, 3: -1.0}


def test_edges_exchange_tokens_once_and_count_repeated_documents(spark):
    rows = [(1, 0, "a"), (1, 1, "b"), (1, 3, "c"), (1, 0, "a"), (1, 1, "b"), (None, 0, "a"), (None, 1, "z")]
    toks = spark.createDataFrame(rows, "id long, pos int, token string")
    got = {(r.u, r.v): r.w for r in T.cooccurrence_edges(toks, "id", 3).collect()}
    want = {}
    for i, p, u in rows:
        for j, q, v in rows:
            if i is not None and i == j and 0 < q - p < 3 and u != v:
                want[u, v] = want.get((u, v), 0) + 1
                want[v, u] = want.get((v, u), 0) + 1
    assert got == want
    plan = T.cooccurrence_edges(toks, "id", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan


def test_textrank_matches_power_iteration(spark):
    docs = [(1, "a b c a b"), (2, "b c d"), (3, "d a c")]
    df = spark.createDataFrame(docs, "id long, text string")
    toks = T.tokenize(df, "id", "text", "[a-z]+", with_position=True)
    got = {r.word: r.score for r in T.textrank_keywords(toks, "id", window=2, iterations=30, n=10).collect()}
    # reference computation
    words = sorted({w for _, t in docs for w in t.split()})
    ix = {w: i for i, w in enumerate(words)}
    wgt = np.zeros((len(words), len(words)))
    for _, t in docs:
        s = t.split()
        for i in range(len(s) - 1):
            if s[i] != s[i + 1]:
                wgt[ix[s[i]], ix[s[i + 1]]] += 1
                wgt[ix[s[i + 1]], ix[s[i]]] += 1
    p = wgt / wgt.sum(axis=1, keepdims=True)
    r = np.ones(len(words))
    for _ in range(30):
        r = 0.15 + 0.85 * p.T @ r
    for w in words:
        assert abs(got[w] - r[ix[w]]) < 1e-5


def test_pairs_across_chunks_count_once(monkeypatch):
    """Chunks of few tokens and portions of few pairs, cut inside documents and inside repeated positions."""
    import pyarrow as pa
    from venuelens.operators import wordgraph as G
    rng = np.random.default_rng(11)
    docs = [sorted((int(p), f"w{int(t)}") for p, t in zip(rng.integers(0, 30, n), rng.integers(0, 9, n), strict=True)) for n in (0, 1, 40, 3, 25, 60)]
    for window in (2, 3, 5):
        rows = [(t, window if i == 0 else min(window, p - d[i - 1][0])) for d in docs for i, (p, t) in enumerate(d)]
        want = {}
        for d in docs:
            for i, (p, t) in enumerate(d):
                for q, v in d[i + 1:]:
                    if 0 < q - p < window and t != v:
                        want[frozenset((t, v))] = want.get(frozenset((t, v)), 0) + 1
        table = pa.table({"token": [t for t, _ in rows], "gap": pa.array([g for _, g in rows], pa.int32())})
        for chunk, portion, batch in ((10 ** 6, 10 ** 6, 1000), (10, 1, 4), (7, 5, 1), (1, 3, 2)):
            monkeypatch.setattr(G, "CHUNK_TOKENS", chunk)
            monkeypatch.setattr(G, "PORTION", portion)
            got = {}
            for words, u, v, w in G._chunks(iter(table.to_batches(max_chunksize=batch)), window):
                for a, b, c in zip(words.take(pa.array(u)).to_pylist(), words.take(pa.array(v)).to_pylist(), w.tolist(), strict=True):
                    got[frozenset((a, b))] = got.get(frozenset((a, b)), 0) + c
            assert got == want, (window, chunk)


def _files(folders):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for top in folders for d, _, names in os.walk(top) for f in names if os.path.exists(os.path.join(d, f))}


def test_textrank_leaves_nothing_on_disk_but_its_words(spark):
    """Shuffle files go with the job that needed them, the graph goes with the ranks."""
    from venuelens.session import checkpoint_dir
    docs = spark.range(2000).select(F.col("id"), F.expr("concat_ws(' ', transform(sequence(1, 60), i -> concat('w', conv(pmod(hash(id, i), 997), 10, 26))))").alias("text"))
    toks = T.tokenize(docs.repartition("id"), "id", "text", "[a-z]+", with_position=True)
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = _files([*dirs, folder])
    assert len(T.textrank_keywords(toks, "id", iterations=3, n=10).collect()) == 10
    time.sleep(1)
    left = {f: n for f, n in _files([*dirs, folder]).items() if f not in before}
    assert sum(n for f, n in left.items() if "shuffle_" in f) < 20_000, left      # the ten rows' own
    assert sum(n for f, n in left.items() if f.startswith(folder)) < 20_000, left


def test_tag_services_bounded_by_dictionary(spark):
    df = spark.createDataFrame([(1, "适合约会，也适合朋友聚会，可以停车"), (2, "无")], "id long, text string")
    tags = {r.id: r.tags for r in T.tag_services(df, "id", "text", dims.SCENE_DICT, mode="longest").collect()}
    assert tags == {1: ["约会", "聚餐"], 2: []}
    assert F is not None


def test_cjk_segmentation_around_lexicon(spark):
    df = spark.createDataFrame([(1, "这家的麻婆豆腐不好吃服务热情，香")], "id long, text string")
    pat = T.cjk_segment_pattern(["不好吃", "好吃", "热情", "麻婆豆腐", "香"])
    toks = [r.token for r in T.tokenize(df, "id", "text", pat).collect()]
    assert toks == ["这家的", "麻婆豆腐", "不好吃", "服务", "热情", "香"]


def test_review_keywords_chinese(spark):
    rows = [(1, "麻婆豆腐好吃，环境好，香", 5.0, 1.0, 3), (2, "服务员热情，麻婆豆腐好吃", 4.5, 1.0, 2),
            (3, "太咸了，服务差", 2.0, -1.0, 1)]
    rv = spark.createDataFrame(rows, "review_id long, text string, rating double, sentiment double, ts long")
    lex = dims.flatten_polarity(dims.SENTIMENT_DICT)
    got = {(r.polarity, r.word): r["count"] for r in T.review_keywords(rv, lex, n=5).collect()}
    assert got[(dims.POSITIVE, "好吃")] == 2 and got[(dims.POSITIVE, "麻婆豆腐")] == 2
    assert (dims.POSITIVE, "服务员") not in got                  # stop word
    assert (dims.POSITIVE, "香") not in got                      # one character (Q17)
    assert got[(dims.NEGATIVE, "太咸")] == 1 and got[(dims.NEGATIVE, "服务差")] == 1


def test_tfidf_is_the_same_whatever_is_hot(spark, tables, monkeypatch):
    texts = tables.review_text()
    found = []
    for hot in (1, 30, 10 ** 9):      # one word at most, some words, every word goes the broadcast way
        monkeypatch.setattr(T, "HOT_WORD", hot)
        found.append(sorted(T.tfidf_keywords(texts, "review_id", "text", 5).collect()))
    assert found[0] == found[1] == found[2] and found[0]


def test_textrank_to_a_proven_bound(spark):
    """Two word groups that one pair joins mix slowly; with a tolerance the scores are those of the linear system."""
    docs = [(1, "a b c a b c b"), (2, "x y z x z y x"), (3, "c x"), (4, ""), (5, None)]
    df = spark.createDataFrame(docs, "id long, text string")
    toks = T.tokenize(df, "id", "text", "[a-z]+", with_position=True)
    got = {r.word: r.score for r in T.textrank_keywords(toks, "id", window=2, n=10, tolerance=1e-7).collect()}
    words = sorted({w for _, t in docs[:3] for w in t.split()})
    weight = np.zeros((len(words), len(words)))
    for _, t in docs[:3]:
        s = [words.index(w) for w in t.split()]
        for i, j in zip(s, s[1:]):
            weight[i, j] += 1
            weight[j, i] += 1
    p = weight / weight.sum(axis=1, keepdims=True)
    limit = np.linalg.solve(np.eye(len(words)) - 0.85 * p.T, np.full(len(words), 0.15))
    assert got.keys() == set(words)
    assert all(abs(got[w] - x) < 2e-6 for w, x in zip(words, limit))
    none = T.tokenize(df.where("id > 3"), "id", "text", "[a-z]+", with_position=True)
    assert T.textrank_keywords(none, "id", tolerance=1e-7).collect() == []


def _plain_holdout(rows, folds, stop):
    """Naive Bayes by dictionaries: a model of the other folds for each text."""
    import hashlib
    import math
    import re
    from collections import Counter
    rows = [(k, [w for w in re.findall("[a-z]+", (t or "").lower()) if w not in stop], y) for k, t, y in rows if y is not None]
    fold = {k: int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % folds for k, _, _ in rows}
    out = {}
    for k, words, y in rows:
        seen = [(w, c) for j, w, c in rows if fold[j] != fold[k]]
        n = [Counter(x for w, c in seen if c == label for x in w) for label in (0, 1)]
        vocabulary = set(n[0]) | set(n[1])
        size = [sum(c.values()) + max(len(vocabulary), 1) for c in n]
        docs = [sum(c == label for _, c in seen) for label in (0, 1)]
        odds = math.log((docs[1] + 1) / (docs[0] + 1))
        odds += sum(math.log((n[1][w] + 1) / size[1]) - math.log((n[0][w] + 1) / size[0]) for w in words if w in vocabulary)
        out[k] = (fold[k], y, odds)
    return out


def test_holdout_sentiment_matches_plain_models(spark):
    from venuelens.operators import sentiment as SE
    rows = [(i, " ".join(["good" if i % 3 else "bad", f"w{chr(97 + i % 7)}", "the"] + ["fine"] * (i % 4)), int(i % 3 > 0))
            for i in range(40)]
    rows += [(100, None, 1), (101, "", 0), (102, "the the", 1), (103, "never seen", None), (104, "only here once", 0)]
    df = spark.createDataFrame(rows, "id long, text string, label int").withColumn("fold", F.lit("clash"))
    got = SE.holdout_sentiment(df, "id", "text", "label", 3, pattern="[a-z]+", stop=["the"])
    want = _plain_holdout(rows, 3, ["the"])
    found = {r.id: r for r in got.collect()}
    assert found.keys() == want.keys()
    for k, (fold, label, odds) in want.items():
        assert (found[k].fold, found[k].label) == (fold, label) and abs(found[k].log_odds - odds) < 2e-6
    report = {r.fold: r for r in SE.holdout_accuracy(got).collect()}
    right = sum((o >= 0) == (y == 1) for _, y, o in want.values())
    assert report[None].n == len(want) and report[None].accuracy == round(right / len(want) + 1e-12, 4)
    assert sum(r.n for f, r in report.items() if f is not None) == len(want)
    assert SE.holdout_sentiment(df.where("id > 200"), "id", "text", "label", 3).collect() == []


def test_holdout_sentiment_of_one_class(spark):
    from venuelens.operators import sentiment as SE
    df = spark.createDataFrame([(i, "same words", 1) for i in range(6)], "id long, text string, label int")
    got = SE.holdout_sentiment(df, "id", "text", "label", 2)
    assert got.count() == 6 and {r.predicted for r in got.collect()} == {1}


def test_tfidf_picks_words_before_the_exchange(spark):
    df = spark.createDataFrame([(1, "aa aa bb"), (1, "cc bb"), (2, "aa dd"), (None, "ee aa"), (None, "ee"), (3, None)], "id int, t string")
    out = T.tfidf_keywords(df, "id", "t", 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "sum(c" not in plan     # the length comes with the counts
    got = {(r.id, r.word): (r.score, r["rank"]) for r in out.collect()}
    assert got[(2, "dd")] == (round(math.log(2) / 2, 6), 1) and got[(1, "bb")] == (round(math.log(2) * 2 / 5, 6), 1)
    assert got[(1, "cc")] == (round(math.log(2) / 5, 6), 2) and got[(None, "ee")] == (round(math.log(2) * 2 / 3, 6), 1)
