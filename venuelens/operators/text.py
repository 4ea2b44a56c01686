"""Text mining over review text.

Tokenising is ``regexp_extract_all`` + ``explode`` (JVM side, codegen).  For
Chinese text without a segmenter the tokeniser is a lexicon longest match: one
alternation of the lexicon terms, longest first, so at each position the
longest term wins.  Lexicons and stop lists have a size fixed by code, so they
are inlined as expressions or broadcast; word statistics are grouped
aggregates (partial + final), top-k per group is a ranked filter that Spark
limits per partition before the shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import round_half_up
from ..session import checkpoint_dir, freed, written
from .filters import filter_polarity
from .sets import word_cloud
from .wordgraph import WordGraph, pair_rows


def lexicon_pattern(terms: Sequence[str], word_boundary: bool = False) -> str:
    """Alternation of the terms, longest first (greedy leftmost-longest at each position)."""
    alts = sorted(dict.fromkeys(t for t in terms if t), key=lambda t: (-len(t), t))
    body = "|".join(re.escape(t) for t in alts)
    return f"\\b(?:{body})\\b" if word_boundary else f"(?:{body})"


def cjk_segment_pattern(lexicon: Sequence[str], min_len: int = 2) -> str:
    """Lexicon-guided segmentation of CJK text without a segmenter (Java regex).

    At each position a lexicon term wins (longest first); other ideographs form
    runs that stop right before the next lexicon term.  Runs shorter than
    ``min_len`` are not tokens, as in the keyword rule.
    """
    terms = lexicon_pattern(lexicon)
    han = "[\\x{4e00}-\\x{9fff}]"
    run = f"{han}(?:(?!{terms}){han}){{{min_len - 1},}}"
    return f"{terms}|{run}"


# ---- T1 ----------------------------------------------------------------------------
def tokenize(df: DataFrame, key: str, col: str, pattern: str = dims.CJK_WORD_PATTERN,
             lower: bool = True, with_position: bool = False) -> DataFrame:
    """``(key, token)`` rows: every match of ``pattern`` in the text, in order."""
    text = F.lower(F.col(col)) if lower else F.col(col)
    toks = F.regexp_extract_all(text, F.lit(pattern), 0)
    if with_position:
        return df.select(key, F.posexplode(toks).alias("pos", "token"))
    return df.select(key, F.explode(toks).alias("token"))


def tokenize_lexicon(df: DataFrame, key: str, col: str, terms: Sequence[str], word_boundary: bool = False,
                     lower: bool = True) -> DataFrame:
    return tokenize(df, key, col, lexicon_pattern([t.lower() if lower else t for t in terms], word_boundary), lower)


# ---- T2 / T3 -----------------------------------------------------------------------
def remove_stopwords(tokens: DataFrame, stop: Sequence[str], col: str = "token") -> DataFrame:
    """Drop listed words (a fixed list: an ``IN`` set evaluated in codegen, no join)."""
    t = F.trim(F.col(col))
    return tokens.where((t != "") & ~t.isin(list(stop)))


def word_counts(tokens: DataFrame, col: str = "token") -> DataFrame:
    return tokens.groupBy(F.col(col).alias("word")).agg(F.count(F.lit(1)).alias("count"))


# ---- T4 ----------------------------------------------------------------------------
def prioritized_topn(counts: DataFrame, lexicon: Sequence[str], n: int = 30) -> DataFrame:
    """Lexicon words present first (by count), then the most frequent other words, up to ``n``.

    Ties by word (Q17).  Equivalent to the reference's fill from the 3n most
    common words, since at most n lexicon words are taken first.
    """
    flag = F.col("word").isin(list(dict.fromkeys(lexicon))).cast("int")
    order = [F.desc("in_lexicon"), F.desc("count"), F.asc("word")]
    top = counts.withColumn("in_lexicon", flag).orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long")).drop("in_lexicon")


# ---- A7 / U1 -----------------------------------------------------------------------
def review_keywords(rv: DataFrame, lexicon: dict, stop: Sequence[str] = dims.STOP_WORDS, n: int = 30,
                    pattern: str = dims.CJK_WORD_PATTERN, sample: int | None = None, key: str = "review_id",
                    order: Sequence[str] = ("ts",), labels=(dims.POSITIVE, dims.NEGATIVE)) -> DataFrame:
    """Top ``n`` words of positive and of negative reviews: polarity, word, count, rank.

    ``lexicon`` = ``{polarity_label: [terms]}``; all reviews of a
    polarity count (F2; ``sample`` keeps the newest N).  With the default CJK rule the text is
    segmented around the lexicon terms (``cjk_segment_pattern``), the nearest
    we get to a word segmenter.
    """
    out = []
    cjk = pattern == dims.CJK_WORD_PATTERN
    if cjk:
        pattern = cjk_segment_pattern([t for ts in lexicon.values() for t in ts] + list(stop))
    for positive, label in ((True, labels[0]), (False, labels[1])):
        part = filter_polarity(rv, positive, sample, order=order, key=key)
        toks = remove_stopwords(tokenize(part, key, "text", pattern), stop)
        if cjk:
            toks = toks.where(F.length("token") >= 2)    # Q17: one-character words never count
        out.append(prioritized_topn(word_counts(toks), lexicon.get(label, []), n))
    return word_cloud(out[0], out[1], labels).select("polarity", "word", "count", "rank")


# ---- T5 ----------------------------------------------------------------------------
#: A word is hot with one in so many (document, word) rows.
HOT_WORD = 100_000


def tfidf_keywords(df: DataFrame, key: str, col: str, n: int = 5, pattern: str = dims.LATIN_WORD_PATTERN,
                   stop: Sequence[str] = ()) -> DataFrame:
    """Per document top ``n`` terms by tf * idf, tf = count / document length (tokens after
    stop-word removal), idf = ln(N / document frequency).

    Texts are exchanged by document, so the counts of a document and its length are found where it
    is tokenised; the (document, word, count, length) rows are written. Words with at
    least one in ``HOT_WORD`` of those rows are at most ``HOT_WORD`` many: their document
    frequencies are broadcast, and a document's best rows are picked in the task that reads it, before
    they are exchanged. The others meet their frequencies in a shuffle join, where
    no word has more than that share, so no word lands in one task.
    """
    words = df.select(key, col).repartition(key).select(key, F.explode(F.regexp_extract_all(F.lower(F.col(col)), F.lit(pattern), 0)).alias("word"))
    if stop:
        words = words.where(~F.col("word").isin(list(stop)))
    counts = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("c"))
    tf = written(counts.withColumn("len", F.sum("c").over(Window.partitionBy(key))), "tfidf")
    dfreq = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    share = F.col("df") * HOT_WORD >= tf.select(F.count(F.lit(1))).scalar()
    routed = tf.join(F.broadcast(dfreq.where(share)), "word", "left")
    counted = routed.where("df is not null").unionByName(routed.where("df is null").drop("df").join(dfreq.where(~share), "word"))
    n_docs = tf.select(F.count_distinct(key)).scalar()
    s = counted.select(key, "word", round_half_up((F.col("c") / F.col("len")) * F.log(n_docs / F.col("df")), 6).alias("score"))
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("word"))
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n) \
            .withColumn("rank", F.col("rank").cast("long"))


# ---- T6 ----------------------------------------------------------------------------
def cooccurrence_edges(tokens_pos: DataFrame, key: str, window: int = 3) -> DataFrame:
    """Undirected word edges for tokens at most ``window - 1`` positions apart, weighted by count.

    Each token meets those of the next ``window - 1`` positions (``wordgraph``): tokens are exchanged
    by document at most, and work grows with tokens x window.
    """
    e = pair_rows(tokens_pos, key, window)
    e = e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "w")
    und = e.groupBy("u", "v").agg(F.sum("w").alias("w"))
    return und.select("w", F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))).select("u", "v", "w")


def textrank_keywords(tokens_pos: DataFrame, key: str, window: int = 3, iterations: int = 10, n: int = 20,
                      damping: float = 0.85, checkpoint_every: int = 3, tolerance: float | None = None) -> DataFrame:
    """Weighted PageRank over the co-occurrence graph, ``iterations`` times or to a proven bound.

    An iteration shrinks the summed change of all scores by ``damping`` at least, so after a summed
    change of c no score is further than c * damping / (1 - damping) from its limit.  With ``tolerance`` the
    loop ends once that is at most ``tolerance``, at the latest after the iterations that the first change
    proves enough (rounding may keep a sum from falling further).  Ranks go by the score rounded
    to 6 digits, ties by word.

    The edges are those of ``cooccurrence_edges``, kept packed by cells of two blocks of words (``wordgraph``), so
    an iteration exchanges cells and scores, a few bytes an edge.  Scores are written to the session's
    checkpoint folder after every iteration; every few (``checkpoint_every``) the bound is looked at.
    """
    spark = tokens_pos.sparkSession
    checkpoint_dir(spark)
    graph = WordGraph(tokens_pos, key, window, damping)
    done, enough = 0, None
    while tolerance is not None or done < iterations:
        graph.step()
        done += 1
        if tolerance is None or done % checkpoint_every:
            continue
        error = graph.moved() * damping / (1 - damping)
        if enough is None and error > tolerance:
            enough = done + math.ceil(math.log(tolerance / error) / math.log(damping))
        if error <= tolerance or done >= enough:
            break
    rounded = graph.scores().withColumn("score", round_half_up("score", 6))
    order = [F.desc("score"), F.asc("word")]
    with freed(spark):
        least = rounded.orderBy(F.desc("score")).limit(n).agg(F.min("score")).first()[0]     # names are looked up from the n-th score on
        named = rounded.where(F.col("score") >= F.lit(least)).join(graph.words.select("block", "place", "word").distinct(), ["block", "place"])
        top = written(named.select("word", "score").orderBy(*order).limit(n), "textrank")    # n rows; the graph is free after them
    graph.drop()
    return top.select("word", "score", F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"))


# ---- T7 ----------------------------------------------------------------------------
def lexicon_hits(tokens: DataFrame, key: str, lexicon: DataFrame, col: str = "token") -> DataFrame:
    """Join form for lexicons that arrive as tables: key, polarity, aspect, term per token hit."""
    return tokens.join(F.broadcast(lexicon.withColumnRenamed("term", col)), col).select(
        key, "polarity", "aspect", F.col(col).alias("term"))


def _terms(lexicon: dict, polarity: str, aspect: str | None = None) -> list:
    aspects = lexicon.get(polarity, {})
    if aspect is not None:
        return [t.lower() for t in aspects.get(aspect, [])]
    return [t.lower() for ts in aspects.values() for t in ts]


def count_in(tokens: Column, terms: Sequence[str]) -> Column:
    """Number of tokens that are in the fixed term list (array filter, no join)."""
    terms = list(dict.fromkeys(terms))
    return F.size(F.filter(tokens, lambda t: t.isin(terms))).cast("long") if terms else F.lit(0).cast("long")


def word_tokens(col: str, pattern: str = dims.LATIN_WORD_PATTERN) -> Column:
    return F.regexp_extract_all(F.lower(F.col(col)), F.lit(pattern), 0)


def sentiment_score(pos_hits: Column, neg_hits: Column) -> Column:
    tot = pos_hits + neg_hits
    return F.when(tot == 0, F.lit(0.0)).otherwise(round_half_up((pos_hits - neg_hits) / tot, 4))


def lexicon_sentiment(df: DataFrame, key: str, col: str, lexicon: dict, pos: str, neg: str,
                      pattern: str = dims.LATIN_WORD_PATTERN) -> DataFrame:
    """Per text: positive hits p, negative hits n, score (p - n) / (p + n) (0 when no hit).

    ``lexicon`` = ``{polarity: {aspect: [terms]}}``; one projection per row.
    """
    toks = word_tokens(col, pattern)
    out = df.select(key, count_in(toks, _terms(lexicon, pos)).alias("pos_hits"),
                    count_in(toks, _terms(lexicon, neg)).alias("neg_hits"))
    return out.withColumn("score", sentiment_score(F.col("pos_hits"), F.col("neg_hits")))


# ---- T8 ----------------------------------------------------------------------------
def train_sentiment(df: DataFrame, text: str = "text", label: str = "label", num_features: int = 1 << 16,
                    smoothing: float = 1.0):
    """Tokenizer -> hashing TF -> IDF -> multinomial naive Bayes (pyspark.ml Pipeline)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=dims.LATIN_WORD_PATTERN, gaps=False),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_feat"),
        NaiveBayes(featuresCol="_feat", labelCol=label, smoothing=smoothing, modelType="multinomial"),
    ])
    return pipe.fit(df)


def score_sentiment(model, df: DataFrame, key: str = "review_id") -> DataFrame:
    """Probability of the positive class (0-1) and its class label (T9 thresholds)."""
    from pyspark.ml.functions import vector_to_array
    from ..functions import classify_sentiment
    p = model.transform(df).select(key, vector_to_array("probability")[1].alias("probability"))
    return p.withColumn("probability", round_half_up("probability", 4)) \
            .withColumn("sentiment_class", classify_sentiment("probability"))


# ---- T10 / T11 ---------------------------------------------------------------------
def aspect_sentiment(df: DataFrame, key: str, col: str, lexicon: dict, pos: str, neg: str,
                     pattern: str = dims.LATIN_WORD_PATTERN) -> DataFrame:
    """Per text and mentioned aspect: positive hits, negative hits, label."""
    toks = word_tokens(col, pattern)
    aspects = list(dict.fromkeys([a for p in (pos, neg) for a in lexicon.get(p, {})]))
    rows = F.array(*[F.struct(F.lit(a).alias("aspect"), count_in(toks, _terms(lexicon, pos, a)).alias("pos_hits"),
                              count_in(toks, _terms(lexicon, neg, a)).alias("neg_hits")) for a in aspects])
    g = df.select(key, F.inline(rows)).where((F.col("pos_hits") + F.col("neg_hits")) > 0)
    return g.withColumn("label", F.when(F.col("pos_hits") > F.col("neg_hits"), "positive")
                        .when(F.col("pos_hits") < F.col("neg_hits"), "negative").otherwise("neutral"))


def service_quality(asp: DataFrame, reviews: DataFrame, aspect: str, key: str = "review_id",
                    by: str = "listing_id") -> DataFrame:
    """Per listing, among reviews mentioning ``aspect``: count and positive / negative share (%)."""
    a = asp.where(F.col("aspect") == aspect).join(reviews.select(key, by), key)
    n = F.count(F.lit(1))
    return a.groupBy(by).agg(
        n.alias("mentions"),
        round_half_up(F.count_if(F.col("label") == "positive") * 100.0 / n, 2).alias("positive_share"),
        round_half_up(F.count_if(F.col("label") == "negative") * 100.0 / n, 2).alias("negative_share"))


# ---- T12 - T14 ---------------------------------------------------------------------
def dish_terms(dishes: dict) -> list:
    return list(dict.fromkeys(t.lower() for ts in dishes.values() for t in ts))


def dish_array(col: str, dishes: dict, mode: str = "words", pattern: str = dims.LATIN_WORD_PATTERN) -> Column:
    """Distinct dishes in a text.  ``words``: whole-word tokens equal to a dish name
    (spaced scripts); ``longest``: lexicon longest match anywhere (Chinese)."""
    terms = dish_terms(dishes)
    if mode == "words":
        return F.array_distinct(F.filter(word_tokens(col, pattern), lambda t: t.isin(terms)))
    return F.array_distinct(F.regexp_extract_all(F.lower(F.col(col)), F.lit(lexicon_pattern(terms)), 0))


def extract_dishes(df: DataFrame, key: str, col: str, dishes: dict, mode: str = "words") -> DataFrame:
    """Dictionary dish names found in the text, one row per (key, dish)."""
    return df.select(key, F.explode(dish_array(col, dishes, mode)).alias("dish"))


def dish_groups(spark, dishes: dict) -> DataFrame:
    """(dish, grp): a dish listed under several groups keeps the first."""
    seen, rows = set(), []
    for g, ts in dishes.items():
        for t in ts:
            if t.lower() not in seen:
                seen.add(t.lower())
                rows.append((t.lower(), g))
    return spark.createDataFrame(rows, "dish string, grp string")


def rank_dishes(mentions: DataFrame, n: int = 10, groups: DataFrame | None = None) -> DataFrame:
    """Mentions (distinct reviews) per dish, dense rank, top ``n`` overall or per group."""
    c = mentions.groupBy("dish").agg(F.count(F.lit(1)).alias("mentions"))
    if groups is None:
        return _global_dense_topn(c, n)
    c = c.join(F.broadcast(groups), "dish")
    w = Window.partitionBy("grp").orderBy(F.desc("mentions"))
    return c.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= n) \
            .withColumn("rank", F.col("rank").cast("long"))


def _global_dense_topn(c: DataFrame, n: int) -> DataFrame:
    """Dense rank <= n overall: the n largest distinct counts, then the dishes having them."""
    top_vals = c.select("mentions").distinct().orderBy(F.desc("mentions")).limit(n)
    ranked = top_vals.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mentions"))).cast("long"))
    return c.join(F.broadcast(ranked), "mentions").select("dish", "mentions", "rank")


SENTENCE_SPLIT = "[.!?。！？\\n]+"


def dish_sentiment(df: DataFrame, key: str, col: str, dishes: dict, lexicon: dict, pos: str, neg: str,
                   mode: str = "words", pattern: str = dims.LATIN_WORD_PATTERN) -> DataFrame:
    """Per dish: mean lexicon score of the sentences that mention it, and the sentence count.

    Sentences come from splitting the whole text; each sentence is scored and
    matched in one projection, then exploded by the dishes it names.
    """
    sents = df.select(F.explode(F.split(F.lower(F.col(col)), SENTENCE_SPLIT)).alias("sentence"))
    toks = word_tokens("sentence", pattern)
    scored = sents.select(dish_array("sentence", dishes, mode, pattern).alias("dishes"),
                          sentiment_score(count_in(toks, _terms(lexicon, pos)), count_in(toks, _terms(lexicon, neg)))
                          .alias("score"))
    return (scored.select(F.explode("dishes").alias("dish"), "score").groupBy("dish")
            .agg(round_half_up(F.avg("score"), 4).alias("score"), F.count(F.lit(1)).alias("n")))


# ---- T15 ---------------------------------------------------------------------------
def sentiment_summary(df: DataFrame, by: str = "listing_id", cls: str = "sentiment_class") -> DataFrame:
    """Counts per (listing, class), per listing and overall (rollup) with the class share (%) in its listing."""
    r = df.rollup(by, cls).agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("gid"))
    tot = r.where(F.col("gid") == 1).select(by, F.col("count").alias("_tot"))
    return (r.join(tot, by, "left")
            .withColumn("share", F.when(F.col("gid") == 0, round_half_up(F.col("count") * 100.0 / F.col("_tot"), 2)))
            .drop("_tot"))


# ---- T16 ---------------------------------------------------------------------------
def tag_array(col: str, tags: dict, mode: str = "words", pattern: str = dims.LATIN_WORD_PATTERN) -> Column:
    """Sorted distinct tags whose terms occur in the text (size bounded by the dictionary)."""
    from .cleaning import map_literal
    term_to_tag = {}
    for g, ts in tags.items():
        for t in ts:
            term_to_tag.setdefault(t.lower(), g)
    terms = list(term_to_tag)
    if mode == "words":
        found = F.filter(word_tokens(col, pattern), lambda t: t.isin(terms))
    else:
        found = F.regexp_extract_all(F.lower(F.col(col)), F.lit(lexicon_pattern(terms)), 0)
    mapped = F.transform(F.array_distinct(found), lambda t: F.try_element_at(map_literal(term_to_tag), t))
    return F.array_sort(F.array_distinct(mapped))


def tag_services(df: DataFrame, key: str, col: str, tags: dict, mode: str = "words") -> DataFrame:
    return df.select(key, tag_array(col, tags, mode).alias("tags"))
