"""Text mining T1-T16, A7, U1 over ``review_text`` (documents + labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dims
from ..functions import classify_sentiment
from ..operators import sentiment as SE
from ..operators import text as T
from . import register
from .dashboard import R

LEX = dims.STANDIN_SENTIMENT_DICT
POS, NEG = "positive", "negative"
PAT = dims.LATIN_WORD_PATTERN
STOP = dims.STANDIN_STOP_WORDS


def _q(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def TOKS(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '{PAT}')"


def COUNT_IN(toks: str, terms) -> str:
    terms = list(dict.fromkeys(terms))
    return f"len(list_filter({toks}, lambda t: t IN ({_q(terms)})))" if terms else "0"


def SCORE(p: str, n: str) -> str:
    return f"CASE WHEN ({p}) + ({n}) = 0 THEN 0.0 ELSE {R(f'(({p}) - ({n})) / (({p}) + ({n}))', 4)} END"


def _terms(pol, aspect=None):
    asp = LEX[pol]
    if aspect:
        return [t.lower() for t in asp.get(aspect, [])]
    return [t.lower() for ts in asp.values() for t in ts]


# ---- T1 - T3 -----------------------------------------------------------------------
@register("tokenize", f"SELECT review_id, unnest({TOKS('text')}) AS token FROM review_text", ("review_text",))
def _tokenize(t):
    return T.tokenize(t.review_text(), "review_id", "text", PAT)


@register("word_counts", f"""
SELECT token AS word, count(*) AS count FROM (SELECT unnest({TOKS('text')}) AS token FROM review_text)
WHERE trim(token) <> '' AND trim(token) NOT IN ({_q(STOP)}) GROUP BY token""", ("review_text",))
def _word_counts(t):
    return T.word_counts(T.remove_stopwords(T.tokenize(t.review_text(), "review_id", "text", PAT), STOP))


# ---- A7 / T4 / U1 ------------------------------------------------------------------
def _kw_sql(cond: str, label: str, lexicon) -> str:
    return f"""SELECT '{label}' AS polarity, word, count, row_number() OVER (ORDER BY in_lexicon DESC, count DESC, word) AS rank
FROM (SELECT word, count, CAST(word IN ({_q(lexicon)}) AS INT) AS in_lexicon FROM (
  SELECT token AS word, count(*) AS count FROM (
    SELECT unnest({TOKS('text')}) AS token FROM (
      SELECT * FROM review_text WHERE text IS NOT NULL AND text <> '' AND {cond}))
  WHERE trim(token) <> '' AND trim(token) NOT IN ({_q(STOP)}) GROUP BY token)
ORDER BY in_lexicon DESC, count DESC, word LIMIT 30)"""


_FLAT = dims.flatten_polarity(LEX)


@register("review_keywords", f"""
{_kw_sql('sentiment > 0 AND rating >= 4', POS, _FLAT[POS])}
UNION ALL
{_kw_sql('sentiment < 0 AND rating <= 2.5', NEG, _FLAT[NEG])}""", ("review_text",))
def _review_keywords(t):
    return T.review_keywords(t.review_text(), _FLAT, STOP, 30, PAT, labels=(POS, NEG))


# ---- T5 ----------------------------------------------------------------------------
@register("tfidf_keywords", f"""
WITH tok AS (SELECT review_id, unnest({TOKS('text')}) AS token FROM review_text),
tf AS (SELECT review_id, token AS word, count(*) AS c FROM tok
       WHERE trim(token) <> '' AND trim(token) NOT IN ({_q(STOP)}) GROUP BY review_id, token),
dl AS (SELECT review_id, sum(c) AS len FROM tf GROUP BY review_id),
dfq AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
s AS (SELECT tf.review_id, tf.word, {R('(tf.c / dl.len) * ln((SELECT count(*) FROM dl) / dfq.df)', 6)} AS score
      FROM tf JOIN dl ON tf.review_id = dl.review_id JOIN dfq ON dfq.word = tf.word)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY score DESC, word) AS rank FROM s)
WHERE rank <= 5""", ("review_text",))
def _tfidf(t):
    return T.tfidf_keywords(t.review_text(), "review_id", "text", 5, PAT, STOP)


# ---- T6 ----------------------------------------------------------------------------
_RANK_STEPS = 10


@register("textrank_keywords", f"""
WITH RECURSIVE seq AS (SELECT review_id, {TOKS('text')} AS toks FROM review_text),
tok AS MATERIALIZED (SELECT * FROM (SELECT review_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM seq)
                     WHERE trim(token) <> '' AND trim(token) NOT IN ({_q(STOP)})),
pair AS (SELECT a.token AS u, b.token AS v FROM tok a JOIN tok b ON b.review_id = a.review_id AND b.pos = a.pos + 1
         UNION ALL
         SELECT a.token, b.token FROM tok a JOIN tok b ON b.review_id = a.review_id AND b.pos = a.pos + 2),
edge AS (SELECT u, v, count(*) AS w FROM (SELECT u, v FROM pair WHERE u <> v UNION ALL SELECT v, u FROM pair WHERE u <> v)
         GROUP BY u, v),
norm AS MATERIALIZED (SELECT u, v, w / sum(w) OVER (PARTITION BY u) AS p FROM edge),
step(i, word, score) AS (
  SELECT 0, u, CAST(1 AS DOUBLE) FROM (SELECT DISTINCT u FROM norm)
  UNION ALL
  SELECT s.i + 1, n.v, 0.15 + 0.85 * sum(n.p * s.score) FROM step s JOIN norm n ON n.u = s.word
  WHERE s.i < {_RANK_STEPS} GROUP BY s.i, n.v)
SELECT word, score, rank FROM (
  SELECT word, score, row_number() OVER (ORDER BY score DESC, word) AS rank
  FROM (SELECT word, {R('score', 6)} AS score FROM step WHERE i = {_RANK_STEPS}))
WHERE rank <= 20""", ("review_text",))
def _textrank(t):
    """Ten iterations, written out in SQL too; stop words removed, distances counted in the whole text."""
    texts = t.review_text().select("review_id", "text").repartition("review_id")   # documents travel, not their tokens
    toks = T.remove_stopwords(T.tokenize(texts, "review_id", "text", PAT, with_position=True), STOP)
    return T.textrank_keywords(toks, "review_id", 3, _RANK_STEPS, 20)


# ---- T7 / T9 -----------------------------------------------------------------------
_P = COUNT_IN(TOKS('text'), _terms(POS))
_N = COUNT_IN(TOKS('text'), _terms(NEG))


@register("lexicon_sentiment", f"""
SELECT review_id, {_P} AS pos_hits, {_N} AS neg_hits, {SCORE(_P, _N)} AS score FROM review_text""",
          ("review_text",))
def _lexicon_sentiment(t):
    return T.lexicon_sentiment(t.review_text(), "review_id", "text", LEX, POS, NEG)


@register("classify_sentiment", f"""
SELECT review_id, score, CASE WHEN (score + 1) / 2 > 0.6 THEN 'positive' WHEN (score + 1) / 2 < 0.4 THEN 'negative'
       ELSE 'neutral' END AS sentiment_class
FROM (SELECT review_id, {SCORE(_P, _N)} AS score FROM review_text)""", ("review_text",))
def _classify(t):
    s = T.lexicon_sentiment(t.review_text(), "review_id", "text", LEX, POS, NEG)
    return s.select("review_id", "score", classify_sentiment((F.col("score") + 1) / 2).alias("sentiment_class"))


# ---- T8 ----------------------------------------------------------------------------
@register("sentiment_model_scores")
def _sentiment_model(t):
    """Naive Bayes trained on labelled reviews, scored on all reviews (rows-only check)."""
    rt = t.review_text()
    train = rt.where(F.col("sentiment").isNotNull()).withColumn("label", (F.col("sentiment") > 0).cast("double"))
    model = T.train_sentiment(train)
    return T.score_sentiment(model, rt)


_FOLDS = 5
_HOLDOUT = f"""
doc AS MATERIALIZED (
  SELECT review_id, CAST(sentiment > 0 AS INT) AS label, {TOKS('text')} AS toks,
         CAST(CAST('0x' || md5(CAST(review_id AS VARCHAR))[1:8] AS BIGINT) % {_FOLDS} AS INT) AS fold
  FROM review_text WHERE sentiment IS NOT NULL),
word AS MATERIALIZED (SELECT * FROM (SELECT review_id, label, fold, unnest(toks) AS word FROM doc)
                      WHERE word NOT IN ({_q(STOP)})),
held AS (SELECT unnest(range({_FOLDS})) AS out),
cnt AS MATERIALIZED (SELECT out, word, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
                     FROM held JOIN word ON fold <> out GROUP BY out, word),
tot AS (SELECT out, sum(p) AS tp, sum(n) AS tn, count(*) AS v FROM cnt GROUP BY out),
prior AS (SELECT out, count(*) FILTER (WHERE label = 1) AS dp, count(*) FILTER (WHERE label = 0) AS dn
          FROM held JOIN doc ON fold <> out GROUP BY out),
said AS (SELECT w.review_id, sum(ln((c.p + 1) / (t.tp + t.v)) - ln((c.n + 1) / (t.tn + t.v))) AS s
         FROM word w JOIN cnt c ON c.out = w.fold AND c.word = w.word JOIN tot t ON t.out = w.fold GROUP BY w.review_id),
scored AS (SELECT d.review_id, d.fold, d.label,
                  {R('ln((p.dp + 1) / (p.dn + 1)) + coalesce(s.s, 0)', 6)} AS log_odds
           FROM doc d JOIN prior p ON p.out = d.fold LEFT JOIN said s ON s.review_id = d.review_id)"""


def _holdout(t):
    rt = t.review_text().withColumn("label", (F.col("sentiment") > 0).cast("int"))
    return SE.holdout_sentiment(rt, "review_id", "text", "label", _FOLDS, 1.0, PAT, STOP)


@register("sentiment_holdout", f"""
WITH {_HOLDOUT}
SELECT review_id, fold, label, log_odds, CAST(log_odds >= 0 AS INT) AS predicted FROM scored""", ("review_text",))
def _sentiment_holdout(t):
    """Every labelled review scored by a model of the folds that do not hold it."""
    return _holdout(t)


@register("sentiment_cross_validation", f"""
WITH {_HOLDOUT}
SELECT fold, count(*) AS n, count(*) FILTER (WHERE label = 1 AND log_odds >= 0) AS true_positive,
       count(*) FILTER (WHERE label = 0 AND log_odds < 0) AS true_negative,
       count(*) FILTER (WHERE label = 0 AND log_odds >= 0) AS false_positive,
       count(*) FILTER (WHERE label = 1 AND log_odds < 0) AS false_negative,
       {R('count(*) FILTER (WHERE (label = 1) = (log_odds >= 0)) / count(*)', 4)} AS accuracy,
       count(*) FILTER (WHERE (label = 1) = (log_odds >= 0)) / count(*) >= {SE.TARGET_ACCURACY} AS meets_target
FROM scored GROUP BY ROLLUP (fold)""", ("review_text",))
def _sentiment_cross_validation(t):
    return SE.holdout_accuracy(_holdout(t))


# ---- T10 / T11 ---------------------------------------------------------------------
def _aspect_sql() -> str:
    aspects = list(dict.fromkeys([a for p in (POS, NEG) for a in LEX[p]]))
    parts = []
    for a in aspects:
        p = COUNT_IN(TOKS('text'), _terms(POS, a))
        n = COUNT_IN(TOKS('text'), _terms(NEG, a))
        parts.append(f"SELECT review_id, '{a}' AS aspect, {p} AS pos_hits, {n} AS neg_hits FROM review_text")
    body = "\nUNION ALL ".join(parts)
    return f"""SELECT *, CASE WHEN pos_hits > neg_hits THEN 'positive' WHEN pos_hits < neg_hits THEN 'negative'
  ELSE 'neutral' END AS label FROM ({body}) WHERE pos_hits + neg_hits > 0"""


@register("aspect_sentiment", _aspect_sql(), ("review_text",))
def _aspect_sentiment(t):
    return T.aspect_sentiment(t.review_text(), "review_id", "text", LEX, POS, NEG)


@register("service_quality", f"""
SELECT r.listing_id, count(*) AS mentions,
       {R("count(*) FILTER (WHERE a.label = 'positive') * 100.0 / count(*)")} AS positive_share,
       {R("count(*) FILTER (WHERE a.label = 'negative') * 100.0 / count(*)")} AS negative_share
FROM ({_aspect_sql()}) a JOIN review_text r ON r.review_id = a.review_id
WHERE a.aspect = 'service' GROUP BY r.listing_id""", ("review_text",))
def _service_quality(t):
    rt = t.review_text()
    asp = T.aspect_sentiment(rt, "review_id", "text", LEX, POS, NEG)
    return T.service_quality(asp, rt, "service")


# ---- T12 - T14 ---------------------------------------------------------------------
DISHES = dims.STANDIN_DISHES_DICT
_DISH_TERMS = T.dish_terms(DISHES)


def DISH_ARR(col: str) -> str:
    return f"list_distinct(list_filter({TOKS(col)}, lambda t: t IN ({_q(_DISH_TERMS)})))"


@register("extract_dishes", f"SELECT review_id, unnest({DISH_ARR('text')}) AS dish FROM review_text",
          ("review_text",))
def _extract_dishes(t):
    return T.extract_dishes(t.review_text(), "review_id", "text", DISHES)


def _dish_grp_values() -> str:
    seen, rows = set(), []
    for g, ts in DISHES.items():
        for d in ts:
            if d.lower() not in seen:
                seen.add(d.lower())
                rows.append(f"('{d.lower()}', '{g}')")
    return "(VALUES " + ", ".join(rows) + ") AS g(dish, grp)"


_MENTIONS = f"SELECT dish, count(*) AS mentions FROM (SELECT unnest({DISH_ARR('text')}) AS dish FROM review_text) GROUP BY dish"


@register("rank_dishes", f"""
WITH c AS ({_MENTIONS}),
v AS (SELECT mentions, row_number() OVER (ORDER BY mentions DESC) AS rank FROM (
        SELECT DISTINCT mentions FROM c ORDER BY mentions DESC LIMIT 10))
SELECT c.dish, c.mentions, v.rank FROM c JOIN v ON c.mentions = v.mentions""", ("review_text",))
def _rank_dishes(t):
    return T.rank_dishes(T.extract_dishes(t.review_text(), "review_id", "text", DISHES), 10)


@register("rank_dishes_by_group", f"""
SELECT * FROM (SELECT c.dish, c.mentions, g.grp, dense_rank() OVER (PARTITION BY g.grp ORDER BY c.mentions DESC) AS rank
               FROM ({_MENTIONS}) c JOIN {_dish_grp_values()} ON g.dish = c.dish) WHERE rank <= 2""",
          ("review_text",))
def _rank_dishes_by_group(t):
    m = T.extract_dishes(t.review_text(), "review_id", "text", DISHES)
    return T.rank_dishes(m, 2, T.dish_groups(t.spark, DISHES))


@register("dish_sentiment", f"""
WITH s AS (SELECT unnest(string_split_regex(lower(text), '[.!?。！？\\n]+')) AS sentence FROM review_text),
sc AS (SELECT {DISH_ARR('sentence')} AS dishes,
              {SCORE(COUNT_IN(TOKS('sentence'), _terms(POS)), COUNT_IN(TOKS('sentence'), _terms(NEG)))} AS score FROM s)
SELECT dish, {R('avg(score)', 4)} AS score, count(*) AS n FROM (SELECT unnest(dishes) AS dish, score FROM sc)
GROUP BY dish""", ("review_text",))
def _dish_sentiment(t):
    return T.dish_sentiment(t.review_text(), "review_id", "text", DISHES, LEX, POS, NEG)


# ---- T15 ---------------------------------------------------------------------------
_CLS = ("CASE WHEN sentiment IS NULL THEN NULL WHEN (sentiment + 1) / 2 > 0.6 THEN 'positive' "
        "WHEN (sentiment + 1) / 2 < 0.4 THEN 'negative' ELSE 'neutral' END")


@register("sentiment_summary", f"""
WITH r AS (SELECT listing_id, sentiment_class, count(*) AS count, GROUPING(listing_id, sentiment_class) AS gid
           FROM (SELECT listing_id, {_CLS} AS sentiment_class FROM review_text)
           GROUP BY ROLLUP (listing_id, sentiment_class)),
tot AS (SELECT listing_id, count AS _tot FROM r WHERE gid = 1)
SELECT r.listing_id, r.sentiment_class, r.count, r.gid,
       CASE WHEN r.gid = 0 THEN {R('r.count * 100.0 / tot._tot')} END AS share
FROM r LEFT JOIN tot ON r.listing_id = tot.listing_id""", ("review_text",))
def _sentiment_summary(t):
    rt = t.review_text().select("listing_id",
                                classify_sentiment((F.col("sentiment") + 1) / 2).alias("sentiment_class"))
    return T.sentiment_summary(rt)


# ---- T16 ---------------------------------------------------------------------------
SCENES = dims.STANDIN_SCENE_DICT


def TAGS(col: str) -> str:
    t2g = {}
    for g, ts in SCENES.items():
        for term in ts:
            t2g.setdefault(term.lower(), g)
    case = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in t2g.items()) + " END"
    return (f"list_sort(list_distinct(list_transform(list_distinct(list_filter({TOKS(col)}, "
            f"lambda t: t IN ({_q(list(t2g))}))), lambda t: {case})))")


@register("tag_services", f"SELECT review_id, {TAGS('text')} AS tags FROM review_text", ("review_text",))
def _tag_services(t):
    return T.tag_services(t.review_text(), "review_id", "text", SCENES)
