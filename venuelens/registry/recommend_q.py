"""Recommendation R1-R8, competition P1-P4 and trends X1-X7."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compete as P
from ..operators.bands import band_totals
from ..operators import recommend as Rc
from ..operators import trends as X
from . import register
from .dashboard import AVG, R
from .text_q import SCENES, TAGS

NEAREST = 10

_M = f"m AS (SELECT user_id, listing_id, {AVG('rating', 4)} AS rating FROM review GROUP BY user_id, listing_id)"
_SIM = f"""w AS (SELECT user_id, listing_id, CAST(round(rating * 10000) AS BIGINT) AS q FROM m),
nrm AS (SELECT user_id, sqrt(CAST(sum(q * q) AS DOUBLE)) AS norm FROM w GROUP BY user_id),
d AS (SELECT a.user_id, b.user_id AS other_id, CAST(sum(a.q * b.q) AS DOUBLE) AS dot, count(*) AS common
      FROM w a JOIN w b ON a.listing_id = b.listing_id AND a.user_id <> b.user_id GROUP BY 1, 2),
pairs AS (SELECT d.user_id, d.other_id, {R('d.dot / (n1.norm * n2.norm)', 6)} AS sim, d.common
          FROM d JOIN nrm n1 ON n1.user_id = d.user_id JOIN nrm n2 ON n2.user_id = d.other_id
          WHERE n1.norm > 0 AND n2.norm > 0),
sim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, other_id) AS rank
                       FROM pairs WHERE sim > 0) WHERE rank <= {NEAREST})"""
_PRED = """nb AS (SELECT s.user_id, w.listing_id, CAST(round(s.sim * 1000000) AS BIGINT) AS s6, w.q FROM sim s
               JOIN w ON w.user_id = s.other_id
               WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.user_id = s.user_id AND m.listing_id = w.listing_id)),
pred AS (SELECT user_id, listing_id, """ + R("CAST(sum(s6 * q) AS DOUBLE) / (CAST(sum(s6) AS DOUBLE) * 10000)", 4) + """ AS predicted,
                count(*) AS neighbours FROM nb GROUP BY user_id, listing_id)"""


def _cf(t):
    # written once: several branches prune the matrix differently (no exchange reuse)
    from ..session import freed, written
    m = Rc.rated_matrix(Rc.user_item_matrix(t.review()))
    similar = Rc.user_similarity(m, k=NEAREST)
    with freed(t.spark):
        return m, written(similar, "similar")


@register("user_item_matrix", f"WITH {_M} SELECT * FROM m", ("review",))
def _uim(t):
    return Rc.user_item_matrix(t.review())


@register("user_similarity", f"WITH {_M}, {_SIM} SELECT * FROM sim", ("review",))
def _user_similarity(t):
    """Every user's nearest users."""
    return Rc.user_similarity(Rc.user_item_matrix(t.review()), k=NEAREST)


@register("predict_user_rating", f"WITH {_M}, {_SIM}, {_PRED} SELECT * FROM pred", ("review",))
def _predict(t):
    m, sim = _cf(t)
    return Rc.predict_user_rating(m, sim)


@register("recommend_topn", f"""WITH {_M}, {_SIM}, {_PRED}
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted DESC, listing_id) AS rank
               FROM pred) WHERE rank <= 10""", ("review",))
def _recommend(t):
    m, sim = _cf(t)
    return Rc.recommend_topn(Rc.predict_user_rating(m, sim), 10)


# ---- R6 ----------------------------------------------------------------------------
def _tier_idx_sql() -> str:
    from ..operators.aggregates import PRICE_TIERS
    n = len(PRICE_TIERS) - 1
    parts = []
    for i, (_, lo, hi) in enumerate(PRICE_TIERS):
        cond = f"price > {lo}" + (f" AND price <= {hi}" if hi is not None else "")
        parts.append(f"WHEN {cond} THEN {i / n!r}")
    return "CAST(CASE " + " ".join(parts) + " ELSE 0.0 END AS DOUBLE)"


_TAGS_PER_LISTING = f"""lt AS (SELECT listing_id, list_sort(list(tag)) AS tags FROM (
  SELECT DISTINCT listing_id, unnest({TAGS('text')}) AS tag FROM review_text) GROUP BY listing_id)"""
_FEAT = f"""f AS (SELECT l.listing_id, l.category, l.area, {_tier_idx_sql()} AS price_level,
                  CAST(l.rating AS DOUBLE) / 5 AS rating_norm, coalesce(lt.tags, []) AS tags
           FROM listing l LEFT JOIN lt ON lt.listing_id = l.listing_id)"""


def _sq(p: str) -> str:
    return (f"(CAST({p}category IS NOT NULL AS DOUBLE) + CAST({p}area IS NOT NULL AS DOUBLE) + pow({p}price_level, 2)"
            f" + pow(coalesce({p}rating_norm, 0.0), 2) + CAST(len({p}tags) AS DOUBLE))")


@register("similar_listings", f"""
WITH {_TAGS_PER_LISTING}, {_FEAT},
t AS (SELECT f.listing_id AS t_listing_id, f.category AS t_category, f.area AS t_area, f.price_level AS t_price_level,
             f.rating_norm AS t_rating_norm, f.tags AS t_tags FROM f),
s AS (SELECT t.t_listing_id AS target_id, f.listing_id,
        {R(f'''coalesce(CAST(f.category = t.t_category AS DOUBLE) + CAST(f.area = t.t_area AS DOUBLE)
           + f.price_level * t.t_price_level + coalesce(f.rating_norm, 0.0) * coalesce(t.t_rating_norm, 0.0)
           + CAST(len(list_intersect(f.tags, t.t_tags)) AS DOUBLE), 0.0) / sqrt({_sq('f.')} * {_sq('t.t_')})''', 6)} AS sim
      FROM f JOIN t ON f.listing_id <> t.t_listing_id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY sim DESC, listing_id) AS rank FROM s)
WHERE rank <= 5""", ("listing", "review_text"))
def _similar_listings(t):
    """Five neighbours of every listing."""
    return Rc.similar_listings(t.listing(), 5, Rc.listing_tags(t.review_text(), SCENES))


def _slots(values: str, own: str) -> str:
    return f"list_transform((SELECT list(DISTINCT {values} ORDER BY {values}) FROM f0), lambda x: CAST(x = {own} AS DOUBLE))"


@register("listing_features", f"""
WITH {_TAGS_PER_LISTING}, {_FEAT},
f0 AS (SELECT listing_id, coalesce(category, '') AS category, coalesce(area, '') AS area, price_level, coalesce(rating_norm, 0.0) AS rating_norm, tags FROM f)
SELECT f0.listing_id, list_concat({_slots('category', 'f0.category')}, {_slots('area', 'f0.area')},
         [f0.price_level, f0.rating_norm, {', '.join(f"CAST(list_contains(f0.tags, '{s}') AS DOUBLE)" for s in SCENES)}]) AS features
FROM f0""", ("listing", "review_text"))
def _listing_features(t):
    """The vectors as arrays: one-hot category and area, price level, rating, a slot a scene."""
    from pyspark.ml.functions import vector_to_array
    f = Rc.listing_features(t.listing(), list(SCENES), Rc.listing_tags(t.review_text(), SCENES))
    return f.select("listing_id", vector_to_array("features").alias("features"))


_SCENE = f"""sc AS (SELECT l.listing_id, l.name, l.rating, h.hits,
                       {R('h.hits * CAST(l.rating AS DOUBLE) / 5', 4)} AS scene_score
  FROM listing l JOIN (SELECT listing_id, count(*) AS hits FROM review_text
                       WHERE list_contains({TAGS('text')}, 'date') GROUP BY listing_id) h ON h.listing_id = l.listing_id)"""


@register("scene_score", f"WITH {_SCENE} SELECT * FROM sc", ("listing", "review_text"))
def _scene_score(t):
    return Rc.scene_score(t.listing(), t.review_text(), SCENES, "date")


@register("recommend_by_scene", f"""WITH {_SCENE}
SELECT *, row_number() OVER (ORDER BY scene_score DESC, listing_id) AS rank FROM (
  SELECT * FROM sc ORDER BY scene_score DESC, listing_id LIMIT 10)""", ("listing", "review_text"))
def _recommend_by_scene(t):
    return Rc.recommend_by_scene(t.listing(), t.review_text(), SCENES, "date", 10)


# ---- P1 - P4 -----------------------------------------------------------------------
@register("compare_listings", """
PIVOT (SELECT listing_id, metric, value FROM (
         SELECT listing_id, CAST(price AS DOUBLE) AS price, CAST(rating AS DOUBLE) AS rating,
                CAST(sales AS DOUBLE) AS sales, CAST(review_count AS DOUBLE) AS review_count
         FROM listing WHERE listing_id IN (1, 2, 3))
       UNPIVOT (value FOR metric IN (price, rating, sales, review_count)))
ON listing_id IN (1, 2, 3) USING first(value) GROUP BY metric""", ("listing",))
def _compare(t):
    return P.compare_listings(t.listing(), [1, 2, 3])


COMP = """comp AS (SELECT a.listing_id, b.listing_id AS competitor_id,
       CAST(round(CAST(CAST(b.price AS DOUBLE) - CAST(a.price AS DOUBLE) AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_gap
  FROM listing a JOIN listing b ON a.business_area = b.business_area AND a.category = b.category
  WHERE a.listing_id <> b.listing_id AND a.price > 0 AND b.price > 0
    AND abs(CAST(a.price * 10000 AS BIGINT) - CAST(b.price * 10000 AS BIGINT)) * 10000 <= 2000 * CAST(a.price * 10000 AS BIGINT))"""
_PROF = f"""prof AS (SELECT listing_id, {AVG('taste')} AS avg_taste, {AVG('environment')} AS avg_environment,
                     {AVG('service')} AS avg_service, {AVG('rating')} AS avg_rating FROM review GROUP BY listing_id),
own AS (UNPIVOT prof ON avg_taste, avg_environment, avg_service, avg_rating INTO NAME dimension VALUE own)"""


SE = """se AS (SELECT listing_id, count(*) AS n_known, count(*) FILTER (WHERE sentiment > 0) AS n_good,
              count(*) FILTER (WHERE sentiment < 0) AS n_bad FROM review_text WHERE sentiment IS NOT NULL GROUP BY listing_id)"""


@register("strengths_weaknesses", f"""
WITH {COMP}, {_PROF},
pv AS (SELECT c.listing_id, o.dimension, CAST(sum(CAST(round(o.own * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100) AS peer_mean, count(*) AS peers
       FROM comp c JOIN own o ON o.listing_id = c.competitor_id GROUP BY 1, 2)
SELECT o.listing_id, o.dimension, o.own, {R('pv.peer_mean', 4)} AS peer_mean, pv.peers,
       {R('o.own - pv.peer_mean', 4)} AS diff,
       CASE WHEN {R('o.own - pv.peer_mean', 4)} > 0.2 THEN 'strength'
            WHEN {R('o.own - pv.peer_mean', 4)} < -0.2 THEN 'weakness' ELSE 'par' END AS flag
FROM own o JOIN pv ON pv.listing_id = o.listing_id AND pv.dimension = o.dimension""", ("listing", "review"))
def _sw(t):
    return P.strengths_weaknesses(t.review(), t.listing(), 0.2)


@register("competitor_totals", f"""
WITH {COMP}
SELECT l.listing_id, count(c.competitor_id) AS n, count(*) FILTER (WHERE c.price_gap < 0) AS n_cheaper,
       CAST(coalesce(sum(b.review_count), 0) AS BIGINT) AS review_count, count(b.review_count) AS n_review_count
FROM listing l LEFT JOIN comp c ON c.listing_id = l.listing_id LEFT JOIN listing b ON b.listing_id = c.competitor_id
WHERE l.price > 0 AND l.business_area IS NOT NULL AND l.category IS NOT NULL GROUP BY l.listing_id""", ("listing",))
def _competitor_totals(t):
    """Competitors of every listing, counted and added up without pairs."""
    return band_totals(t.listing(), 0.2, ["review_count"])


@register("swot", f"""
WITH {COMP}, {SE},
ast AS (SELECT area, avg(review_count) AS area_avg_reviews, count(*) AS area_n FROM listing GROUP BY area),
cp AS (SELECT category, avg(CAST(price AS DOUBLE)) AS cat_avg_price FROM listing WHERE price > 0 GROUP BY category),
cc AS (SELECT listing_id, count(*) AS n_comp, count(*) FILTER (WHERE price_gap < 0) AS n_cheaper FROM comp GROUP BY 1),
j AS (SELECT l.listing_id, l.price, l.rating, l.review_count, ast.area_avg_reviews, ast.area_n, cp.cat_avg_price,
             coalesce(cc.n_comp, 0) AS n_comp, coalesce(cc.n_cheaper, 0) AS n_cheaper, se.n_known, se.n_good, se.n_bad
      FROM listing l LEFT JOIN ast ON ast.area = l.area LEFT JOIN cp ON cp.category = l.category
      LEFT JOIN cc ON cc.listing_id = l.listing_id LEFT JOIN se ON se.listing_id = l.listing_id)
SELECT listing_id,
  list_filter([CASE WHEN rating >= 4.0 THEN 'high_rating' END,
               CASE WHEN review_count >= area_avg_reviews THEN 'popular' END,
               CASE WHEN n_good >= n_known * 0.8::DOUBLE THEN 'praised_in_reviews' END], lambda x: x IS NOT NULL) AS strengths,
  list_filter([CASE WHEN rating > 0 AND rating < 3.0 THEN 'low_rating' END,
               CASE WHEN CAST(price AS DOUBLE) > cat_avg_price * 1.2 THEN 'expensive' END,
               CASE WHEN n_bad >= n_known * 0.2::DOUBLE THEN 'criticised_in_reviews' END], lambda x: x IS NOT NULL) AS weaknesses,
  list_filter([CASE WHEN n_comp = 0 THEN 'no_direct_competitor' END,
               CASE WHEN area_n < (SELECT avg(area_n) FROM ast) THEN 'underserved_area' END], lambda x: x IS NOT NULL)
    AS opportunities,
  list_filter([CASE WHEN n_comp >= 3 THEN 'crowded_segment' END,
               CASE WHEN n_cheaper > 0 THEN 'cheaper_competitors' END], lambda x: x IS NOT NULL) AS threats
FROM j""", ("listing", "review_text"))
def _swot(t):
    return P.swot(t.listing(), 0.2, t.review_text())


@register("competition_landscape", f"""
WITH per AS (SELECT area, name AS chain, count(*) AS n FROM listing GROUP BY area, name),
tot AS (SELECT area, count(*) AS area_n FROM listing GROUP BY area),
sh AS (SELECT per.area, per.chain, per.n, {R('per.n * 100.0 / tot.area_n')} AS share FROM per JOIN tot ON per.area = tot.area),
conc AS (SELECT area, CAST(sum(n) AS BIGINT) AS n, {R('sum(pow(share / 100, 2))', 4)} AS hhi, arg_min(chain, (-n, chain)) AS leader
         FROM sh GROUP BY area),
sp AS (SELECT area, {R('CAST(max(price) AS DOUBLE) - CAST(min(price) AS DOUBLE)')} AS price_spread
       FROM listing WHERE price > 0 GROUP BY area)
SELECT conc.*, sp.price_spread FROM conc LEFT JOIN sp ON sp.area = conc.area""", ("listing",))
def _landscape(t):
    return P.competition_landscape(t.listing())


# ---- X1 - X7 -----------------------------------------------------------------------
_CAT_SERIES = """cs AS (SELECT l.category, CAST(date_trunc('month', r.ts) AS DATE) AS period, count(*) AS reviews
  FROM review r JOIN listing l ON l.listing_id = r.listing_id GROUP BY 1, 2)"""


@register("category_trend", f"""WITH {_CAT_SERIES}
SELECT *, reviews - lag(reviews) OVER (PARTITION BY category ORDER BY period) AS change FROM cs""",
          ("listing", "review"))
def _category_trend(t):
    return X.category_trend(t.listing(), t.review(), "month")


@register("category_listing_trend", """
SELECT *, listings - lag(listings) OVER (PARTITION BY category ORDER BY period) AS change FROM (
  SELECT category, CAST(date_trunc('month', seen_at) AS DATE) AS period, count(*) AS listings
  FROM listing WHERE seen_at IS NOT NULL GROUP BY 1, 2)""", ("listing",))
def _category_listing_trend(t):
    return X.category_listing_trend(t.listing())


@register("new_listing_trend", """
SELECT CAST(date_trunc('month', seen_at) AS DATE) AS period, area, count(*) AS new_listings
FROM listing WHERE seen_at IS NOT NULL GROUP BY 1, 2""", ("listing",))
def _new_listing_trend(t):
    return X.new_listing_trend(t.listing())


@register("price_trend", f"""
WITH j AS (SELECT CAST(date_trunc('month', r.ts) AS DATE) AS month, CAST(date_trunc('quarter', r.ts) AS DATE) AS quarter,
                  CAST(l.price AS DOUBLE) AS p
           FROM review r JOIN listing l ON l.listing_id = r.listing_id WHERE l.price > 0)
SELECT CASE WHEN GROUPING(month, quarter) = 1 THEN 'month' ELSE 'quarter' END AS level,
       coalesce(month, quarter) AS period, {AVG('p')} AS avg_price, count(*) AS n
FROM j GROUP BY GROUPING SETS ((month), (quarter))""", ("listing", "review"))
def _price_trend(t):
    return X.price_trend(t.listing(), t.review())


@register("business_area_trend", """
WITH s AS (SELECT l.business_area, CAST(date_trunc('year', r.ts) AS DATE) AS period, count(*) AS reviews
           FROM review r JOIN listing l ON l.listing_id = r.listing_id GROUP BY 1, 2),
rk AS (SELECT *, rank() OVER (PARTITION BY period ORDER BY reviews DESC) AS rank FROM s)
SELECT *, lag(rank) OVER (PARTITION BY business_area ORDER BY period) - rank AS rank_change FROM rk""",
          ("listing", "review"))
def _business_area_trend(t):
    return X.business_area_trend(t.listing(), t.review(), "year")


@register("seasonal_index", f"""
WITH mo AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS period, count(*) AS n FROM review GROUP BY 1)
SELECT month(period) AS month, {R('avg(n)')} AS mean_count,
       {R('avg(n) / (SELECT avg(n) FROM mo)', 4)} AS seasonal_index
FROM mo GROUP BY month(period)""", ("review",))
def _seasonal_index(t):
    return X.seasonal_index(t.review())


@register("forecast_linear", f"""WITH {_CAT_SERIES},
s AS (SELECT category, year(period) * 12 + month(period) - 1 AS t, CAST(reviews AS DOUBLE) AS y FROM cs),
fit AS (SELECT category, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, max(t) AS t_last
        FROM s GROUP BY category),
fut AS (SELECT category, slope, intercept, unnest(range(t_last + 1, t_last + 4)) AS t FROM fit)
SELECT category, make_date(CAST(floor(t / 12) AS INT), CAST(t % 12 + 1 AS INT), 1) AS period,
       {R('intercept + slope * t')} AS forecast, {R('slope', 6)} AS slope, {R('intercept', 4)} AS intercept
FROM fut""", ("listing", "review"))
def _forecast(t):
    s = X.category_trend(t.listing(), t.review(), "month")
    return X.forecast_linear(s, "category", "reviews", 3)


@register("moving_average", f"""WITH {_CAT_SERIES}
SELECT *, {R('avg(CAST(reviews AS DOUBLE)) OVER (PARTITION BY category ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 4)}
  AS moving_avg FROM cs""", ("listing", "review"))
def _moving_average(t):
    s = X.category_trend(t.listing(), t.review(), "month").drop("change")
    return X.moving_average(s, "category", "reviews", 3)


@register("listing_feature_columns", f"""
WITH {_TAGS_PER_LISTING}, {_FEAT} SELECT * FROM f""", ("listing", "review_text"))
def _listing_feature_columns(t):
    """The plain feature columns behind R5/R6 (the ML vector form is ``listing_features``)."""
    return Rc.feature_columns(t.listing(), Rc.listing_tags(t.review_text(), SCENES))
