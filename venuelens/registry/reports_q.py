"""Reports B1-B5."""

from __future__ import annotations

from .. import dims
from ..plans import reports as B
from . import register
from .dashboard import AVG, R, _bucket_sql
from .recommend_q import COMP, SE
from .text_q import NEG, PAT, POS, STOP, _FLAT, _kw_sql

KNOWN = dims.STANDIN_KNOWN_AREAS
TARGET = 49


def _known_values() -> str:
    return "(VALUES " + ", ".join(f"('{a}')" for a in KNOWN) + ") AS k(name)"


def _report_sql(src: str) -> str:
    """Report sections over the listing rows selected by ``src`` (a SELECT)."""
    return f"""
WITH l AS ({src}),
ov AS (SELECT count(*) AS total_count, coalesce({AVG('nullif(rating, 0)')}, 0.0) AS avg_rating,
              coalesce({AVG('nullif(price, 0)')}, 0.0) AS avg_price, count(DISTINCT area) AS area_count FROM l),
ov_long AS (SELECT 0 AS i, 'total_count' AS label, CAST(total_count AS DOUBLE) AS value FROM ov
            UNION ALL SELECT 1, 'avg_rating', avg_rating FROM ov UNION ALL SELECT 2, 'avg_price', avg_price FROM ov
            UNION ALL SELECT 3, 'area_count', CAST(area_count AS DOUBLE) FROM ov),
ar AS (SELECT area AS name, count(*) AS count FROM l WHERE area IS NOT NULL AND area <> '' GROUP BY area),
ca AS (SELECT category AS name, count(*) AS count FROM l WHERE category IS NOT NULL AND category <> '' GROUP BY category),
pr AS ({_bucket_sql('price', dims.PRICE_BUCKETS, 'right', False, 'l')}),
rt AS ({_bucket_sql('rating', dims.RATING_BUCKETS, 'left', True, 'l')}),
ap0 AS (SELECT area AS name, {AVG('price', 1)} AS avg_price FROM l
        WHERE area IS NOT NULL AND area <> '' AND price > 0 GROUP BY area),
ap AS (SELECT coalesce(k.name, a.name) AS name, coalesce(a.avg_price, 0.0) AS avg_price
       FROM {_known_values()} FULL OUTER JOIN ap0 a ON k.name = a.name)
SELECT 'overview' AS section, label, value, row_number() OVER (ORDER BY i) AS rank FROM ov_long
UNION ALL SELECT 'area', name, CAST(count AS DOUBLE), row_number() OVER (ORDER BY count DESC, name) FROM ar
UNION ALL SELECT 'category', name, CAST(count AS DOUBLE), row_number() OVER (ORDER BY count DESC, name) FROM ca
UNION ALL SELECT 'price', label, CAST(count AS DOUBLE), row_number() OVER (ORDER BY bucket) FROM pr
UNION ALL SELECT 'rating', label, CAST(count AS DOUBLE), row_number() OVER (ORDER BY bucket) FROM rt
UNION ALL SELECT 'area_price', name, avg_price, row_number() OVER (ORDER BY avg_price DESC, name) FROM ap
UNION ALL SELECT * FROM (SELECT 'top_category', name, CAST(count AS DOUBLE),
                                row_number() OVER (ORDER BY count DESC, name) AS rank FROM ca) WHERE rank <= 12"""


@register("report_dataset", _report_sql("SELECT * FROM listing"), ("listing",))
def _report_dataset(t):
    return B.report_dataset(t.listing(), KNOWN)


@register("market_report", _report_sql(
    "SELECT * FROM listing WHERE contains(area, 'Brand#1') AND price >= 50 AND price <= 200"), ("listing",))
def _market_report(t):
    return B.market_report(t.listing(), KNOWN, area="Brand#1", price_min=50, price_max=200)


@register("market_report_period", _report_sql(
    "SELECT * FROM listing WHERE seen_at >= TIMESTAMP '1996-01-01' AND seen_at < TIMESTAMP '1998-06-01'"), ("listing",))
def _market_report_period(t):
    return B.market_report(t.listing(), KNOWN, seen_from="1996-01-01", seen_before="1998-06-01")


@register("report_facts", f"""
WITH ov AS (SELECT count(*) AS total_count, coalesce({AVG('nullif(rating, 0)')}, 0.0) AS avg_rating,
              coalesce({AVG('nullif(price, 0)')}, 0.0) AS avg_price, count(DISTINCT area) AS area_count FROM listing),
ar AS (SELECT area AS name, count(*) AS count FROM listing WHERE area IS NOT NULL AND area <> '' GROUP BY area
       ORDER BY count DESC, name LIMIT 3),
ca AS (SELECT category AS name, count(*) AS count FROM listing WHERE category IS NOT NULL AND category <> ''
       GROUP BY category ORDER BY count DESC, name LIMIT 1),
ap0 AS (SELECT area AS name, {AVG('price')} AS avg_price FROM listing
        WHERE area IS NOT NULL AND area <> '' AND price > 0 GROUP BY area),
ap AS (SELECT coalesce(k.name, a.name) AS name, coalesce(a.avg_price, 0.0) AS avg_price
       FROM {_known_values()} FULL OUTER JOIN ap0 a ON k.name = a.name)
SELECT 'total' AS key, printf('%d listings in %d areas, average rating %.2f, average price %.2f', total_count,
       area_count, avg_rating, avg_price) AS text FROM ov
UNION ALL SELECT 'top_areas', string_agg(printf('%s (%d)', name, count), ', ' ORDER BY count DESC, name) FROM ar
UNION ALL SELECT 'top_category', printf('%s (%d)', name, count) FROM ca
UNION ALL SELECT * FROM (SELECT 'max_area_price', printf('%s (%.2f)', name, avg_price) FROM ap
                         ORDER BY avg_price DESC, name LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'min_area_price', printf('%s (%.2f)', name, avg_price) FROM ap
                         ORDER BY avg_price, name LIMIT 1)""", ("listing",))
def _report_facts(t):
    return B.report_facts(t.listing(), KNOWN)


@register("competitor_report", f"""
WITH {COMP}, {SE},
mine AS (SELECT * FROM comp WHERE listing_id = {TARGET}),
own AS (SELECT CAST(price AS DOUBLE) AS price, CAST(rating AS DOUBLE) AS rating, CAST(sales AS DOUBLE) AS sales,
               CAST(review_count AS DOUBLE) AS review_count FROM listing WHERE listing_id = {TARGET}),
peer AS (SELECT avg(CAST(price AS DOUBLE)) AS price, avg(CAST(rating AS DOUBLE)) AS rating,
                avg(CAST(sales AS DOUBLE)) AS sales, avg(CAST(review_count AS DOUBLE)) AS review_count
         FROM listing WHERE listing_id IN (SELECT competitor_id FROM mine)),
prof AS (SELECT listing_id, {AVG('taste')} AS avg_taste, {AVG('environment')} AS avg_environment,
                {AVG('service')} AS avg_service, {AVG('rating')} AS avg_rating FROM review GROUP BY listing_id),
pl AS (UNPIVOT prof ON avg_taste, avg_environment, avg_service, avg_rating INTO NAME dimension VALUE own),
pv AS (SELECT m.listing_id, o.dimension, CAST(sum(CAST(round(o.own * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100) AS peer_mean FROM mine m JOIN pl o ON o.listing_id = m.competitor_id
       GROUP BY 1, 2),
sw AS (SELECT o.dimension, CASE WHEN {R('o.own - pv.peer_mean', 4)} > 0.2 THEN 'strength'
                                WHEN {R('o.own - pv.peer_mean', 4)} < -0.2 THEN 'weakness' ELSE 'par' END AS flag
       FROM pl o JOIN pv ON pv.listing_id = o.listing_id AND pv.dimension = o.dimension),
ast AS (SELECT area, avg(review_count) AS area_avg_reviews, count(*) AS area_n FROM listing GROUP BY area),
cp AS (SELECT category, avg(CAST(price AS DOUBLE)) AS cat_avg_price FROM listing WHERE price > 0 GROUP BY category),
cc AS (SELECT listing_id, count(*) AS n_comp, count(*) FILTER (WHERE price_gap < 0) AS n_cheaper FROM comp GROUP BY 1),
j AS (SELECT l.listing_id, l.price, l.rating, l.review_count, ast.area_avg_reviews, ast.area_n, cp.cat_avg_price,
             coalesce(cc.n_comp, 0) AS n_comp, coalesce(cc.n_cheaper, 0) AS n_cheaper, se.n_known, se.n_good, se.n_bad
      FROM listing l LEFT JOIN ast ON ast.area = l.area LEFT JOIN cp ON cp.category = l.category
      LEFT JOIN cc ON cc.listing_id = l.listing_id LEFT JOIN se ON se.listing_id = l.listing_id WHERE l.listing_id = {TARGET}),
sv AS (SELECT
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
               CASE WHEN n_cheaper > 0 THEN 'cheaper_competitors' END], lambda x: x IS NOT NULL) AS threats FROM j)
SELECT 'competitors' AS section, CAST(competitor_id AS VARCHAR) AS label, CAST(price_gap AS VARCHAR) AS value FROM mine
UNION ALL SELECT 'compare_own', m, printf('%.2f', v) FROM (UNPIVOT own ON price, rating, sales, review_count INTO NAME m VALUE v)
UNION ALL SELECT 'compare_peers', m, printf('%.2f', v) FROM (UNPIVOT peer ON price, rating, sales, review_count INTO NAME m VALUE v)
  WHERE v IS NOT NULL
UNION ALL SELECT 'strengths_weaknesses', dimension, flag FROM sw
UNION ALL SELECT 'swot', 'strengths', array_to_string(strengths, ',') FROM sv
UNION ALL SELECT 'swot', 'weaknesses', array_to_string(weaknesses, ',') FROM sv
UNION ALL SELECT 'swot', 'opportunities', array_to_string(opportunities, ',') FROM sv
UNION ALL SELECT 'swot', 'threats', array_to_string(threats, ',') FROM sv""", ("listing", "review", "review_text"))
def _competitor_report(t):
    return B.competitor_report(t.listing(), t.review(), TARGET, sentiment=t.review_text())


@register("dashboard", f"""
WITH ov AS (SELECT count(*) AS total_count, coalesce({AVG('nullif(rating, 0)')}, 0.0) AS avg_rating,
              coalesce({AVG('nullif(price, 0)')}, 0.0) AS avg_price, count(DISTINCT area) AS area_count FROM listing),
ca AS (SELECT category AS name, count(*) AS count FROM listing WHERE category IS NOT NULL AND category <> '' GROUP BY category),
pr AS ({_bucket_sql('price', dims.PRICE_BUCKETS, 'right', False, 'listing')}),
rt AS ({_bucket_sql('rating', dims.RATING_BUCKETS, 'left', True, 'listing')}),
ap0 AS (SELECT area AS name, {AVG('price')} AS avg_price FROM listing
        WHERE area IS NOT NULL AND area <> '' AND price > 0 GROUP BY area),
ap AS (SELECT coalesce(k.name, a.name) AS name, coalesce(a.avg_price, 0.0) AS avg_price
       FROM {_known_values()} FULL OUTER JOIN ap0 a ON k.name = a.name),
kw AS ({_kw_sql('sentiment > 0 AND rating >= 4', POS, _FLAT[POS])}
       UNION ALL {_kw_sql('sentiment < 0 AND rating <= 2.5', NEG, _FLAT[NEG])})
SELECT 'overview' AS section, 'total_count' AS label, CAST(total_count AS VARCHAR) AS value FROM ov
UNION ALL SELECT 'overview', 'avg_rating', CAST(avg_rating AS VARCHAR) FROM ov
UNION ALL SELECT 'overview', 'avg_price', CAST(avg_price AS VARCHAR) FROM ov
UNION ALL SELECT 'overview', 'area_count', CAST(area_count AS VARCHAR) FROM ov
UNION ALL SELECT 'area_distribution', area, CAST(count(*) AS VARCHAR) FROM listing WHERE area IS NOT NULL AND area <> ''
  GROUP BY area
UNION ALL SELECT 'category_distribution', name, CAST(count AS VARCHAR) FROM ca
UNION ALL SELECT 'price_distribution', label, CAST(count AS VARCHAR) FROM pr
UNION ALL SELECT 'rating_distribution', label, CAST(count AS VARCHAR) FROM rt
UNION ALL SELECT 'area_avg_price', name, CAST(avg_price AS VARCHAR) FROM ap
UNION ALL SELECT 'review_keywords', polarity || ':' || word, CAST(count AS VARCHAR) FROM kw""",
          ("listing", "review_text"))
def _dashboard(t):
    res = B.dashboard(t.listing(), t.review_text(), KNOWN, _FLAT, stop=STOP, n=30, pattern=PAT, labels=(POS, NEG))
    return B.dashboard_long(res)

