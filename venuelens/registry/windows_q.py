"""Ranking / window operators W4-W8, W10."""

from __future__ import annotations

from ..operators import aggregates as A
from ..operators import windows as W
from . import register
from .dashboard import AVG, R

_AREA_PRICE = f"""area_price AS (SELECT area AS name, {AVG('price')} AS avg_price FROM listing
  WHERE area IS NOT NULL AND area <> '' AND price > 0 GROUP BY area)"""


@register("top_bottom_area_price", f"""
WITH {_AREA_PRICE}
SELECT * FROM (SELECT 'top' AS side, name, avg_price AS value,
                      row_number() OVER (ORDER BY avg_price DESC, name) AS rank FROM area_price) WHERE rank <= 3
UNION ALL
SELECT * FROM (SELECT 'bottom', name, avg_price, row_number() OVER (ORDER BY avg_price, name) AS rank
               FROM area_price) WHERE rank <= 3""", ("listing",))
def _top_bottom(t):
    agg = A.area_avg_price(t.listing(), [], 2)
    return W.top_bottom(agg, "avg_price", "name", 3)


_VFM = f"{R('(CAST(rating AS DOUBLE) / 5) / (CAST(price AS DOUBLE) / 100)', 4)}"


@register("value_for_money_rank", f"""
SELECT * FROM (SELECT listing_id, category, vfm_index,
                      dense_rank() OVER (PARTITION BY category ORDER BY vfm_index DESC) AS rank
               FROM (SELECT listing_id, category, {_VFM} AS vfm_index FROM listing WHERE price > 0 AND rating > 0))
WHERE rank <= 10""", ("listing",))
def _vfm_rank(t):
    return W.value_for_money_rank(t.listing(), 10, "category")


@register("value_for_money_top", f"""
SELECT * FROM (SELECT listing_id, vfm_index, dense_rank() OVER (ORDER BY vfm_index DESC) AS rank FROM (
  SELECT listing_id, {_VFM} AS vfm_index FROM listing WHERE price > 0 AND rating > 0)) WHERE rank <= 10""", ("listing",))
def _vfm_top(t):
    return W.value_for_money_rank(t.listing(), 10, None)


def _norm(c):
    return (f"coalesce((CAST({c} AS DOUBLE) - (SELECT min(CAST({c} AS DOUBLE)) FROM listing)) / "
            f"nullif((SELECT max(CAST({c} AS DOUBLE)) FROM listing) - (SELECT min(CAST({c} AS DOUBLE)) FROM listing), 0.0), 0.0)")


@register("hot_rank", f"""
SELECT * FROM (SELECT listing_id, rating, review_count, sales, hot_score, rank() OVER (ORDER BY hot_score DESC) AS rank FROM (
  SELECT listing_id, rating, review_count, sales,
         {R(f"{_norm('rating')} * 0.5 + {_norm('review_count')} * 0.3 + {_norm('sales')} * 0.2", 6)} AS hot_score
  FROM listing)) WHERE rank <= 20""", ("listing",))
def _hot_rank(t):
    return W.hot_rank(t.listing())


@register("market_share", f"""
SELECT p.area, p.chain, p.n, {R('p.n * 100.0 / t.area_n')} AS share
FROM (SELECT area, name AS chain, count(*) AS n FROM listing GROUP BY area, name) p
JOIN (SELECT area, count(*) AS area_n FROM listing GROUP BY area) t ON p.area = t.area""", ("listing",))
def _market_share(t):
    return W.market_share(t.listing())


@register("price_anomaly_zscore", f"""
WITH pos AS (SELECT listing_id, category, CAST(price AS DOUBLE) AS p FROM listing WHERE price > 0),
st AS (SELECT category, avg(p) AS mu, stddev_samp(p) AS sd FROM pos GROUP BY category),
z AS (SELECT pos.listing_id, pos.category, pos.p AS price, {R('(pos.p - st.mu) / nullif(st.sd, 0.0)', 4)} AS score
      FROM pos JOIN st ON pos.category = st.category)
SELECT *, CASE WHEN score > 1.5 THEN 'high' ELSE 'low' END AS flag FROM z WHERE score > 1.5 OR score < -1.5""", ("listing",))
def _price_anomaly_z(t):
    return W.price_anomaly(t.listing(), "zscore", 1.5)


@register("price_anomaly_iqr", f"""
WITH pos AS (SELECT listing_id, area, CAST(price AS DOUBLE) AS p FROM listing WHERE price > 0),
st AS (SELECT area, quantile_cont(p, 0.25) AS q1, quantile_cont(p, 0.75) AS q3 FROM pos GROUP BY area),
f AS (SELECT pos.listing_id, pos.area, pos.p AS price, {R('st.q1 - (st.q3 - st.q1) * 0.5', 4)} AS low_fence,
             {R('st.q3 + (st.q3 - st.q1) * 0.5', 4)} AS high_fence FROM pos JOIN st ON pos.area = st.area)
SELECT *, CASE WHEN price > high_fence THEN 'high' ELSE 'low' END AS flag FROM f
WHERE price > high_fence OR price < low_fence""",
          ("listing",))
def _price_anomaly_iqr(t):
    return W.price_anomaly(t.listing(), "iqr", 0.5, by="area")


@register("max_scale", f"""
WITH c AS (SELECT area AS name, count(*) AS n FROM listing WHERE area IS NOT NULL AND area <> '' GROUP BY area)
SELECT name, CAST(n AS DOUBLE) AS value, {R('n / nullif((SELECT max(CAST(n AS DOUBLE)) FROM c), 0.0)', 4)} AS scaled
FROM c""", ("listing",))
def _max_scale(t):
    return W.max_scale(A.area_distribution(t.listing()), "count")
