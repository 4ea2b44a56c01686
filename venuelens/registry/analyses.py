"""Declared analyses A11, A13-A16, A19-A25 over the stand-in views."""

from __future__ import annotations

from ..operators import aggregates as A
from . import register
from .dashboard import AVG, R

TODAY = "1996-06-03"

_EXTENT = """extent AS (
  SELECT area, CAST((max(latitude) - min(latitude)) * (max(longitude) - min(longitude)) AS DOUBLE) AS size
  FROM listing WHERE area IS NOT NULL AND area <> '' GROUP BY area)"""


@register("area_density", f"""
WITH {_EXTENT},
counts AS (SELECT area, count(*) AS count FROM listing WHERE area IS NOT NULL AND area <> '' GROUP BY area)
SELECT c.area, c.count, {R('c.count / nullif(e.size, 0.0)', 4)} AS density
FROM counts c LEFT JOIN extent e ON c.area = e.area""", ("listing",))
def _area_density(t):
    lst = t.listing()
    return A.area_density(lst, A.area_extent(lst))


@register("area_category_cross", """
SELECT area, category, count(*) AS count, GROUPING(area, category) AS gid
FROM listing GROUP BY CUBE (area, category)""", ("listing",))
def _area_category_cross(t):
    return A.area_category_cross(t.listing())


def _tier_sql(col: str) -> str:
    parts = []
    for label, lo, hi in A.PRICE_TIERS:
        cond = f"{col} > {lo}" + (f" AND {col} <= {hi}" if hi is not None else "")
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


@register("area_price_level", f"""
SELECT area, {_tier_sql('price')} AS level, count(*) AS count, {AVG('price')} AS mean_price,
       {R('median(CAST(price AS DOUBLE))')} AS median_price
FROM listing WHERE area IS NOT NULL AND area <> '' AND price > 0 GROUP BY 1, 2""", ("listing",))
def _area_price_level(t):
    return A.area_price_level(t.listing())


@register("heatmap_cells", f"""
SELECT CAST(floor(CAST(latitude * 1000000 AS BIGINT) / 50000) AS BIGINT) AS lat_idx,
       CAST(floor(CAST(longitude * 1000000 AS BIGINT) / 50000) AS BIGINT) AS lng_idx,
       count(*) AS count, {R('sum(CAST(rating AS DOUBLE))')} AS weight
FROM listing WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""", ("listing",))
def _heatmap_cells(t):
    return A.heatmap_cells(t.listing(), 0.05, "rating")


@register("map_clusters", f"""
SELECT z.zoom, CAST(floor(CAST(latitude * 1000000 AS BIGINT) / z.su) AS BIGINT) AS lat_idx,
       CAST(floor(CAST(longitude * 1000000 AS BIGINT) / z.su) AS BIGINT) AS lng_idx,
       count(*) AS count, {AVG('latitude', 4)} AS lat, {AVG('longitude', 4)} AS lng
FROM listing JOIN (VALUES (0, 320000), (1, 160000), (2, 80000), (3, 40000)) AS z(zoom, su) ON TRUE
WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3""", ("listing",))
def _map_clusters(t):
    return A.map_clusters(t.listing(), (0, 1, 2, 3), 0.32)


@register("category_price_compare", f"""
SELECT category, count(*) AS count, {AVG('price')} AS avg_price,
       {R("avg(CAST(price AS DOUBLE)) - (SELECT avg(CAST(price AS DOUBLE)) FROM listing WHERE category IS NOT NULL AND category <> '' AND price > 0)")} AS diff_to_overall
FROM listing WHERE category IS NOT NULL AND category <> '' AND price > 0 GROUP BY category""", ("listing",))
def _category_price_compare(t):
    return A.category_price_compare(t.listing())


@register("listing_rating_profile", f"""
SELECT listing_id, {AVG('rating')} AS avg_rating, {AVG('taste')} AS avg_taste,
       {AVG('environment')} AS avg_environment, {AVG('service')} AS avg_service, count(*) AS n_reviews
FROM review GROUP BY listing_id""", ("review",))
def _listing_rating_profile(t):
    return A.listing_rating_profile(t.review())


@register("listing_detail", f"""
WITH prof AS (
  SELECT listing_id, {AVG('rating')} AS avg_rating, {AVG('taste')} AS avg_taste,
         {AVG('environment')} AS avg_environment, {AVG('service')} AS avg_service, count(*) AS n_reviews
  FROM review GROUP BY listing_id),
ranked AS (
  SELECT listing_id, item_id, name AS item_name, mention_count,
         row_number() OVER (PARTITION BY listing_id ORDER BY mention_count DESC, item_id) AS item_rank
  FROM item)
SELECT l.listing_id, l.name, l.category, l.area, l.price, l.rating,
       p.avg_rating, p.avg_taste, p.avg_environment, p.avg_service, p.n_reviews,
       r.item_id, r.item_name, r.mention_count, r.item_rank
FROM listing l LEFT JOIN prof p ON p.listing_id = l.listing_id LEFT JOIN ranked r ON r.listing_id = l.listing_id""",
          ("listing", "review", "item"))
def _listing_detail(t):
    return A.listing_detail(t.listing(), t.review(), t.item())


@register("home_kpis", f"""
SELECT count(*) AS total_listings,
       (SELECT count(*) FROM review) AS total_reviews,
       count(DISTINCT CASE WHEN business_area IS NOT NULL AND business_area <> '' THEN business_area END) AS business_areas,
       count(*) FILTER (WHERE CAST(seen_at AS DATE) = DATE '{TODAY}') AS new_listings,
       (SELECT count(*) FROM review WHERE CAST(ts AS DATE) = DATE '{TODAY}') AS new_reviews,
       (SELECT l.category FROM review r JOIN listing l ON l.listing_id = r.listing_id
        WHERE CAST(r.ts AS DATE) = DATE '{TODAY}' GROUP BY l.category ORDER BY count(*) DESC, l.category LIMIT 1)
         AS hottest_category
FROM listing""", ("listing", "review"))
def _home_kpis(t):
    return A.home_kpis(t.listing(), t.review(), TODAY)


@register("crawl_monitor", f"""
SELECT source, count(*) AS runs,
       {R("count(*) FILTER (WHERE status = 'success') * 100.0 / count(*)")} AS success_rate,
       CAST(sum(total_count) AS BIGINT) AS items, max(start_time) AS last_run,
       {AVG("epoch(CAST(end_time AS TIMESTAMP)) - epoch(CAST(start_time AS TIMESTAMP))")} AS avg_duration
FROM fetch_task GROUP BY source""", ("fetch_task",))
def _crawl_monitor(t):
    return A.crawl_monitor(t.fetch_task())


QUALITY_RULES = {
    "name": {},
    "area": {"sentinels": ["Brand#25"]},
    "price": {"sentinels": [0], "min": 0, "max": 250},
    "rating": {"sentinels": [0], "min": 0, "max": 5},
    "seen_at": {},
}


def _quality_sql() -> str:
    parts = []
    for c, r in QUALITY_RULES.items():
        is_str = c in ("name", "area")
        blank = f"count(*) FILTER (WHERE trim({c}) = '')" if is_str else "0"
        if r.get("sentinels"):
            vals = ", ".join(repr(v) for v in r["sentinels"])
            sent = f"count(*) FILTER (WHERE {c} IN ({vals}))"
        else:
            sent = "0"
        viol = []
        if "min" in r:
            viol.append(f"{c} < {r['min']}")
        if "max" in r:
            viol.append(f"{c} > {r['max']}")
        vcond = " OR ".join(viol) if viol else "FALSE"
        parts.append(f"""SELECT '{c}' AS "column", count(*) AS rows,
  {R(f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)")} AS null_share,
  {R(f"{blank} * 100.0 / count(*)")} AS blank_share,
  {R(f"{sent} * 100.0 / count(*)")} AS sentinel_share,
  count(*) FILTER (WHERE coalesce({vcond}, FALSE)) AS violations FROM listing""")
    return "\nUNION ALL ".join(parts)


@register("data_quality", _quality_sql(), ("listing",))
def _data_quality(t):
    return A.data_quality(t.listing(), QUALITY_RULES)


@register("duplicate_review_ids", """
SELECT review_id, count(*) AS copies FROM review GROUP BY review_id HAVING count(*) > 1""", ("review",))
def _duplicate_keys(t):
    return A.duplicate_keys(t.review(), "review_id")


@register("approx_profile")
def _approx_profile(t):
    """Sketch-based; checked against exact counts within the error bound in the tests."""
    return A.approx_profile(t.listing(), t.review())


@register("approx_profile_by_month", """
SELECT coalesce(month, 'all') AS month, count(*) AS n, count(DISTINCT user_id) AS who_exact, TRUE AS who_within, TRUE AS median_within
FROM (SELECT strftime(ts, '%Y-%m') AS month, user_id FROM review) GROUP BY ROLLUP (month)""", ("review",))
def _approx_profile_by_month(t):
    """Sketches stored by month and merged: raters and median rating, held against exact counts."""
    return A.sketch_profile(t.review(), "user_id", "rating")
