"""Joins J1-J10, sets U2-U4, search / paging F1-F6 and W1-W3."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dims
from ..operators import aggregates as A
from ..operators import filters as Fl
from ..operators import joins as J
from ..operators import sets as U
from . import register
from .dashboard import AVG


# ---- J1 - J4, J6, J9 ---------------------------------------------------------------
@register("favorites_only", "SELECT * FROM listing WHERE listing_id IN (SELECT listing_id FROM favorite)",
          ("listing", "favorite"))
def _favorites_only(t):
    return J.favorites_only(t.listing(), t.favorite())


@register("exclude_favorites", "SELECT * FROM catalog WHERE listing_id NOT IN (SELECT listing_id FROM favorite)",
          ("listing", "catalog", "favorite"))
def _exclude_favorites(t):
    """Listings that nobody has saved."""
    return J.exclude_favorites(t.catalog(), t.favorite())


@register("user_favorites", """
SELECT f.listing_id, f.user_id, f.created_at, l.* EXCLUDE (listing_id)
FROM favorite f JOIN listing l ON l.listing_id = f.listing_id""", ("listing", "favorite"))
def _user_favorites(t):
    return J.user_favorites(t.listing(), t.favorite())


@register("user_favorites_page", """
SELECT f.listing_id, f.user_id, f.created_at, l.* EXCLUDE (listing_id)
FROM favorite f JOIN listing l ON l.listing_id = f.listing_id
ORDER BY f.created_at DESC, f.user_id, f.listing_id LIMIT 20 OFFSET 40""", ("listing", "favorite"))
def _user_favorites_page(t):
    return J.user_favorites(t.listing(), t.favorite(), page_no=3, size=20)


@register("user_favorites_total", """
SELECT count(*) AS total FROM favorite f JOIN listing l ON l.listing_id = f.listing_id""", ("listing", "favorite"))
def _user_favorites_total(t):
    return Fl.total(J.user_favorites(t.listing(), t.favorite()))


@register("listing_reviews_total", """
SELECT count(*) AS total FROM review r WHERE EXISTS (SELECT 1 FROM listing l WHERE l.listing_id = r.listing_id)""",
          ("listing", "review"))
def _listing_reviews_total(t):
    return Fl.total(J.listing_reviews(t.listing(), t.review()))


@register("listing_reviews", """
SELECT * FROM review r WHERE EXISTS (SELECT 1 FROM listing l WHERE l.listing_id = r.listing_id)""",
          ("listing", "review"))
def _listing_reviews(t):
    return J.listing_reviews(t.listing(), t.review())


@register("listing_reviews_page", """
SELECT listing_id, review_id, user_id, rating, taste, environment, service, ts, likes FROM review r
WHERE EXISTS (SELECT 1 FROM listing l WHERE l.listing_id = r.listing_id)
ORDER BY rating DESC, ts DESC, review_id, user_id LIMIT 20 OFFSET 100""", ("listing", "review"))
def _listing_reviews_page(t):
    return J.listing_reviews(t.listing(), t.review(), sort_by="rating", page_no=6, size=20)


@register("fetch_backlog", "SELECT * FROM catalog WHERE listing_id NOT IN (SELECT listing_id FROM review)",
          ("listing", "catalog", "review"))
def _fetch_backlog(t):
    """Listings without a review."""
    return J.fetch_backlog(t.catalog(), t.review())


@register("orphan_check", """
SELECT * FROM review_text r WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = r.review_id)""", ("review_text",))
def _orphan_check(t):
    """Reviews that the table of checked reviews does not hold."""
    return J.orphan_check(t.review_text(), t.labels.select(F.col("doc_id").alias("review_id")), "review_id")


# ---- J5 ----------------------------------------------------------------------------
@register("enrich_search_with_detail", f"""
WITH d AS (SELECT TRY_CAST(id AS BIGINT) AS listing_id,
                  CASE WHEN trim(title) = '' THEN '-' ELSE trim(title) END AS name, address FROM raw_listing
           WHERE TRY_CAST(id AS BIGINT) IS NOT NULL),
prof AS (SELECT listing_id, {AVG('rating')} AS avg_rating, {AVG('taste')} AS avg_taste,
                {AVG('environment')} AS avg_environment, {AVG('service')} AS avg_service, count(*) AS n_reviews
         FROM review GROUP BY listing_id)
SELECT s.listing_id, CASE WHEN d.name IS NOT NULL AND d.name <> '-' THEN d.name ELSE s.name END AS name,
       s.category, s.price, d.address, g.latitude, g.longitude,
       p.avg_rating, p.avg_taste, p.avg_environment, p.avg_service, p.n_reviews
FROM listing s LEFT JOIN d ON d.listing_id = s.listing_id
LEFT JOIN (SELECT listing_id, latitude, longitude FROM listing) g ON g.listing_id = s.listing_id
LEFT JOIN prof p ON p.listing_id = s.listing_id""", ("listing", "review", "raw_listing"))
def _enrich(t):
    lst = t.listing()
    search = lst.select("listing_id", "name", "category", "price")
    detail = (t.raw_listing().select(F.col("id").try_cast("long").alias("listing_id"),
                                     F.when(F.trim("title") == "", "-").otherwise(F.trim("title")).alias("name"),
                                     "address").where(F.col("listing_id").isNotNull()))
    location = lst.select("listing_id", "latitude", "longitude")
    reviews = A.listing_rating_profile(t.review())
    return J.enrich_search_with_detail(search, detail, location, reviews, overlay=["name", "address"])


# ---- J7 ----------------------------------------------------------------------------
def _dict_values(d: dict) -> str:
    rows, pos = [], 0
    for g, terms in d.items():
        for term in terms:
            rows.append(f"('{g}', '{term}', {pos})")
            pos += 1
    return "(VALUES " + ", ".join(rows) + ") AS dim(grp, term, priority)"


@register("dictionary_match", f"""
SELECT r.review_id, dim.grp, dim.term, dim.priority
FROM review_text r JOIN {_dict_values(dims.STANDIN_DISHES_DICT)} ON contains(lower(r.text), dim.term)""",
          ("review_text",))
def _dictionary_match(t):
    dim = dims.terms_df(t.spark, dims.STANDIN_DISHES_DICT)
    return J.dictionary_match(t.review_text(), "review_id", "text", dim, case_insensitive=True)


_LONG_WORDS = """(SELECT substr(term, 1, 1) AS grp, term, CAST(length(term) AS INTEGER) AS priority FROM
  (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{13,}')) AS term FROM benchmark))"""


@register("dictionary_match_table", f"""
SELECT r.review_id, dim.grp, dim.term, dim.priority
FROM review_text r JOIN {_LONG_WORDS} dim ON contains(lower(r.text), dim.term)""", ("review_text",))
def _dictionary_match_table(t):
    """A dictionary that is a table (the long words of the benchmark passages), joined by substrings."""
    words = t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{13,}"), F.lit(0))).alias("term")).distinct()
    dim = words.select(F.substring("term", 1, 1).alias("grp"), "term", F.length("term").cast("int").alias("priority"))
    return J.substring_join(t.review_text(), "review_id", "text", dim, case_insensitive=True)


@register("dictionary_first_match", f"""
SELECT review_id, arg_min(grp, priority) AS grp FROM (
  SELECT r.review_id, dim.grp, dim.priority
  FROM review_text r JOIN {_dict_values(dims.STANDIN_DISHES_DICT)} ON contains(lower(r.text), dim.term))
GROUP BY review_id""", ("review_text",))
def _dictionary_first_match(t):
    dim = dims.terms_df(t.spark, dims.STANDIN_DISHES_DICT)
    return J.first_match(J.dictionary_match(t.review_text(), "review_id", "text", dim, True), "review_id")


# ---- J8 ----------------------------------------------------------------------------
@register("find_competitors", """
SELECT a.listing_id, b.listing_id AS competitor_id, a.business_area, a.category,
       CAST(round(CAST(CAST(b.price AS DOUBLE) - CAST(a.price AS DOUBLE) AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_gap
FROM listing a JOIN listing b ON a.business_area = b.business_area AND a.category = b.category
WHERE a.listing_id <> b.listing_id AND a.price > 0 AND b.price > 0
  AND abs(CAST(a.price * 10000 AS BIGINT) - CAST(b.price * 10000 AS BIGINT)) * 10000 <= 2000 * CAST(a.price * 10000 AS BIGINT)""", ("listing",))
def _find_competitors(t):
    return J.find_competitors(t.listing(), 0.2)


# ---- J10 ---------------------------------------------------------------------------
@register("price_band_join", """
SELECT listing_id, price, b.bucket, b.label FROM listing JOIN
 (VALUES (1, '50元以下', 0.0, 50.0), (2, '51-100元', 50.0, 100.0), (3, '101-200元', 100.0, 200.0),
         (4, '200元以上', 200.0, NULL)) AS b(bucket, label, lo, hi)
 ON CAST(price AS DOUBLE) > b.lo AND (b.hi IS NULL OR CAST(price AS DOUBLE) <= b.hi)""", ("listing",))
def _price_band_join(t):
    return J.band_join(t.listing(), "price", dims.PRICE_BUCKETS)


# ---- U2 - U4 -----------------------------------------------------------------------
@register("merge_sources", """
SELECT listing_id, name, area, CAST(price AS DOUBLE) AS price, 1 AS source_no FROM listing
UNION ALL BY NAME
SELECT TRY_CAST(id AS BIGINT) AS listing_id, trim(title) AS name, address, tel AS phone, 2 AS source_no FROM raw_listing""",
          ("listing", "raw_listing"))
def _merge_sources(t):
    a = t.listing().select("listing_id", "name", "area", F.col("price").cast("double").alias("price"))
    b = t.raw_listing().select(F.col("id").try_cast("long").alias("listing_id"), F.trim("title").alias("name"),
                               "address", F.col("tel").alias("phone"))
    return U.merge_sources(a, b)


@register("known_plus_extra", f"""
SELECT area, true AS known FROM (VALUES {', '.join(f"('{a}')" for a in dims.STANDIN_KNOWN_AREAS)}) AS k(area)
UNION ALL
SELECT DISTINCT area, false FROM listing WHERE area IS NOT NULL AND area <> ''
  AND area NOT IN ({', '.join(f"'{a}'" for a in dims.STANDIN_KNOWN_AREAS)})""", ("listing",))
def _known_plus_extra(t):
    return U.known_plus_extra(t.listing(), dims.STANDIN_KNOWN_AREAS, "area")


_OLD = "SELECT listing_id, name, category, area, price, rating FROM listing WHERE seen_at < TIMESTAMP '1996-01-01'"
_NEW = ("SELECT listing_id, name, category, area, CASE WHEN category = 'PROMO' THEN price + 1 ELSE price END AS price, "
        "rating FROM listing")


def _snapshots(t):
    lst = t.listing()
    old = lst.where(F.col("seen_at") < F.lit("1996-01-01").cast("timestamp_ntz")).select(
        "listing_id", "name", "category", "area", "price", "rating")
    new = lst.select("listing_id", "name", "category", "area",
                     F.when(F.col("category") == "PROMO", F.col("price") + 1).otherwise(F.col("price"))
                     .cast("decimal(10,2)").alias("price"), "rating")
    return old, new


_DIFF_SQL = f"""
SELECT coalesce(o.listing_id, n.listing_id) AS listing_id,
       CASE WHEN o.listing_id IS NULL THEN 'inserted' WHEN n.listing_id IS NULL THEN 'removed'
            WHEN (o.name, o.category, o.area, o.price, o.rating) IS NOT DISTINCT FROM
                 (n.name, n.category, n.area, CAST(n.price AS DECIMAL(10,2)), n.rating) THEN 'unchanged'
            ELSE 'updated' END AS status
FROM ({_OLD}) o FULL OUTER JOIN ({_NEW}) n ON o.listing_id = n.listing_id"""


@register("sync_diff", _DIFF_SQL, ("listing",))
def _sync_diff(t):
    return U.sync_diff(*_snapshots(t), "listing_id")


@register("sync_counts", f"SELECT status, count(*) AS count FROM ({_DIFF_SQL}) GROUP BY status", ("listing",))
def _sync_counts(t):
    return U.sync_counts(U.sync_diff(*_snapshots(t), "listing_id"))


# ---- F1 - F6, W1 - W3 --------------------------------------------------------------
_SEARCH_WHERE = """(lower(name) LIKE '%blue%' OR lower(category) LIKE '%blue%' OR lower(area) LIKE '%blue%')
  AND contains(area, 'Brand#1') AND price >= 50 AND rating >= 2.0"""


@register("search_listings", f"""
SELECT * FROM listing WHERE {_SEARCH_WHERE} ORDER BY price, listing_id LIMIT 20 OFFSET 20""", ("listing",))
def _search_listings(t):
    return Fl.search_listings(t.listing(), keyword="Blue", area="Brand#1", price_min=50, rating_min=2.0,
                              sort_by="price", page_no=2, page_size=20)


@register("search_total", f"SELECT count(*) AS total FROM listing WHERE {_SEARCH_WHERE}", ("listing",))
def _search_total(t):
    return Fl.search_total(t.listing(), keyword="Blue", area="Brand#1", price_min=50, rating_min=2.0)


@register("search_default_page", """
SELECT * FROM listing WHERE category = 'PROMO' AND price <= 100 AND price >= 50
ORDER BY rating DESC, listing_id LIMIT 20""", ("listing",))
def _search_default(t):
    return Fl.search_listings(t.listing(), category="PROMO", preset="50-100")


@register("filter_logs", "SELECT * FROM job_log WHERE task_name = 'task_3' AND level = 'ERROR' "
          "ORDER BY create_time DESC, id DESC", ("job_log",))
def _filter_logs(t):
    return Fl.filter_logs(t.job_log(), "task_3", "error")


@register("filter_logs_page", """
SELECT * FROM job_log WHERE task_name = 'task_3' AND level = 'ERROR' ORDER BY create_time DESC, id DESC LIMIT 20 OFFSET 20""",
          ("job_log",))
def _filter_logs_page(t):
    return Fl.page(Fl.filter_logs(t.job_log(), "task_3", "error"), [F.desc("create_time"), F.desc("id")], 2, 20)


@register("filter_logs_total", "SELECT count(*) AS total FROM job_log WHERE task_name = 'task_3' AND level = 'ERROR'",
          ("job_log",))
def _filter_logs_total(t):
    return Fl.total(Fl.filter_logs(t.job_log(), "task_3", "error"))


@register("distinct_latest_tasks", "SELECT DISTINCT task_name FROM job_log ORDER BY task_name DESC LIMIT 50",
          ("job_log",))
def _distinct_latest_tasks(t):
    return Fl.distinct_latest_tasks(t.job_log())


@register("get_by_key", "SELECT * FROM listing WHERE listing_id = 42", ("listing",))
def _get_by_key(t):
    return Fl.get_by_key(t.listing(), "listing_id", 42)


@register("filter_training_rows", """
SELECT * FROM listing WHERE price > 0 AND rating > 0 AND category IS NOT NULL AND category <> ''
  AND area IS NOT NULL AND area <> ''""", ("listing",))
def _filter_training_rows(t):
    return Fl.filter_training_rows(t.listing())


@register("filter_polarity_positive", """
SELECT * FROM review_text WHERE text IS NOT NULL AND text <> '' AND sentiment > 0 AND rating >= 4""", ("review_text",))
def _filter_polarity_pos(t):
    return Fl.filter_polarity(t.review_text(), True)


@register("filter_polarity_negative", """
SELECT * FROM review_text WHERE text IS NOT NULL AND text <> '' AND sentiment < 0 AND rating <= 2.5""", ("review_text",))
def _filter_polarity_neg(t):
    return Fl.filter_polarity(t.review_text(), False)
