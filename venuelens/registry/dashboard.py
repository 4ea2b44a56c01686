"""Dashboard aggregates A1-A10 (and A12) over the listing stand-in."""

from __future__ import annotations

from .. import dims
from ..operators import aggregates as A
from . import register

# SQL rounding that matches ``round_half_up``: double -> DECIMAL(38,10) -> round.
def R(expr: str, d: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def AVG(expr: str, d: int = 2) -> str:
    return R(f"avg(CAST(({expr}) AS DOUBLE))", d)


def VALUES(col: str, items) -> str:
    rows = ", ".join("(" + ", ".join(_lit(v) for v in (it if isinstance(it, tuple) else (it,))) + ")"
                     for it in items)
    return f"(VALUES {rows}) AS t({col})"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


@register("overview", f"""
SELECT count(*) AS total_count,
       coalesce({AVG('nullif(rating, 0)')}, 0.0) AS avg_rating,
       coalesce({AVG('nullif(price, 0)')}, 0.0) AS avg_price,
       count(DISTINCT area) AS area_count
FROM listing""", ("listing",))
def _overview(t):
    return A.overview(t.listing())


@register("area_distribution", """
SELECT area AS name, count(*) AS count FROM listing
WHERE area IS NOT NULL AND area <> '' GROUP BY area ORDER BY count DESC, name""", ("listing",))
def _area_distribution(t):
    return A.area_distribution(t.listing(), "area")


@register("business_area_counts", """
SELECT business_area AS name, count(*) AS count FROM listing
WHERE business_area IS NOT NULL AND business_area <> '' GROUP BY business_area""", ("listing",))
def _business_area_counts(t):
    return A.business_area_counts(t.listing())


@register("category_distribution", f"""
SELECT category AS name, count(*) AS count,
       {R("count(*) * 100.0 / (SELECT count(*) FROM listing WHERE category IS NOT NULL AND category <> '')")} AS percentage
FROM listing WHERE category IS NOT NULL AND category <> '' GROUP BY category""", ("listing",))
def _category_distribution(t):
    return A.category_distribution(t.listing(), "category")


def _bucket_sql(col: str, buckets, closed: str, close_last: bool, table: str, label_col: str = "label") -> str:
    parts = []
    for i, (label, lo, hi) in enumerate(buckets):
        last = i == len(buckets) - 1
        if closed == "right":
            cond = f"{col} > {lo}" + (f" AND {col} <= {hi}" if hi is not None else "")
        else:
            cond = f"{col} >= {lo}" + ((f" AND {col} <= {hi}" if (last and close_last) else f" AND {col} < {hi}")
                                       if hi is not None else "")
        parts.append(f"SELECT {i + 1} AS bucket, {_lit(label)} AS {label_col}, "
                     f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS count FROM {table}")
    return "\nUNION ALL ".join(parts)


@register("price_distribution", _bucket_sql("price", dims.PRICE_BUCKETS, "right", False, "listing"), ("listing",))
def _price_distribution(t):
    return A.price_distribution(t.listing())


@register("rating_distribution", _bucket_sql("rating", dims.RATING_BUCKETS, "left", True, "listing"), ("listing",))
def _rating_distribution(t):
    return A.rating_distribution(t.listing())


@register("rating_distribution_open", _bucket_sql("rating", dims.RATING_BUCKETS, "left", False, "listing"),
          ("listing",))
def _rating_distribution_open(t):
    """Report variant: last bucket right-open, 5.0 falls in no bucket (Q2)."""
    return A.rating_distribution(t.listing(), right_closed=False)


@register("distance_bands", _bucket_sql("distance_m", A.DISTANCE_BANDS, "right", False, "listing"), ("listing",))
def _distance_bands(t):
    return A.distance_bands(t.listing())


@register("price_tiers", _bucket_sql("price", A.PRICE_TIERS, "right", False, "listing", "tier"), ("listing",))
def _price_tiers(t):
    return A.price_tiers(t.listing())


@register("area_avg_price", f"""
WITH agg AS (
  SELECT area AS name, {AVG('price')} AS avg_price FROM listing
  WHERE area IS NOT NULL AND area <> '' AND price > 0 GROUP BY area),
known AS (SELECT * FROM {VALUES('name', dims.STANDIN_KNOWN_AREAS)})
SELECT coalesce(k.name, a.name) AS name, coalesce(a.avg_price, 0.0) AS avg_price
FROM known k FULL OUTER JOIN agg a ON k.name = a.name""", ("listing",))
def _area_avg_price(t):
    return A.area_avg_price(t.listing(), dims.STANDIN_KNOWN_AREAS)


@register("top_categories", """
SELECT category AS name, count(*) AS count FROM listing
WHERE category IS NOT NULL AND category <> '' GROUP BY category ORDER BY count DESC, name LIMIT 12""",
          ("listing",))
def _top_categories(t):
    return A.top_categories(t.listing(), 12)


@register("top_areas_by_count", """
SELECT area AS name, count(*) AS count FROM listing
WHERE area IS NOT NULL AND area <> '' GROUP BY area ORDER BY count DESC, name LIMIT 5""", ("listing",))
def _top_areas(t):
    return A.top_categories(t.listing(), 5, "area")


@register("source_breakdown", """
SELECT CASE GROUPING(area, category) WHEN 1 THEN 'area' WHEN 2 THEN 'category' ELSE 'total' END AS level,
       CASE GROUPING(area, category) WHEN 1 THEN area WHEN 2 THEN category END AS name,
       count(*) AS count
FROM listing GROUP BY GROUPING SETS ((area), (category), ())""", ("listing",))
def _source_breakdown(t):
    return A.source_breakdown(t.listing())


@register("log_level_counts", """
SELECT lv.level, CAST(count(j.level) AS BIGINT) AS count
FROM (VALUES ('INFO'), ('WARNING'), ('ERROR')) AS lv(level)
LEFT JOIN job_log j ON upper(j.level) = lv.level GROUP BY lv.level""", ("job_log",))
def _log_level_counts(t):
    return A.log_level_counts(t.job_log())
