"""Filters, search and paging.

Paging is ``orderBy(...).offset(o).limit(n)``, which Spark plans as a
``TakeOrderedAndProject`` (each task keeps its best ``o + n`` rows, then one
merge), so a page never sorts the full table.  Every sort ends with the key as
tie-break so pages never overlap (Q13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Our choice, from the search form presets: price bands (min, max) by name.
PRICE_PRESETS = {"<50": (None, 50), "50-100": (50, 100), "100-200": (100, 200), ">200": (200, None)}

# mode -> (column, descending); columns are built when a query is, not at import.
SORT_MODES = {
    "default": [("rating", True)],
    "rating": [("rating", True)],
    "price": [("price", False)],
    "price_desc": [("price", True)],
    "reviews": [("review_count", True)],
}


def search_filter(df: DataFrame, keyword: str | None = None,
                  keyword_cols: Sequence[str] = ("name", "category", "area"),
                  area: str | None = None, category: str | None = None,
                  price_min=None, price_max=None, rating_min=None, preset: str | None = None,
                  area_col: str = "area", category_col: str = "category",
                  price_col: str = "price", rating_col: str = "rating") -> DataFrame:
    """Optional predicates, all pushed into one filter (parquet pushdown where possible).

    keyword: case-insensitive contains over ``keyword_cols`` (Q14; pass
    ``("name",)`` for name-only); area: contains; category: equals.
    """
    conds: list[Column] = []
    if keyword:
        kw = keyword.lower()
        any_hit = None
        for c in keyword_cols:
            hit = F.lower(F.col(c)).contains(kw)
            any_hit = hit if any_hit is None else (any_hit | hit)
        conds.append(any_hit)
    if area:
        conds.append(F.col(area_col).contains(area))
    if category:
        conds.append(F.col(category_col) == category)
    if preset:
        pmin, pmax = PRICE_PRESETS[preset]
        price_min = price_min if price_min is not None else pmin
        price_max = price_max if price_max is not None else pmax
    if price_min is not None:
        conds.append(F.col(price_col) >= F.lit(price_min))
    if price_max is not None:
        conds.append(F.col(price_col) <= F.lit(price_max))
    if rating_min is not None:
        conds.append(F.col(rating_col) >= F.lit(rating_min))
    for c in conds:
        df = df.where(c)
    return df


def page(df: DataFrame, order: Sequence[Column | str], page_no: int = 1, size: int = 20,
         max_size: int = 200) -> DataFrame:
    """Rows ``(page-1)*size .. page*size`` of the ordering."""
    if page_no < 1 or size < 1 or size > max_size:
        raise ValueError("page >= 1 and 1 <= size <= max_size")
    return df.orderBy(*order).offset((page_no - 1) * size).limit(size)


def sort_modes(mode: str = "default", key: str = "listing_id") -> list[Column]:
    """Sort columns of a mode with the key appended as tie-break."""
    return [F.desc(c) if d else F.asc(c) for c, d in SORT_MODES[mode]] + [F.asc(key)]


def search_listings(df: DataFrame, keyword=None, area=None, category=None, price_min=None, price_max=None,
                    rating_min=None, sort_by: str = "default", page_no: int = 1, page_size: int = 20,
                    key: str = "listing_id", keyword_cols=("name", "category", "area"), preset=None) -> DataFrame:
    """filtered, sorted page of listings.  ``search_total`` gives the match count."""
    f = search_filter(df, keyword, keyword_cols, area, category, price_min, price_max, rating_min, preset)
    return page(f, sort_modes(sort_by, key), page_no, page_size, max_size=100)


def search_total(df: DataFrame, **filters) -> DataFrame:
    return search_filter(df, **filters).select(F.count(F.lit(1)).alias("total"))


def total(df: DataFrame) -> DataFrame:
    """One row: the number of rows behind a page."""
    return df.select(F.count(F.lit(1)).alias("total"))


# ---- F2 ----------------------------------------------------------------------------
def filter_polarity(rv: DataFrame, positive: bool = True, limit: int | None = None, text: str = "text",
                    sentiment: str = "sentiment", rating: str = "rating", order: Sequence[str] = ("ts",),
                    key: str = "review_id") -> DataFrame:
    """Non-blank reviews with sentiment > 0 and rating >= 4 (or < 0 and <= 2.5), all of them.

    ``limit`` keeps the newest N, for a caller that asks for a page.
    """
    base = rv.where(F.col(text).isNotNull() & (F.col(text) != ""))
    if positive:
        base = base.where((F.col(sentiment) > 0) & (F.col(rating) >= 4))
    else:
        base = base.where((F.col(sentiment) < 0) & (F.col(rating) <= 2.5))
    if limit is None:
        return base
    return base.orderBy(*[F.desc(o) for o in order], F.desc(key)).limit(limit)


# ---- F3 ----------------------------------------------------------------------------
def filter_training_rows(df: DataFrame, price: str = "price", rating: str = "rating",
                         category: str = "category", area: str = "area") -> DataFrame:
    """Rows usable for the rating model: positive price and rating, non-blank category and area."""
    return df.where((F.col(price) > 0) & (F.col(rating) > 0)
                    & F.col(category).isNotNull() & (F.col(category) != "")
                    & F.col(area).isNotNull() & (F.col(area) != ""))


# ---- F4 ----------------------------------------------------------------------------
def filter_logs(log: DataFrame, task: str | None = None, level: str | None = None,
                time_col: str = "create_time") -> DataFrame:
    """By task and upper-cased level, newest first (id as tie-break)."""
    if task:
        log = log.where(F.col("task_name") == task)
    if level:
        log = log.where(F.col("level") == level.upper())
    return log.orderBy(F.desc(time_col), F.desc("id"))


# ---- F5 ----------------------------------------------------------------------------
def exclude_tags(df: DataFrame, col: str, tags: Sequence[str]) -> DataFrame:
    """``col NOT IN (tags)`` with SQL semantics: NULL tags are dropped too (Q12)."""
    return df.where(~F.col(col).isin(list(tags)))


# ---- F6 ----------------------------------------------------------------------------
def get_by_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


# ---- W3 ----------------------------------------------------------------------------
def distinct_latest_tasks(log: DataFrame, n: int = 50, col: str = "task_name") -> DataFrame:
    """Distinct task names, descending, first ``n`` (the reference's task picker)."""
    return log.select(col).distinct().orderBy(F.desc(col)).limit(n)
