"""Aggregations over listings, reviews, logs and tasks.

Scale notes
-----------
* Every group-by runs as partial (map-side) + final aggregation, so a hot key
  (one area holding a third of all listings) costs one pre-aggregated row per
  map task, not a third of the data in one task.
* Bucket counts (A4, A5, A17, A18, A10) are one pass: conditional counts in a
  single global aggregate, exploded into rows afterwards; empty buckets are
  emitted without a dimension join.
* Shares against a total use a scalar subquery (``DataFrame.scalar()``), which
  Spark runs once and inlines as a literal; no unpartitioned window.
* Dimension tables joined here are either code-fixed lists (broadcast) or
  aggregated results whose size AQE measures at runtime before choosing a
  broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims
from ..session import written
from ..functions import avg_rounded, round_half_up


def _nonblank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


# ---- A1 ----------------------------------------------------------------------------
def overview(df: DataFrame, rating: str = "rating", price: str = "price", area: str = "area") -> DataFrame:
    """count, average rating and price with 0 as unknown (2 digits, none -> 0), distinct areas.

    Like the reference, the distinct count also counts the blank area (Q3).
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.coalesce(avg_rounded(F.nullif(F.col(rating), F.lit(0))), F.lit(0.0)).alias("avg_rating"),
        F.coalesce(avg_rounded(F.nullif(F.col(price), F.lit(0))), F.lit(0.0)).alias("avg_price"),
        F.countDistinct(area).alias("area_count"))


# ---- A2 / A12 ----------------------------------------------------------------------
def area_distribution(df: DataFrame, col: str = "area") -> DataFrame:
    """Listings per non-blank value, count desc then name."""
    return (df.where(_nonblank(col)).groupBy(F.col(col).alias("name"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("name")))


def business_area_counts(df: DataFrame, col: str = "business_area") -> DataFrame:
    return area_distribution(df, col)


# ---- A3 ----------------------------------------------------------------------------
def category_distribution(df: DataFrame, col: str = "category") -> DataFrame:
    """Count and percentage of all non-blank rows per category (2 digits, half-up)."""
    base = df.where(_nonblank(col))
    total = base.select(F.count(F.lit(1))).scalar()
    return (base.groupBy(F.col(col).alias("name")).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("percentage", round_half_up(F.col("count") * 100.0 / total, 2))
            .orderBy(F.desc("count"), F.asc("name")))


# ---- A4 / A5 / A17 / A18 -----------------------------------------------------------
def bucket_distribution(df: DataFrame, col: str, buckets: Sequence[tuple], closed: str = "right",
                        close_last: bool = False) -> DataFrame:
    """Counts per bucket in one pass, every bucket emitted (Q1, Q2).

    ``buckets`` = ``[(label, lo, hi), ...]`` with ``hi=None`` for open ends.
    ``closed='right'`` gives ``(lo, hi]``; ``closed='left'`` gives ``[lo, hi)``,
    and ``close_last`` closes the last bucket's upper end.
    """
    x = F.col(col)
    structs = []
    for i, (label, lo, hi) in enumerate(buckets):
        last = i == len(buckets) - 1
        if closed == "right":
            cond = x > F.lit(lo)
            if hi is not None:
                cond = cond & (x <= F.lit(hi))
        else:
            cond = x >= F.lit(lo)
            if hi is not None:
                cond = cond & ((x <= F.lit(hi)) if (last and close_last) else (x < F.lit(hi)))
        structs.append(F.struct(F.lit(i + 1).alias("bucket"), F.lit(label).alias("label"),
                                F.count_if(cond).alias("count")))
    return df.agg(F.array(*structs).alias("b")).select(F.inline("b"))


def price_distribution(df: DataFrame, col: str = "price", buckets=dims.PRICE_BUCKETS) -> DataFrame:
    """``(0,50] (50,100] (100,200] (200,inf)``; 0 and NULL land in none."""
    return bucket_distribution(df, col, buckets, closed="right")


def rating_distribution(df: DataFrame, col: str = "rating", buckets=dims.RATING_BUCKETS,
                        right_closed: bool = True) -> DataFrame:
    """``[0,3) [3,4) [4,4.5) [4.5,5]``; unknown 0 lands in the first bucket.

    ``right_closed=False`` reproduces the report variant that loses 5.0.
    """
    return bucket_distribution(df, col, buckets, closed="left", close_last=right_closed)


# Our choice: bands for distance to the subway in metres.
DISTANCE_BANDS = [("<=500m", -1, 500), ("500-1000m", 500, 1000), ("1000-2000m", 1000, 2000), (">2000m", 2000, None)]
# Our choice: price tier bands (economy / mid / upper / luxury).
PRICE_TIERS = [("economy", 0, 50), ("mid", 50, 150), ("upper", 150, 300), ("luxury", 300, None)]


def distance_bands(df: DataFrame, col: str = "distance_m", bands=DISTANCE_BANDS) -> DataFrame:
    return bucket_distribution(df, col, bands, closed="right")


def price_tiers(df: DataFrame, col: str = "price", tiers=PRICE_TIERS) -> DataFrame:
    return (bucket_distribution(df, col, tiers, closed="right").withColumnRenamed("label", "tier"))


def tier_of(x: Column, tiers=PRICE_TIERS) -> Column:
    """Tier label of a value under ``(lo, hi]`` tiers, NULL outside."""
    expr = None
    for label, lo, hi in tiers:
        cond = x > F.lit(lo) if hi is None else (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


# ---- A6 ----------------------------------------------------------------------------
def area_avg_price(df: DataFrame, known_areas: Sequence[str] = dims.KNOWN_DISTRICTS, digits: int = 2,
                   area: str = "area", price: str = "price") -> DataFrame:
    """Average positive price per area over the known list (0.0 when none) plus extra areas.

    Blank areas are always dropped (Q4).  Order: price desc, then name.
    """
    spark = df.sparkSession
    agg = (df.where(_nonblank(area) & (F.col(price) > 0))
           .groupBy(F.col(area).alias("name"))
           .agg(avg_rounded(price, digits).alias("avg_price")))
    known = F.broadcast(dims.words_df(spark, list(dict.fromkeys(known_areas)), "name"))
    return (known.join(agg, "name", "full_outer")
            .select("name", F.coalesce("avg_price", F.lit(0.0)).alias("avg_price"))
            .orderBy(F.desc("avg_price"), F.asc("name")))


# ---- A8 ----------------------------------------------------------------------------
def top_categories(df: DataFrame, n: int = 12, col: str = "category") -> DataFrame:
    """The ``n`` most frequent non-blank categories (top-k: TakeOrderedAndProject)."""
    return area_distribution(df, col).limit(n)


# ---- A9 ----------------------------------------------------------------------------
def source_breakdown(df: DataFrame, source: str | None = None, source_col: str = "source",
                     area: str = "area", category: str = "category") -> DataFrame:
    """After-load counts per area, per category and in total, one grouping-sets pass."""
    if source is not None:
        df = df.where(F.col(source_col) == source)
    g = (df.groupingSets([[area], [category], []], area, category)
         .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("gid")))
    return g.select(
        F.when(F.col("gid") == 1, "area").when(F.col("gid") == 2, "category").otherwise("total").alias("level"),
        F.when(F.col("gid") == 1, F.col(area)).when(F.col("gid") == 2, F.col(category)).alias("name"),
        "count")


# ---- A10 ---------------------------------------------------------------------------
LOG_LEVELS = ("INFO", "WARNING", "ERROR")


def log_level_counts(log: DataFrame, levels: Sequence[str] = LOG_LEVELS, col: str = "level") -> DataFrame:
    """Rows per level, every level emitted (one pass)."""
    structs = [F.struct(F.lit(lv).alias("level"), F.count_if(F.upper(F.col(col)) == lv).alias("count"))
               for lv in levels]
    return log.agg(F.array(*structs).alias("b")).select(F.inline("b"))


# ---- A11 ---------------------------------------------------------------------------
def area_extent(df: DataFrame, area: str = "area") -> DataFrame:
    """Size of each area derived from its listings' coordinates (bounding box, deg^2)."""
    return (df.where(_nonblank(area)).groupBy(F.col(area).alias("area"))
            .agg(((F.max("latitude") - F.min("latitude")) * (F.max("longitude") - F.min("longitude")))
                 .cast("double").alias("size")))


def area_density(df: DataFrame, size_dim: DataFrame, area: str = "area") -> DataFrame:
    """Listings per area divided by the area's size (size table is an input)."""
    counts = df.where(_nonblank(area)).groupBy(F.col(area).alias("area")).agg(F.count(F.lit(1)).alias("count"))
    return (counts.join(size_dim, "area", "left")
            .select("area", "count", round_half_up(F.col("count") / F.nullif(F.col("size"), F.lit(0.0)), 4)
                    .alias("density")))


# ---- A13 ---------------------------------------------------------------------------
def area_category_cross(df: DataFrame, area: str = "area", category: str = "category") -> DataFrame:
    """Area x category counts with subtotals per area, per category and overall (cube)."""
    return (df.cube(F.col(area).alias("area"), F.col(category).alias("category"))
            .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("gid")))


# ---- A14 ---------------------------------------------------------------------------
def area_price_level(df: DataFrame, tiers=PRICE_TIERS, area: str = "area", price: str = "price",
                     approx: bool = False) -> DataFrame:
    """Per area and price tier: count, mean and median price.

    The exact median comes from histogram refinement (``quantiles``), without a value map a group;
    ``approx=True`` uses a fixed-size quantile sketch in one pass.
    """
    priced = df.where(_nonblank(area) & (F.col(price) > 0)).select(
        F.col(area).alias("area"), tier_of(F.col(price), tiers).alias("level"), F.col(price).alias("price"))
    figures = [F.count(F.lit(1)).alias("count"), avg_rounded("price", 2).alias("mean_price")]
    if approx:
        sketch = F.percentile_approx(F.col("price").cast("double"), 0.5, 10000)
        return priced.groupBy("area", "level").agg(*figures, round_half_up(sketch, 2).alias("median_price"))
    from .quantiles import exact_quantiles
    median = exact_quantiles(priced, ["area", "level"], "price", {"median": 0.5})
    return priced.groupBy("area", "level").agg(*figures).join(median, ["area", "level"]).select(
        "area", "level", "count", "mean_price", round_half_up("median", 2).alias("median_price"))


# ---- A15 / A16 ---------------------------------------------------------------------
def _micro(c: str) -> Column:
    """Coordinate in integer micro-degrees (exact for DECIMAL(10,6))."""
    return (F.col(c) * 1000000).cast("long")


def _cell(c: str, step_micro) -> Column:
    return F.floor(_micro(c) / step_micro).cast("long")


def heatmap_cells(df: DataFrame, step: float = 0.05, weight: str | None = "rating") -> DataFrame:
    """Grid cells of ``step`` degrees with listing count and summed weight.

    Cells are computed on integer micro-degrees, so cell edges are exact.
    """
    su = int(round(step * 1_000_000))
    g = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy(
        _cell("latitude", su).alias("lat_idx"), _cell("longitude", su).alias("lng_idx"))
    aggs = [F.count(F.lit(1)).alias("count")]
    if weight:
        aggs.append(round_half_up(F.sum(F.col(weight).cast("double")), 2).alias("weight"))
    return g.agg(*aggs)


# Our choice: cell size per zoom level = base / 2**zoom degrees.
def map_clusters(df: DataFrame, zooms: Sequence[int] = (0, 1, 2, 3), base_step: float = 0.32) -> DataFrame:
    """Cluster markers per zoom level in one pass: each row is placed in one cell per zoom.

    Fan-out is the number of zoom levels (a fixed parameter), then one aggregate.
    """
    levels = F.array(*[F.struct(F.lit(z).alias("zoom"),
                                F.lit(int(round(base_step * 1_000_000 / (2 ** z)))).cast("long").alias("su"))
                       for z in zooms])
    x = (df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
         .select("latitude", "longitude", F.explode(levels).alias("lv")))
    return (x.groupBy(F.col("lv.zoom").alias("zoom"),
                      F.floor(_micro("latitude") / F.col("lv.su")).cast("long").alias("lat_idx"),
                      F.floor(_micro("longitude") / F.col("lv.su")).cast("long").alias("lng_idx"))
            .agg(F.count(F.lit(1)).alias("count"),
                 round_half_up(F.avg(F.col("latitude").cast("double")), 4).alias("lat"),
                 round_half_up(F.avg(F.col("longitude").cast("double")), 4).alias("lng")))


# ---- A19 ---------------------------------------------------------------------------
def category_price_compare(df: DataFrame, category: str = "category", price: str = "price") -> DataFrame:
    """Mean positive price per category and its difference to the overall mean."""
    pos = df.where(_nonblank(category) & (F.col(price) > 0))
    overall = pos.select(F.avg(F.col(price).cast("double"))).scalar()
    return (pos.groupBy(F.col(category).alias("category"))
            .agg(F.avg(F.col(price).cast("double")).alias("_m"), F.count(F.lit(1)).alias("count"))
            .select("category", "count", round_half_up("_m", 2).alias("avg_price"),
                    round_half_up(F.col("_m") - overall, 2).alias("diff_to_overall")))


# ---- A20 ---------------------------------------------------------------------------
def listing_rating_profile(rv: DataFrame, key: str = "listing_id") -> DataFrame:
    """Per listing: mean overall / taste / environment / service rating and review count."""
    return rv.groupBy(key).agg(
        avg_rounded("rating", 2).alias("avg_rating"), avg_rounded("taste", 2).alias("avg_taste"),
        avg_rounded("environment", 2).alias("avg_environment"), avg_rounded("service", 2).alias("avg_service"),
        F.count(F.lit(1)).alias("n_reviews"))


# ---- A21 ---------------------------------------------------------------------------
def listing_detail(df: DataFrame, rv: DataFrame, items: DataFrame, keys: Sequence | None = None,
                   key: str = "listing_id") -> DataFrame:
    """Base row + rating profile + item list, one row per (listing, item), items ranked.

    Items come out as rows ranked by mentions (not one collected array), and the
    rank is computed by a range-partitioned ranking, so a listing with a huge
    item list is spread over many tasks.
    """
    if keys is not None:
        df = df.where(F.col(key).isin(list(keys)))
        rv = rv.where(F.col(key).isin(list(keys)))
        items = items.where(F.col(key).isin(list(keys)))
    prof = listing_rating_profile(rv, key)
    from .windows import ranked_within
    ranked = ranked_within(items.select(key, "item_id", F.col("name").alias("item_name"), "mention_count"),
                           [key], [F.desc("mention_count"), F.asc("item_id")], "item_rank")
    return (df.select(key, "name", "category", "area", "price", "rating")
            .join(prof, key, "left").join(ranked, key, "left"))


# ---- A22 ---------------------------------------------------------------------------
def home_kpis(df: DataFrame, rv: DataFrame, today: str, seen_col: str = "seen_at", ts_col: str = "ts",
              area: str = "business_area") -> DataFrame:
    """One row: totals, covered business areas, listings seen today, reviews today,
    and the category with most reviews today (ties by name).  ``today`` is a literal date."""
    d = F.lit(today).cast("date")
    lst = df.agg(F.count(F.lit(1)).alias("total_listings"),
                 F.countDistinct(F.when(_nonblank(area), F.col(area))).alias("business_areas"),
                 F.count_if(F.to_date(seen_col) == d).alias("new_listings"))
    n_reviews = rv.select(F.count(F.lit(1)).alias("n"))
    today_rv = rv.where(F.to_date(ts_col) == d)
    new_reviews = today_rv.select(F.count(F.lit(1)))
    hot = (today_rv.select("listing_id").join(df.select("listing_id", "category"), "listing_id")
           .groupBy("category").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc("category")).limit(1).select("category"))
    return lst.select("total_listings", n_reviews.scalar().alias("total_reviews"), "business_areas",
                      "new_listings", new_reviews.scalar().alias("new_reviews"),
                      hot.scalar().alias("hottest_category"))


# ---- A23 ---------------------------------------------------------------------------
def crawl_monitor(tasks: DataFrame) -> DataFrame:
    """Per source: runs, share of successful runs (%), items fetched, last run, mean duration (s)."""
    dur = F.unix_timestamp(F.col("end_time").cast("timestamp")) - F.unix_timestamp(F.col("start_time").cast("timestamp"))
    return tasks.groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"),
        round_half_up(F.count_if(F.col("status") == "success") * 100.0 / F.count(F.lit(1)), 2).alias("success_rate"),
        F.sum("total_count").cast("long").alias("items"),
        F.max("start_time").alias("last_run"),
        avg_rounded(dur, 2).alias("avg_duration"))


# ---- A24 ---------------------------------------------------------------------------
def data_quality(df: DataFrame, rules: dict) -> DataFrame:
    """Per column: rows, null / blank / sentinel shares (%), range violations; one pass.

    ``rules`` = ``{column: {"sentinels": [...], "min": x, "max": y}}`` (all optional).
    """
    n = F.count(F.lit(1))
    structs = []
    for c, r in rules.items():
        x = F.col(c)
        is_str = isinstance(df.schema[c].dataType, T.StringType)
        blank = F.count_if(F.trim(x) == "") if is_str else F.lit(0).cast("long")
        sent = F.count_if(x.isin(list(r["sentinels"]))) if r.get("sentinels") else F.lit(0).cast("long")
        viol = F.lit(False)
        if "min" in r:
            viol = viol | (x < F.lit(r["min"]))
        if "max" in r:
            viol = viol | (x > F.lit(r["max"]))
        structs.append(F.struct(
            F.lit(c).alias("column"), n.alias("rows"),
            round_half_up(F.count_if(x.isNull()) * 100.0 / n, 2).alias("null_share"),
            round_half_up(blank * 100.0 / n, 2).alias("blank_share"),
            round_half_up(sent * 100.0 / n, 2).alias("sentinel_share"),
            F.count_if(F.coalesce(viol, F.lit(False))).alias("violations")))
    return df.agg(F.array(*structs).alias("q")).select(F.inline("q"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once: key, copies."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


# ---- A25 ---------------------------------------------------------------------------
def approx_profile(df: DataFrame, rv: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Sketch-based profile for very large tables: distinct users / listings, price quantiles."""
    prices = df.where(F.col("price") > 0).select(
        F.percentile_approx(F.col("price").cast("double"), [0.25, 0.5, 0.75], 10000).alias("q"))
    users = rv.select(F.approx_count_distinct("user_id", rsd).alias("u"))
    return df.agg(F.approx_count_distinct("listing_id", rsd).alias("approx_listings")).select(
        "approx_listings", users.scalar().alias("approx_users"),
        prices.scalar().alias("price_quartiles"))


def monthly_sketches(rv: DataFrame, who: str, value: str, ts: str = "ts", lg_k: int = 12, k: int = 200) -> DataFrame:
    """One mergeable row a month: rows, a distinct-count sketch of ``who`` and a quantile sketch of ``value``.

    The table is written, so later months append to it and any span of months is a merge of
    their rows (``merge_sketches``), never a second scan of the data.
    """
    month = F.date_format(F.col(ts), "yyyy-MM").alias("month")
    return written(rv.groupBy(month).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(who, F.lit(lg_k)).alias("who"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("value")), "sketches")


def merge_sketches(months: DataFrame, by: str | None = None) -> DataFrame:
    """Rows, distinct count and median of all ``months`` (or by a column of theirs) from their sketches."""
    aggs = [F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("who")).alias("who"),
            F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("value"), F.lit(0.5)).alias("median")]
    return months.groupBy(by).agg(*aggs) if by else months.agg(*aggs)


def sketch_profile(rv: DataFrame, who: str, value: str, ts: str = "ts", lg_k: int = 12, k: int = 200,
                   rank_error: float = 0.03) -> DataFrame:
    """Sketches held against exact figures: a row a month and one for all (month ``all``).

    ``who_within``: the estimate is within four relative standard errors (1.04 / sqrt(2^lg_k)).
    ``median_within``: the rank of the sketch's median is within ``rank_error`` of one half.
    """
    months = monthly_sketches(rv, who, value, ts, lg_k, k)
    est = merge_sketches(months, "month").unionByName(merge_sketches(months).withColumn("month", F.lit("all")))
    est = written(est.select("month", F.col("who").alias("_who"), F.col("median").alias("_median")), "estimates")
    v = F.col(value).cast("double")
    spans = F.explode(F.array(F.date_format(F.col(ts), "yyyy-MM"), F.lit("all"))).alias("month")
    rows = rv.select(spans, F.col(who).alias("_id"), v.alias("_v"))
    exact = rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.count("_v").alias("_n"), F.count_distinct("_id").alias("who_exact"))
    # values below and up to the median of the row's span: one counted row a (span, value), joined to one row a span
    ranks = (rows.where("_v is not null").groupBy("month", "_v").agg(F.count(F.lit(1)).alias("_c")).join(est, "month")
             .groupBy("month").agg(F.sum(F.when(F.col("_v") < F.col("_median"), F.col("_c")).otherwise(0)).alias("_below"),
                                   F.sum(F.when(F.col("_v") <= F.col("_median"), F.col("_c")).otherwise(0)).alias("_upto")))
    bound = 4 * 1.04 / (2 ** (lg_k / 2))
    return exact.join(est, "month").join(ranks, "month", "left").select(
        "month", "n", "who_exact", (F.abs(F.col("_who") - F.col("who_exact")) <= F.ceil(F.col("who_exact") * bound)).alias("who_within"),
        ((F.col("_below") <= (0.5 + rank_error) * F.col("_n")) & (F.col("_upto") >= (0.5 - rank_error) * F.col("_n"))).alias("median_within"))
