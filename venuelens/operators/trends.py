"""Trends over time.

Series are grouped aggregates per (group, period); windows (lag, moving
average, rank) then run over the aggregated series, partitioned by group, so
their partitions hold one row per period, not raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round_half_up


def period(col: str, unit: str = "month"):
    """Start of the period as a date (``month`` / ``quarter`` / ``year``)."""
    return F.to_date(F.date_trunc(unit, F.col(col)))


# ---- X1 ----------------------------------------------------------------------------
def category_trend(df: DataFrame, rv: DataFrame, unit: str = "month", key: str = "listing_id") -> DataFrame:
    """Reviews per category per period with the change against the previous period."""
    s = (rv.select(key, "ts").join(df.select(key, "category"), key)
         .groupBy("category", period("ts", unit).alias("period")).agg(F.count(F.lit(1)).alias("reviews")))
    w = Window.partitionBy("category").orderBy("period")
    return s.withColumn("change", F.col("reviews") - F.lag("reviews").over(w))


def category_listing_trend(df: DataFrame, unit: str = "month", seen: str = "seen_at") -> DataFrame:
    """Listings first seen per category per period with the change against the previous period."""
    s = df.where(F.col(seen).isNotNull()).groupBy("category", period(seen, unit).alias("period")).agg(
        F.count(F.lit(1)).alias("listings"))
    w = Window.partitionBy("category").orderBy("period")
    return s.withColumn("change", F.col("listings") - F.lag("listings").over(w))


# ---- X2 ----------------------------------------------------------------------------
def new_listing_trend(df: DataFrame, unit: str = "month", seen: str = "seen_at") -> DataFrame:
    """Listings by the period they were first seen, per area."""
    return (df.where(F.col(seen).isNotNull()).groupBy(period(seen, unit).alias("period"), "area")
            .agg(F.count(F.lit(1)).alias("new_listings")))


# ---- X3 ----------------------------------------------------------------------------
def price_trend(df: DataFrame, rv: DataFrame, key: str = "listing_id") -> DataFrame:
    """Mean price of reviewed listings per month and per quarter (one grouping-sets pass)."""
    j = (rv.select(key, "ts").join(df.where(F.col("price") > 0).select(key, "price"), key)
         .select(period("ts", "month").alias("month"), period("ts", "quarter").alias("quarter"),
                 F.col("price").cast("double").alias("p")))
    g = j.groupingSets([["month"], ["quarter"]], "month", "quarter").agg(
        round_half_up(F.avg("p"), 2).alias("avg_price"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))
    return g.select(F.when(F.col("gid") == 1, "month").otherwise("quarter").alias("level"),
                    F.coalesce("month", "quarter").alias("period"), "avg_price", "n")


# ---- X4 ----------------------------------------------------------------------------
def business_area_trend(df: DataFrame, rv: DataFrame, unit: str = "year", key: str = "listing_id") -> DataFrame:
    """Rank of each business area by reviews per period and its change against the previous period."""
    s = (rv.select(key, "ts").join(df.select(key, "business_area"), key)
         .groupBy("business_area", period("ts", unit).alias("period")).agg(F.count(F.lit(1)).alias("reviews")))
    s = s.withColumn("rank", F.rank().over(Window.partitionBy("period").orderBy(F.desc("reviews"))).cast("long"))
    w = Window.partitionBy("business_area").orderBy("period")
    return s.withColumn("rank_change", F.lag("rank").over(w) - F.col("rank"))


# ---- X5 ----------------------------------------------------------------------------
def seasonal_index(rv: DataFrame, ts: str = "ts") -> DataFrame:
    """Per calendar month: mean monthly review count / mean of all monthly counts."""
    monthly = rv.groupBy(period(ts, "month").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    overall = monthly.select(F.avg("n")).scalar()
    return (monthly.groupBy(F.month("period").cast("long").alias("month")).agg(F.avg("n").alias("_m"))
            .select("month", round_half_up("_m", 2).alias("mean_count"),
                    round_half_up(F.col("_m") / overall, 4).alias("seasonal_index")))


# ---- X6 ----------------------------------------------------------------------------
def month_index(col: str):
    return F.year(col) * 12 + F.month(col) - 1


def forecast_linear(series: DataFrame, group: str, value: str, horizon: int = 3) -> DataFrame:
    """Least-squares line per group over the month index; the next ``horizon`` months.

    Output: group, period, forecast, slope, intercept.
    """
    s = series.select(group, month_index("period").alias("t"), F.col(value).cast("double").alias("y"))
    fit = s.groupBy(group).agg(F.regr_slope("y", "t").alias("slope"), F.regr_intercept("y", "t").alias("intercept"),
                               F.max("t").alias("t_last"))
    fut = fit.withColumn("t", F.explode(F.sequence(F.col("t_last") + 1, F.col("t_last") + horizon)))
    return fut.select(group, F.make_date((F.col("t") / 12).cast("int"), (F.col("t") % 12 + 1).cast("int"),
                                         F.lit(1)).alias("period"),
                      round_half_up(F.col("intercept") + F.col("slope") * F.col("t"), 2).alias("forecast"),
                      round_half_up("slope", 6).alias("slope"), round_half_up("intercept", 4).alias("intercept"))


# ---- X7 ----------------------------------------------------------------------------
def moving_average(series: DataFrame, group: str, value: str, n: int = 3) -> DataFrame:
    """Mean of the current and ``n - 1`` previous periods per group."""
    w = Window.partitionBy(group).orderBy("period").rowsBetween(-(n - 1), 0)
    return series.withColumn("moving_avg", round_half_up(F.avg(F.col(value).cast("double")).over(w), 4))
