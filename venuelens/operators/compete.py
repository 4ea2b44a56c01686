"""Competition analysis.

Peers are those that ``joins.find_competitors`` pairs; their counts and means come from prefix sums
(``bands.band_totals``), so no analysis makes pairs of listings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import round_half_up
from ..session import written
from .aggregates import listing_rating_profile
from .bands import band_totals
from .windows import market_share

METRICS = ("price", "rating", "sales", "review_count")


# ---- P1 ----------------------------------------------------------------------------
def compare_listings(df: DataFrame, ids: Sequence, metrics: Sequence[str] = METRICS,
                     key: str = "listing_id") -> DataFrame:
    """Metric-by-listing table: one row per metric, one column per requested listing."""
    sel = df.where(F.col(key).isin(list(ids))).select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = sel.unpivot([key], list(metrics), "metric", "value")
    return long.groupBy("metric").pivot(key, list(ids)).agg(F.first("value"))


# ---- P2 ----------------------------------------------------------------------------
DIMENSIONS = ("avg_taste", "avg_environment", "avg_service", "avg_rating")


def strengths_weaknesses(rv: DataFrame, df: DataFrame, band: float = 0.2, margin: float = 0.2,
                         targets: DataFrame | None = None) -> DataFrame:
    """Each sub-rating against the mean of the listing's peers: strength / weakness / par.

    Peers: competitors within the price band that have reviews. Sums are of whole hundredths, so exact.
    ``margin`` (our choice) is the difference that counts as a strength or weakness.
    """
    prof = listing_rating_profile(rv).select("listing_id", *[F.round(F.col(d) * 100).cast("long").alias(d) for d in DIMENSIONS])
    if targets is None:
        prof = written(prof, "profile")          # read for the totals and for the listings' own values
    priced = df.select("listing_id", "business_area", "category", "price").join(prof, "listing_id", "left")
    peers = band_totals(priced, band, DIMENSIONS, targets=targets)
    of = [F.struct(F.lit(d).alias("dimension"), F.col(f"own.{d}").alias("own"), F.col(f"peers.{d}").alias("total"),
                   F.col(f"peers.n_{d}").alias("peers")) for d in DIMENSIONS]
    j = prof.alias("own").join(peers.alias("peers"), "listing_id").select("listing_id", F.explode(F.array(*of)).alias("d")).select("listing_id", "d.*")
    j = j.where((F.col("peers") > 0) & F.col("own").isNotNull()).withColumns({
        "own": F.col("own") / 100.0, "peer_mean": F.col("total").cast("double") / (F.col("peers") * 100)})
    diff = round_half_up(F.col("own") - F.col("peer_mean"), 4)
    return j.select("listing_id", "dimension", "own", round_half_up("peer_mean", 4).alias("peer_mean"), "peers",
                    diff.alias("diff"),
                    F.when(diff > margin, "strength").when(diff < -margin, "weakness").otherwise("par").alias("flag"))


# ---- P3 ----------------------------------------------------------------------------
def swot(df: DataFrame, band: float = 0.2, sentiment: DataFrame | None = None, targets: DataFrame | None = None,
         praised: float = 0.8, criticised: float = 0.2, key: str = "listing_id") -> DataFrame:
    """Rule flags (our rules) from rating, review sentiment, popularity, price and competition:
    four arrays strengths / weaknesses / opportunities / threats.

    ``sentiment``: reviews as (key, sentiment) with 1 positive, -1 negative, 0 neutral, null unknown; the flags
    ask for a share of at least ``praised`` positive or ``criticised`` negative among the known ones.
    ``targets`` (key) restricts the listings that are answered.
    """
    area_stats = df.groupBy("area").agg(F.avg("review_count").alias("area_avg_reviews"),
                                        F.count(F.lit(1)).alias("area_n"))
    mean_area_n = area_stats.select(F.avg("area_n")).scalar()
    cat_price = df.where(F.col("price") > 0).groupBy("category").agg(
        F.avg(F.col("price").cast("double")).alias("cat_avg_price"))
    comp = band_totals(df, band, key=key, targets=targets).withColumnRenamed("n", "n_comp")
    asked = df if targets is None else df.join(targets.select(key).distinct(), key, "left_semi")
    if sentiment is None:
        voiced = asked.select(key).limit(0).selectExpr(key, "0L AS n_known", "0L AS n_good", "0L AS n_bad")
    else:
        known = sentiment.where(F.col("sentiment").isNotNull())
        if targets is not None:
            known = known.join(targets.select(key).distinct(), key, "left_semi")
        voiced = known.groupBy(key).agg(F.count(F.lit(1)).alias("n_known"), F.count_if(F.col("sentiment") > 0).alias("n_good"),
                                        F.count_if(F.col("sentiment") < 0).alias("n_bad"))
    j = (asked.select(key, "area", "category", "price", "rating", "review_count")
         .join(area_stats, "area", "left").join(cat_price, "category", "left").join(comp, key, "left")
         .join(voiced, key, "left").fillna(0, ["n_comp", "n_cheaper"])
         .withColumn("_under", F.col("area_n") < mean_area_n))  # scalar outside the array filters

    def flags(*pairs):
        return F.filter(F.array(*[F.when(c, F.lit(label)) for c, label in pairs]), lambda x: x.isNotNull())
    price = F.col("price").cast("double")
    return j.select(
        key,
        flags((F.col("rating") >= 4.0, "high_rating"),
              (F.col("review_count") >= F.col("area_avg_reviews"), "popular"),
              (F.col("n_good") >= F.col("n_known") * praised, "praised_in_reviews")).alias("strengths"),
        flags(((F.col("rating") > 0) & (F.col("rating") < 3.0), "low_rating"),
              (price > F.col("cat_avg_price") * 1.2, "expensive"),
              (F.col("n_bad") >= F.col("n_known") * criticised, "criticised_in_reviews")).alias("weaknesses"),
        flags((F.col("n_comp") == 0, "no_direct_competitor"),
              (F.col("_under"), "underserved_area")).alias("opportunities"),
        flags((F.col("n_comp") >= 3, "crowded_segment"),
              (F.col("n_cheaper") > 0, "cheaper_competitors")).alias("threats"))


# ---- P4 ----------------------------------------------------------------------------
def competition_landscape(df: DataFrame, area: str = "area", chain: str = "name") -> DataFrame:
    """Per area: listings, concentration index (sum of squared chain shares, 0-1),
    leading chain (most listings, ties by name), positive price spread."""
    sh = market_share(df, area, chain)
    conc = sh.groupBy("area").agg(
        F.sum("n").alias("n"),
        round_half_up(F.sum((F.col("share") / 100) ** 2), 4).alias("hhi"),
        F.min_by("chain", F.struct(-F.col("n"), F.col("chain"))).alias("leader"))
    spread = (df.where(F.col("price") > 0).groupBy(F.col(area).alias("area"))
              .agg(round_half_up(F.max("price").cast("double") - F.min("price").cast("double"), 2)
                   .alias("price_spread")))
    return conc.join(spread, "area", "left")
