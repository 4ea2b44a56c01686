"""Ranking and window operators (W4-W8, W10) and market share.

Ranks are top-k by design: ``rank <= k`` over a partitioned window lets Spark
insert a per-partition group limit before the shuffle (WindowGroupLimit), so a
hot group contributes at most k rows per map task; global top-k uses
``orderBy().limit()`` (TakeOrderedAndProject).  Group statistics (mean, std,
quartiles, totals) come from a grouped aggregate joined back, not from a
window over the raw rows, so a group holding a third of the data is reduced
map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round_half_up


# ---- W4 ----------------------------------------------------------------------------
def top_bottom(agg: DataFrame, value: str, name: str = "name", n: int = 3, sides=("top", "bottom")) -> DataFrame:
    """Highest and lowest ``n`` rows of an aggregated result: side, name, value, rank.

    Each side is a top-k (TakeOrderedAndProject); the rank window runs on the
    k rows that survive.
    """
    parts = []
    for side in sides:
        order = [F.desc(value), F.asc(name)] if side == "top" else [F.asc(value), F.asc(name)]
        k = agg.orderBy(*order).limit(n)
        parts.append(k.select(F.lit(side).alias("side"), F.col(name).alias("name"),
                              F.col(value).cast("double").alias("value"),
                              F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- W5 ----------------------------------------------------------------------------
def value_for_money(df: DataFrame, rating: str = "rating", price: str = "price") -> Column:
    """(rating / 5) / (price / 100), for known rating and price."""
    return F.when((F.col(price) > 0) & (F.col(rating) > 0),
                  (F.col(rating).cast("double") / 5) / (F.col(price).cast("double") / 100))


def value_for_money_rank(df: DataFrame, k: int = 10, by: str | None = "category",
                         key: str = "listing_id") -> DataFrame:
    """Top ``k`` listings by value-for-money index, per group (dense rank) or overall."""
    x = df.select(key, *([by] if by else []), round_half_up(value_for_money(df), 4).alias("vfm_index")) \
          .where(F.col("vfm_index").isNotNull())
    if by is None:
        # ties at the last rank stay: keep what reaches the k-th distinct value, then rank the few that do
        least = x.select("vfm_index").distinct().orderBy(F.desc("vfm_index")).limit(k).agg(F.min("vfm_index")).scalar()
        top = x.where(F.col("vfm_index") >= least)
        return top.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc("vfm_index"))).cast("long"))
    w = Window.partitionBy(by).orderBy(F.desc("vfm_index"))
    return x.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= k) \
            .withColumn("rank", F.col("rank").cast("long"))


# ---- W6 ----------------------------------------------------------------------------
def hot_rank(df: DataFrame, weights=(0.5, 0.3, 0.2), k: int = 20, key: str = "listing_id",
             cols=("rating", "review_count", "sales")) -> DataFrame:
    """Min-max normalised weighted sum of rating, review count, sales; top ``k`` with rank.

    Weights are our choice (the reference names the inputs only).  Min and max
    come from one scalar aggregate.
    """
    stats = df.select(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                                 F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in cols])
    score = None
    for c, wgt in zip(cols, weights):
        st = stats.select(F.col(f"{c}.lo")).scalar(), stats.select(F.col(f"{c}.hi")).scalar()
        norm = (F.col(c).cast("double") - st[0]) / F.nullif(st[1] - st[0], F.lit(0.0))
        term = F.coalesce(norm, F.lit(0.0)) * wgt
        score = term if score is None else score + term
    s = df.select(key, *cols, round_half_up(score, 6).alias("hot_score"))
    # ties at the last rank stay
    least = s.select("hot_score").orderBy(F.desc("hot_score")).limit(k).agg(F.min("hot_score")).scalar()
    top = s.where(F.col("hot_score") >= least)
    return top.withColumn("rank", F.rank().over(Window.orderBy(F.desc("hot_score"))).cast("long"))


# ---- W7 ----------------------------------------------------------------------------
def market_share(df: DataFrame, area: str = "area", chain: str = "name") -> DataFrame:
    """Share (%) of each chain's listings within an area; area totals joined back."""
    per = df.groupBy(F.col(area).alias("area"), F.col(chain).alias("chain")).agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy(F.col(area).alias("area")).agg(F.count(F.lit(1)).alias("area_n"))
    return (per.join(tot, "area").select("area", "chain", "n",
                                        round_half_up(F.col("n") * 100.0 / F.col("area_n"), 2).alias("share")))


# ---- W8 ----------------------------------------------------------------------------
def price_anomaly(df: DataFrame, method: str = "zscore", k: float = 2.0, by: str = "category",
                  price: str = "price", key: str = "listing_id") -> DataFrame:
    """Listings whose price is unusual within their group, flagged high or low (others are left out).

    zscore: |price - mean| / stddev_samp > k.  iqr: outside [q1 - k*iqr, q3 + k*iqr]
    (exact quartiles by histogram refinement, without a value map a group).
    """
    pos = df.where(F.col(price) > 0).select(key, by, F.col(price).cast("double").alias("p"))
    if method == "zscore":
        st = pos.groupBy(by).agg(F.avg("p").alias("mu"), F.stddev_samp("p").alias("sd"))
        z = (F.col("p") - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0))
        return (pos.join(st, by).select(key, by, F.col("p").alias("price"), round_half_up(z, 4).alias("score"))
                .withColumn("flag", F.when(F.col("score") > k, "high").when(F.col("score") < -k, "low"))
                .where("flag IS NOT NULL"))
    if method == "iqr":
        from .quantiles import exact_quantiles
        st = exact_quantiles(pos, [by], "p", {"q1": 0.25, "q3": 0.75})
        iqr = F.col("q3") - F.col("q1")
        return (pos.join(st, by).select(key, by, F.col("p").alias("price"),
                                        round_half_up(F.col("q1") - iqr * k, 4).alias("low_fence"),
                                        round_half_up(F.col("q3") + iqr * k, 4).alias("high_fence"))
                .withColumn("flag", F.when(F.col("price") > F.col("high_fence"), "high")
                            .when(F.col("price") < F.col("low_fence"), "low")).where("flag IS NOT NULL"))
    raise ValueError(method)


# ---- W10 ---------------------------------------------------------------------------
def max_scale(df: DataFrame, col: str, name: str = "name") -> DataFrame:
    """Each value divided by the maximum (for colour scaling), maximum from a scalar subquery."""
    mx = df.select(F.max(F.col(col).cast("double"))).scalar()
    return df.select(name, F.col(col).cast("double").alias("value"),
                     round_half_up(F.col(col).cast("double") / F.nullif(mx, F.lit(0.0)), 4).alias("scaled"))


# ---- X7-style helper ---------------------------------------------------------------
def rows_frame(partition: Sequence[str], order: Sequence[str], lo: int, hi: int = 0):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(lo, hi)


# ---- exact full ranking for skewed groups ---------------------------------------------
def ranked_within(df: DataFrame, group: Sequence[str], order: Sequence, out: str = "rank",
                  num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` over (partition by ``group`` order by ``order``) without putting a
    whole group in one task.

    Rows are range-partitioned on (group, order) - a group holding a third of
    the rows is cut into many ranges - and numbered inside each partition.  The
    count of each group's rows in every partition (a small table: partitions x
    groups present) gives the offset of the partition's first row within its
    group; offset + local number is the exact rank.  ``order`` holds Columns
    (e.g. ``F.desc("x")``) and must be a total order within the group.

    The range bounds come from sampling, so the partitioned rows are written
    once with a reliable ``checkpoint()`` (the session's checkpoint folder):
    both uses then see the same partition ids, and lineage is cut.
    """
    from ..session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = [F.col(c) for c in group]
    o = [F.col(c) if isinstance(c, str) else c for c in order]
    parted = df.repartitionByRange(n, *g, *o).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    local = parted.withColumn("_local", F.row_number().over(Window.partitionBy("_pid", *group).orderBy(*o)))
    counts = parted.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.partitionBy(*group).orderBy("_pid")
                                .rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["_off"])
    return (local.join(offsets.select("_pid", *group, "_off"), ["_pid", *group])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long")).drop("_pid", "_local", "_off"))
