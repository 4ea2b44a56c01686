"""Set operations (U1-U4, K10 symmetric difference helpers)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_cloud(pos: DataFrame, neg: DataFrame, labels=("positive", "negative")) -> DataFrame:
    """Positive and negative keywords stacked with a polarity label."""
    return (pos.withColumn("polarity", F.lit(labels[0]))
            .unionByName(neg.withColumn("polarity", F.lit(labels[1]))))


def merge_sources(*dfs: DataFrame, source_col: str | None = "source_no") -> DataFrame:
    """Align several crawl schemas to their union (by name) and stack them."""
    out = None
    for i, d in enumerate(dfs):
        if source_col:
            d = d.withColumn(source_col, F.lit(i + 1))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def known_plus_extra(df: DataFrame, known: Sequence[str], col: str = "area") -> DataFrame:
    """The known values, plus values that occur only in the data; ``known`` flag."""
    spark = df.sparkSession
    k = F.broadcast(spark.createDataFrame([(v,) for v in dict.fromkeys(known)], f"{col} string"))
    seen = df.where(F.col(col).isNotNull() & (F.col(col) != "")).select(col).distinct()
    return (k.withColumn("known", F.lit(True))
            .unionByName(seen.join(k, col, "left_anti").withColumn("known", F.lit(False))))


def sync_diff(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """U4: per key, inserted / updated / unchanged / removed between two loads.

    Rows compare by a 64-bit hash of their non-key columns (one full outer join).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in new.columns if c not in keys]

    def h(d):
        return d.select(*keys, F.xxhash64(*[F.col(c) for c in cols]).alias("h"), F.lit(True).alias("present"))
    o, n = h(old).withColumnsRenamed({"h": "ho", "present": "po"}), h(new).withColumnsRenamed({"h": "hn", "present": "pn"})
    j = o.join(n, keys, "full_outer")
    status = (F.when(F.col("po").isNull(), "inserted").when(F.col("pn").isNull(), "removed")
              .when(F.col("ho") == F.col("hn"), "unchanged").otherwise("updated"))
    return j.select(*keys, status.alias("status"))


def sync_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
