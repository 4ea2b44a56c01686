"""Totals over the rows of a price band around each row, without pairs (J8 as an aggregate; used by P2, P3).

A band is the difference of two prefix sums over rows sorted by (segment, price). Points and the
bounds that ask for them are sorted together by range partition, so a crowded segment is cut into
many partitions; sums run inside a partition and each partition adds the total of those before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Prices and bands are compared as whole ten-thousandths, so that bounds are exact.
UNIT = 10_000


def price_units(price: Column) -> Column:
    return F.round(price.cast("decimal(30,6)") * UNIT).cast("long")


def running_totals(df: DataFrame, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """``df`` with ``upto_<value>``: the sum of a long column over all rows up to this one in ``order``.

    Rows are range-partitioned once and written (partition bounds are sampled, both uses must see the same);
    what crosses partitions is one row of totals a partition.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = written(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), "running")
    totals = parted.groupBy("_pid").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = totals.select("_pid", *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_{v}") for v in values])
    here = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parted.select("*", *[F.sum(v).over(here).alias(f"upto_{v}") for v in values]).join(F.broadcast(before), "_pid")
    return out.withColumns({f"upto_{v}": F.col(f"upto_{v}") + F.col(f"_{v}") for v in values}).drop("_pid", *[f"_{v}" for v in values])


def band_totals(df: DataFrame, band: float = 0.2, values: Sequence[str] = (), key: str = "listing_id", price: str = "price",
                group: Sequence[str] = ("business_area", "category"), targets: DataFrame | None = None) -> DataFrame:
    """Per row with a price: its competitors as :func:`joins.find_competitors` pairs them, added up.

    ``key``, n (competitors), n_cheaper, and for each long column of ``values`` its sum and n_<value>, the
    number that are not null. Rows without a price or segment are left out. ``targets`` (key) restricts who asks;
    then only their segments are read on.
    """
    if not 0 < band < 1:
        raise ValueError("band must be in (0, 1)")
    share = round(band * UNIT)
    g = list(group)
    base = df.where(F.col(price) > 0).dropna(subset=g)
    counts = {f"n_{v}": F.col(v).isNotNull().cast("long") for v in values}
    base = base.select(key, *g, price_units(F.col(price)).alias("x"), F.lit(1).cast("long").alias("n"), *[c.alias(k) for k, c in counts.items()],
                       *[F.coalesce(F.col(v), F.lit(0)).cast("long").alias(v) for v in values])
    sums = ["n", *counts, *values]
    asking = base
    if targets is not None:
        asking = base.join(targets.select(key).distinct(), key, "left_semi")
        base = base.join(asking.select(*g).distinct(), g, "left_semi")
    points = base.select(*g, "x", F.lit(1).alias("turn"), *sums, F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(None).cast("string").alias("bound"), *[F.lit(0).cast("long").alias(f"own_{s}") for s in sums])
    # a lower bound comes before its equals, an upper bound after them
    low, high = F.expr(f"(x * {UNIT - share} + {UNIT - 1}) DIV {UNIT}"), F.expr(f"(x * {UNIT + share}) DIV {UNIT}")
    asked = F.explode(F.array(F.struct(low.alias("x"), F.lit(0).alias("turn"), F.lit("low").alias("bound")),
                              F.struct(F.col("x"), F.lit(0).alias("turn"), F.lit("own").alias("bound")),
                              F.struct(high.alias("x"), F.lit(2).alias("turn"), F.lit("high").alias("bound")))).alias("ask")
    bounds = asking.select(*g, key, asked, *[F.col(s).alias(f"own_{s}") for s in sums]).select(
        *g, "ask.x", "ask.turn", *[F.lit(0).cast("long").alias(s) for s in sums], key, "ask.bound", *[f"own_{s}" for s in sums])
    ran = running_totals(points.unionAll(bounds), [*[F.col(c) for c in g], F.col("x"), F.col("turn")], sums).where(F.col("bound").isNotNull())

    def at(bound: str, s: str) -> Column:
        return F.sum(F.when(F.col("bound") == bound, F.col(f"upto_{s}")))
    # every listing asks three times; it is itself inside its band
    return ran.groupBy(key).agg(
        *[(at("high", s) - at("low", s) - F.max(f"own_{s}")).alias(s) for s in sums], (at("own", "n") - at("low", "n")).alias("n_cheaper"))
