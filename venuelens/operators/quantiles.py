"""Exact quantiles per group by histogram refinement.

The value of a rank is narrowed down in passes: each pass counts the values of the interval that
holds the rank in BINS bins, and the bin with the rank is the next interval. A group's state is one
interval a rank and its buffers are at most BINS counts, whatever the number of rows or of distinct
values; counting has a map-side partial step, so a group with a third of all rows is no large group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .bands import UNIT, price_units

BINS = 4096


def exact_quantiles(df: DataFrame, group: Sequence[str], col: str, qs: dict[str, float], bins: int = BINS) -> DataFrame:
    """``group`` columns and, for each name of ``qs``, that quantile of ``col`` (linear between ranks), as double.

    Values are taken as whole ten-thousandths (prices: exact). Null values and rows with a null group are left out.
    """
    g = list(group)
    rows = df.dropna(subset=[*g, col]).select(*g, price_units(F.col(col)).alias("x"))
    per = rows.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("top"))
    at = {q: F.lit(float(q)) * (F.col("n") - 1) for q in dict.fromkeys(qs.values())}
    ranks = [F.struct(F.lit(float(q)).alias("q"), side, place.cast("long").alias("r"))
             for q, p in at.items() for side, place in ((F.lit("low").alias("side"), F.floor(p)), (F.lit("high").alias("side"), F.ceil(p)))]
    state = per.select(*g, "n", "low", (F.col("top") - F.col("low") + 1).alias("width"), F.explode(F.array(*ranks)).alias("a")).select(
        *g, "n", "low", "width", "a.q", "a.side", "a.r")
    state = written(state, "quantiles")
    widest = state.agg(F.max("width")).first()[0] or 1
    for _ in range(max(1, math.ceil(math.log(widest, bins) - 1e-9))):
        open_ = state.select(*g, "low", "width").distinct().withColumn("step", F.expr(f"(width + {bins - 1}) DIV {bins}"))
        inside = rows.join(open_, g).where((F.col("x") >= F.col("low")) & (F.col("x") < F.col("low") + F.col("width")))
        counted = inside.groupBy(*g, "low", "width", "step", F.expr("(x - low) DIV step").alias("bin")).agg(F.count(F.lit(1)).alias("c"))
        so_far = Window.partitionBy(*g, "low", "width").orderBy("bin")                    # at most ``bins`` rows
        counted = counted.withColumn("upto", F.sum("c").over(so_far))
        hit = state.join(counted, [*g, "low", "width"]).where((F.col("r") < F.col("upto")) & (F.col("r") >= F.col("upto") - F.col("c")))
        state = written(hit.select(*g, "n", (F.col("low") + F.col("bin") * F.col("step")).alias("low"), F.col("step").alias("width"), "q", "side",
                                   (F.col("r") - F.col("upto") + F.col("c")).alias("r")), "quantiles")

    def value(q: float):
        low, high = (F.max(F.when((F.col("q") == q) & (F.col("side") == s), F.col("low"))) / F.lit(float(UNIT)) for s in ("low", "high"))
        p = F.lit(float(q)) * (F.max("n") - 1)
        return F.when(F.ceil(p) == F.floor(p), low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)
    return state.groupBy(*g).agg(*[value(float(q)).alias(name) for name, q in qs.items()])
