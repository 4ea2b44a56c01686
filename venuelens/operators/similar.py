"""Most similar listings of every listing, exactly, without pairing all listings.

Listings with equal features are one class, and a class needs only its first ids to answer. The
features of a class's nearest classes mostly agree in category and area, so classes are compared
inside that cell first, in numpy blocks. The last similarity found is then held against a bound: a
listing of another cell lacks category or area in the product, so by Cauchy-Schwarz its similarity
is at most sqrt((1 - 1/s) (1 - 1/S)) for squared norms s (own) and S (the greatest of all), or
sqrt(1 - 1/s) if some listing has no category or area at all. Classes whose list does not beat the bound form a query set that is compared with all classes, in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Similarities that are held at once, and classes of a block when all are compared.
HELD = 2_000_000
BLOCK = 20_000

_LIST = "cid long, other_id long, s6 long"


def _columns(table: pa.Table) -> dict:
    out = {c: np.array(table.column(c).to_pylist(), object) for c in ("category", "area")}
    out |= {c: table.column(c).to_numpy() for c in ("cid", "price_level", "rating_norm", "sq")}
    return out | {"tags": table.column("tags").to_pylist(), "ids": table.column("ids").to_pylist()}


def _coded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes that are equal where values are; a null's is below 0 and fits none."""
    number: dict = {}
    return tuple(np.array([number.setdefault(x, len(number)) if x is not None else -1 for x in side], np.int64) for side in (a, b))


def _nearest(asking: dict, others: dict, n: int) -> pa.Table:
    """The ``n`` + 1 nearest listings (own class included) of each asking class: by similarity, then id."""
    first = np.array([i[0] for i in others["ids"]], np.int64)
    rank = np.argsort(np.argsort(first))
    tags = {t: i for i, t in enumerate(sorted({t for side in (asking, others) for row in side["tags"] for t in row}))}
    slots = [np.zeros((len(side["cid"]), len(tags))) for side in (asking, others)]
    for side, slot in zip((asking, others), slots):
        for i, row in enumerate(side["tags"]):
            slot[i, [tags[t] for t in row]] = 1
    codes = [_coded(asking[c], others[c]) for c in ("category", "area")]
    cids, ids, scores = [], [], []
    step = max(1, HELD // max(1, len(first)))
    for a in range(0, len(asking["cid"]), step):
        rows = slice(a, a + step)
        dot = np.zeros((len(asking["cid"][rows]), len(first)))
        for mine, theirs in codes:
            dot += (mine[rows, None] == theirs[None, :]) & (theirs >= 0)[None, :]
        dot += asking["price_level"][rows, None] * others["price_level"][None, :]
        dot += asking["rating_norm"][rows, None] * others["rating_norm"][None, :]
        dot += slots[0][rows] @ slots[1].T
        norm = np.sqrt(asking["sq"][rows, None] * others["sq"][None, :])
        sim = np.divide(dot, norm, out=np.zeros_like(dot), where=norm > 0)
        s6 = (np.floor(sim * 1e10 + 0.5).astype(np.int64) + 5000) // 10000  # to ten digits, then half up to six
        key = ((1_000_000 - s6) << 40) | rank[None, :]
        best = min(n + 1, len(first))
        near = np.argpartition(key, best - 1, axis=1)[:, :best] if best < len(first) else np.tile(np.arange(len(first)), (len(key), 1))
        for i, row in enumerate(near):
            found = sorted((-int(s6[i, j]), x) for j in row.tolist() for x in others["ids"][j])[: n + 1]
            cids += [int(asking["cid"][a + i])] * len(found)
            ids += [x for _, x in found]
            scores += [-s for s, _ in found]
    return pa.table({"cid": pa.array(cids, pa.int64()), "other_id": pa.array(ids, pa.int64()), "s6": pa.array(scores, pa.int64())})


def classes(features: DataFrame, n: int, key: str = "listing_id") -> tuple[DataFrame, DataFrame]:
    """(key, cid) of every listing, and the classes: cid, features, sq (squared norm) and the first ``n`` + 1 ids."""
    names = ["category", "area", "price_level", "rating_norm", "tags"]
    f = features.select(key, "category", "area", "price_level", F.coalesce("rating_norm", F.lit(0.0)).alias("rating_norm"), F.array_sort("tags").alias("tags"))
    f = f.withColumn("cid", F.xxhash64(F.to_json(F.struct(*names))))
    order = Window.partitionBy("cid").orderBy(key)
    heads = f.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n + 1)   # limited before the exchange
    own = F.col("category").isNotNull().cast("double") + F.col("area").isNotNull().cast("double")
    sq = own + F.col("price_level") ** 2 + F.col("rating_norm") ** 2 + F.size("tags").cast("double")
    made = heads.groupBy("cid", *names).agg(F.sort_array(F.collect_list(key)).alias("ids")).withColumn("sq", sq)
    return f.select(key, "cid"), made


def nearest_listings(features: DataFrame, n: int = 5, targets: DataFrame | None = None, key: str = "listing_id", block: int = BLOCK) -> DataFrame:
    """(target_id, listing_id, sim, rank): the ``n`` most similar other listings of every listing, or of ``targets`` (key).

    ``features``: the table of :func:`recommend.feature_columns`. Ties go to the smaller id.
    """
    own, made = classes(features, n, key)
    made = written(made, "classes")
    if targets is not None:
        own = own.join(targets.select(key).distinct(), key, "left_semi")
    asking = made.join(own.select("cid").distinct(), "cid", "left_semi").select("*", F.lit(True).alias("asks"))
    both = asking.unionAll(made.select("*", F.lit(False)))

    def in_cell(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        return _nearest(_columns(table.filter(pa.array(asks))), _columns(table.filter(pa.array(~asks))), n)

    near = written(both.groupBy("category", "area").applyInArrow(in_cell, _LIST), "near")
    # a listing without category or area has nothing to lose there: its share is whole
    most = made.agg(F.max(F.when(F.col("category").isNull() | F.col("area").isNull(), 1.0).otherwise(1 - 1 / F.col("sq"))).alias("most"))
    last = near.groupBy("cid").agg(F.min("s6").alias("last"), F.count(F.lit(1)).alias("n"))
    share = F.greatest(F.lit(0.0), 1 - 1 / F.col("sq"))
    # a list is right if it is full and nothing of another cell reaches its last (two units of the sixth digit kept)
    bound = F.sqrt(share * F.col("most")) * 1e6 + 2
    whole = F.col("category").isNotNull() & F.col("area").isNotNull() & (F.col("n") > n) & (F.col("last") > bound)
    state = asking.select("cid", "category", "area", "sq").join(last, "cid", "left").join(F.broadcast(most))
    state = state.select("cid", F.coalesce(whole, F.lit(False)).alias("whole"))
    rest = asking.join(state.where("not whole"), "cid", "left_semi")
    n_rest, n_all = rest.count(), made.count()
    answers = near.join(state.where("whole"), "cid", "left_semi")
    if n_rest:
        across, down = -(-n_rest // block), -(-n_all // block)
        spread = F.pmod(F.col("cid"), F.lit(across)), F.pmod(F.col("cid"), F.lit(down))
        grid = rest.select("*", spread[0].alias("a"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("b")).unionAll(
            made.select("*", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("a"), spread[1].alias("b")))
        best = Window.partitionBy("cid").orderBy(F.desc("s6"), "other_id")
        found = grid.groupBy("a", "b").applyInArrow(lambda t: in_cell(t), _LIST).withColumn("_r", F.row_number().over(best))
        answers = answers.unionAll(found.where(F.col("_r") <= n + 1).drop("_r"))
    place = Window.partitionBy("target_id").orderBy(F.desc("s6"), "listing_id")                  # n + 1 rows
    rows = own.withColumnRenamed(key, "target_id").join(answers, "cid").where("target_id <> other_id").withColumnRenamed("other_id", "listing_id")
    return rows.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= n).select(
        "target_id", "listing_id", (F.col("s6") / 1e6).alias("sim"), "rank")
