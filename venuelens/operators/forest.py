"""Trees of the rating forest, grown from sums a cell of the binned features (M1).

A forest over binned features depends on its rows only through their cells, and there are at most
``MAX_BINS`` ** 3 cells whatever the rows. Spark counts the rows of each (cell, label), draws every
tree's bootstrap weights beside them and adds them up by tree and cell; each tree grows in the task
that receives its cells. Trees leave as rows of nodes, so the driver never holds one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BINS = 64
BINS = ("category_bin", "area_bin", "price_bin")
#: A split must gain more than rounding does.
LEAST_GAIN = 1e-9

_WEIGHED = "tree int, category_bin int, area_bin int, price_bin int, w double, s double"
_NODES = "tree int, node int, depth int, feature int, bin int, left int, right int, value double, gain double, box array<int>"


def bootstrap_sums(binned: DataFrame, trees: int, seed: int) -> DataFrame:
    """(tree, bins, w, s): weight and weighted label of every cell in every tree's bootstrap sample.

    ``n`` equal rows drawn with Poisson(1) weights weigh Poisson(n) together. A group's draws are seeded
    by its values, so they do not depend on how rows are partitioned.
    """
    def draw(batches):
        for b in batches:
            bins = np.stack([b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in BINS])
            y, n = (b.column(x).to_numpy(zero_copy_only=False) for x in ("label", "n"))
            if not len(y):
                continue
            bits = y.astype(np.float64).view(np.uint64).tolist()
            w = np.stack([np.random.default_rng([seed, *key, z]).poisson(m, trees) for *key, z, m in zip(*bins.tolist(), bits, n)])
            cell = np.ravel_multi_index(bins, [MAX_BINS] * 3)
            order = np.argsort(cell, kind="stable")
            head = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0])
            total, summed = (np.add.reduceat(x[order], head, axis=0) for x in (w, w * y[:, None]))
            row, tree = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.astype(np.int32)), *[pa.array(x[order][head][row].astype(np.int32)) for x in bins],
                 pa.array(total[row, tree].astype(np.float64)), pa.array(summed[row, tree].astype(np.float64))],
                ["tree", *BINS, "w", "s"])
    groups = binned.groupBy(*BINS, "label").agg(F.count(F.lit(1)).alias("n"))
    return groups.mapInArrow(draw, _WEIGHED).groupBy("tree", *BINS).agg(F.sum("w").alias("w"), F.sum("s").alias("s"))


def grow(bins: np.ndarray, w: np.ndarray, s: np.ndarray, sizes: list[int], max_depth: int) -> list[tuple]:
    """(node, depth, feature, bin, left, right, value, gain, box) of one regression tree.

    Each node takes the split of any feature that lowers the summed squared error most (ties: first feature,
    lowest bin; bins up to ``bin`` go left). A leaf has feature -1; its box bounds the bins it answers for.
    """
    nodes, made = [], 1
    stack = [(0, 0, np.arange(len(w)), tuple((0, n) for n in sizes))]
    while stack:
        node, depth, rows, box = stack.pop()
        rw, rs = w[rows], s[rows]
        weight, total = rw.sum(), rs.sum()
        gain, feature, at = LEAST_GAIN, -1, -1
        if depth < max_depth and len(rows) > 1:
            for f in range(len(sizes)):
                lw, ls = (np.cumsum(np.bincount(bins[f, rows], x, sizes[f]))[:-1] for x in (rw, rs))
                ok = np.flatnonzero((lw > 0) & (lw < weight))
                if len(ok):
                    gains = ls[ok] ** 2 / lw[ok] + (total - ls[ok]) ** 2 / (weight - lw[ok]) - total ** 2 / weight
                    best = int(np.argmax(gains))
                    if gains[best] > gain:
                        gain, feature, at = float(gains[best]), f, int(ok[best])
        value = float(total / weight)
        if feature < 0:
            nodes.append((node, depth, -1, -1, -1, -1, value, 0.0, [x for side in box for x in side]))
            continue
        left = bins[feature, rows] <= at
        low, high = box[feature]
        for child, part, side in ((made, left, (low, at + 1)), (made + 1, ~left, (at + 1, high))):
            stack.append((child, depth + 1, rows[part], box[:feature] + (side,) + box[feature + 1:]))
        nodes.append((node, depth, feature, at, made, made + 1, value, gain, None))
        made += 2
    return nodes


def grow_forest(binned: DataFrame, sizes: list[int], trees: int, seed: int, max_depth: int) -> DataFrame:
    """The nodes of all trees, from rows of ``BINS`` and ``label``: one group a tree, of at most MAX_BINS ** 3 cells."""
    def one(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_numpy() for c in table.column_names}
        order = np.lexsort([cols[x] for x in reversed(BINS)])
        nodes = grow(np.stack([cols[x][order] for x in BINS]), cols["w"][order], cols["s"][order], sizes, max_depth)
        parts = list(zip(*nodes))
        tree = np.full(len(nodes), cols["tree"][0], np.int32)
        return pa.table([pa.array(tree), *[pa.array(x, pa.int32()) for x in parts[:6]], pa.array(parts[6], pa.float64()),
                         pa.array(parts[7], pa.float64()), pa.array(parts[8], pa.list_(pa.int32()))],
                        ["tree", "node", "depth", "feature", "bin", "left", "right", "value", "gain", "box"])
    return bootstrap_sums(binned, trees, seed).groupBy("tree").applyInArrow(one, _NODES)


def cell_predictions(nodes: DataFrame) -> DataFrame:
    """(bins, mean, std): what the trees say of every cell, mean and population standard deviation."""
    box = F.col("box")
    cells = nodes.where("feature < 0").select("value", "box")
    for i, x in enumerate(BINS):
        cells = cells.withColumn(x, F.explode(F.sequence(box[2 * i], box[2 * i + 1] - 1)))
    said = cells.groupBy(*BINS).agg(F.avg("value").alias("mean"), F.avg(F.col("value") * F.col("value")).alias("_sq"))
    return said.select(*BINS, "mean", F.sqrt(F.greatest(F.col("_sq") - F.col("mean") * F.col("mean"), F.lit(0.0))).alias("std"))


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, share): each tree's gains by feature as shares, averaged over the trees that split."""
    gains = nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    total = gains.groupBy("tree").agg(F.sum("gain").alias("total"))
    shares = gains.join(total, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    return shares.crossJoin(shares.agg(F.sum("share").alias("all"))).select("feature", (F.col("share") / F.col("all")).alias("share"))
