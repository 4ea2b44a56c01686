"""Connected components of an edge table, by contraction in rounds.

Each round points every node at its smallest neighbour (or itself), follows the pointers
until they rest on roots, replaces every edge by the edge between its ends' roots and
drops the loops. At least half of the nodes that still have edges vanish a round. The
pointers of each round are written to the checkpoint folder and are composed at the end;
nothing but two counts a round reaches the driver. A hot node costs no large group: its
edges meet in map-side aggregates and in plain joins that AQE may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.session import checkpoint_dir


def _follow(pointers: DataFrame) -> DataFrame:
    """Pointers (node, root) with every chain followed to its end; a root points at itself."""
    while True:
        far = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        # a chain goes on where the node pointed at points at another one
        pointers = (
            pointers.join(far, "root", "left")
            .select("node", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved"))
            .checkpoint()
        )
        moved = pointers.where("moved").limit(1).count()
        pointers = pointers.select("node", "root")
        if not moved:
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges(a, b)``; component: the smallest node reachable.

    Nulls in either column, loops and repeated edges are allowed and link nothing new. No
    edges: no rows. Ends may be of any orderable type, the same for both.
    """
    checkpoint_dir(edges.sparkSession)
    edges = edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct().checkpoint()
    rounds: list[DataFrame] = []
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )
        pointers = _follow(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("root")))
        rounds.append(pointers)
        a = pointers.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = pointers.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = (
            edges.join(a, "a").join(b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct().checkpoint()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[0]
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found.select("node", F.col("root").alias("component"))
