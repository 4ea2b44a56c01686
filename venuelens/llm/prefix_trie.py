"""Conversation prefix trie with subtree totals by time-forward processing.

Conversations are rebuilt (each takes its first turns from its hundred's base conversation) and
their prefixes become trie nodes. A node is the XOR of its turns' hashes, each mixed with the
turn's place (two independent 64-bit values), so prefixes need no text and a long conversation's
prefix values come from blocks of turns. A node is named by its smallest member and its depth.

Totals of subtrees run towards the root:

1. *Shards.* A node's weight is the number of its members' turns from it on, known from one
   aggregate. Nodes of at most a share of all weight are light; a light node below a heavy one is a
   shard root, and its whole subtree is one shard, of at most that many nodes.
2. *Within shards.* Each task gets its shards' nodes externally sorted in reverse level order and
   sends every node's total to its parent through a priority queue (:class:`Queue`), which spills
   sorted runs and hands them back merged, a piece at a time, when the parents' level comes up.
3. *Across shard roots.* Roots' totals are summed by heavy parent in Spark and enter the queue of
   the heavy top, processed in the same way. The top has at most SHARDS a partition nodes a level.

Rows with a null conv_id belong to no conversation and are left out; below zero, c % 100 is SQL's. Null turns come first; equal
turns are ordered by role, then text. Null role or text is empty. A repeated row is a turn of its
own. An empty table has no nodes. Texts may have any length; other columns are ignored. An end
list is hashed as a stream of packed runs of ids, so that no list is held whole. Spilled runs are
nameless files in Spark's own scratch folder of the executor, read by their own task alone.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelens.llm.common import lean, prepare, shuffle_partitions
from venuelens.operators.windows import ranked_within

#: Conversations of one hundred share its first; a conversation takes up to SHARED - 1 turns from it.
HUNDRED = 100
SHARED = 6
#: Light subtrees a shuffle partition, and the least size worth a shard.
SHARDS = 8
LEAST_SHARD = 4096
#: Messages a queue holds before it spills a sorted run.
HELD = 1_000_000
#: Turns of a conversation that one window sees.
BLOCK = 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# ---------------------------------------------------------------- rebuilt conversations


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(c, i, x1, x2, chars): turns numbered from 1 within their conversation, with hashes of (role, text)."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ranked = ranked_within(rows, ["c"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "i")
    return ranked.select(
        "c", "i", F.xxhash64("role", "text").alias("x1"), F.xxhash64(F.lit("second"), "text", "role").alias("x2"), F.length("text").cast("long").alias("chars")
    ).checkpoint()


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, n) of every rebuilt conversation, and its rows (c, n, depth, y1, y2, chars); y: a turn's hashes at its place."""
    convs = turns.groupBy("c").agg(F.max("i").alias("own")).select(
        "c", "own", (F.col("c") - F.col("c") % HUNDRED).alias("base"), (F.crc32(F.col("c").cast("string")) % SHARED).alias("h")
    )
    bases = convs.where("c = base").select("base", F.col("own").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("hb", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("n", F.col("hb") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("c", "base", "h", "hb", "n").checkpoint()
    own = turns.join(convs, "c").where("i > h").select("c", "n", (F.col("hb") + F.col("i") - F.col("h")).alias("depth"), "x1", "x2", "chars")
    heads = turns.where((F.col("i") < SHARED) & (F.col("c") % HUNDRED == 0)).select(F.col("c").alias("base"), F.col("i").alias("depth"), "x1", "x2", "chars")
    asked = convs.where("hb > 0").select("c", "n", "base", F.explode(F.sequence(F.lit(1).cast("long"), "hb")).alias("depth"))
    rows = own.unionAll(asked.join(heads, ["base", "depth"]).select("c", "n", "depth", "x1", "x2", "chars"))
    return convs.select("c", "n"), rows.select("c", "n", "depth", F.xxhash64("x1", "depth").alias("y1"), F.xxhash64("x2", "depth").alias("y2"), "chars")


def prefixes(rows: DataFrame) -> DataFrame:
    """``rows`` with h1, h2 (the prefix that ends there) and p1, p2 (its parent). A window sees BLOCK turns at most."""
    rows = rows.withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    so_far = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.where(F.col("n") > BLOCK).groupBy("c", "block").agg(F.bit_xor("y1").alias("t1"), F.bit_xor("y2").alias("t2"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row in BLOCK turns
    before = totals.select("c", "block", F.bit_xor("t1").over(earlier).alias("b1"), F.bit_xor("t2").over(earlier).alias("b2")).where("block > 0")
    out = rows.withColumns({"h1": F.bit_xor("y1").over(so_far), "h2": F.bit_xor("y2").over(so_far)}).join(before, ["c", "block"], "left")
    h = {k: F.col(f"h{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0).cast("long"))) for k in (1, 2)}
    return out.select("c", "n", "depth", "chars", h[1].alias("h1"), h[2].alias("h2"), *[h[k].bitwiseXOR(F.col(f"y{k}")).alias(f"p{k}") for k in (1, 2)])


def nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, h1, h2, p1, p2, conv_id, n_convs, own, weight) of every node; own: its own share of the saved tokens."""
    figures = [
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), ((F.count(F.lit(1)) - 1) * F.max("chars")).alias("own"),
        F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
    ]
    found = rows.groupBy("depth", "h1", "h2").agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), *figures)
    zero = F.lit(0).cast("long")
    root = convs.select("c", "n", zero.alias("depth"), zero.alias("chars")).agg(*figures).where("n_convs > 0")
    names = ["depth", "h1", "h2", "p1", "p2", "conv_id", "n_convs", "own", "weight"]
    return found.select(names).unionAll(root.withColumns({k: zero for k in ("depth", "h1", "h2", "p1", "p2")}).select(names))


# ---------------------------------------------------------------- time-forward processing

_MESSAGE = np.dtype([("to", "<i8"), ("children", "<i8"), ("leaves", "<i8"), ("saved", "<i8")])
_SUMS = ("children", "leaves", "saved")


def _summed(messages: np.ndarray) -> np.ndarray:
    """Messages in the order of their receivers, one a receiver."""
    if not len(messages):
        return messages
    messages = messages[np.argsort(messages["to"], kind="stable")]
    head = np.flatnonzero(np.r_[True, messages["to"][1:] != messages["to"][:-1]])
    out = np.empty(len(head), _MESSAGE)
    out["to"] = messages["to"][head]
    for k in _SUMS:
        out[k] = np.add.reduceat(messages[k], head)
    return out


class Queue:
    """Messages to the nodes of one level, taken in the nodes' order; past ``held`` messages, sorted runs go to a file."""

    def __init__(self, held: int = HELD):
        self.held, self.new, self.size, self.runs, self.at = held, [], 0, [], []

    def push(self, messages: np.ndarray) -> None:
        self.new.append(messages)
        self.size += len(messages)
        if self.size > self.held:
            run = self._sorted()
            if len(run) > self.held // 2:
                with tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None) as f:
                    run.tofile(f)
                    f.flush()
                    run = np.memmap(f, _MESSAGE, "r", shape=run.shape)  # the map keeps the nameless file until it is dropped
                self._add(run)
            else:
                self.new, self.size = [run], len(run)

    def _sorted(self) -> np.ndarray:
        out = _summed(np.concatenate(self.new)) if self.new else np.zeros(0, _MESSAGE)
        self.new, self.size = [], 0
        return out

    def _add(self, run: np.ndarray) -> None:
        self.runs.append(run)
        self.at.append(0)

    def take(self, last: int) -> np.ndarray:
        """The messages to nodes up to ``last``, which come up once, in rising order."""
        if self.new:
            self._add(self._sorted())
        parts = []
        for i, run in enumerate(self.runs):
            to = int(np.searchsorted(run["to"][self.at[i]:], last, side="right")) + self.at[i]
            parts.append(np.asarray(run[self.at[i]: to]))
            self.at[i] = to
        return _summed(np.concatenate(parts)) if parts else np.zeros(0, _MESSAGE)


_IN = ["conv_id", "depth", "parent", "is_root", "own", "children", "leaves", "saved"]
_TOTALS = "conv_id long, depth long, parent long, is_root boolean, n_children long, n_leaves long, saved_tokens long"


@lean
def time_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes come by falling depth, then conv_id; each takes its messages and sends its total to its parent, one level up.

    ``children``, ``leaves`` and ``saved`` of a row are totals that reached it from elsewhere; a root (is_root) sends nothing.
    """
    level, coming, going = None, Queue(), Queue()
    for batch in batches:
        col = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in _IN}
        edge = np.flatnonzero(np.r_[True, col["depth"][1:] != col["depth"][:-1], True]) if len(batch) else []
        total = np.zeros(len(batch), _MESSAGE)
        for a, b in zip(edge[:-1], edge[1:]):
            depth = int(col["depth"][a])
            if depth != level:
                coming, going = (going if level is not None and depth == level - 1 else Queue()), Queue()
                level = depth
            part = total[a:b]
            for k in _SUMS:
                part[k] = col[k][a:b]
            got = coming.take(int(col["conv_id"][b - 1]))
            at = np.searchsorted(col["conv_id"][a:b], got["to"])
            for k in _SUMS:
                part[k][at] += got[k]
            part["leaves"][part["children"] == 0] = 1
            part["saved"] += col["own"][a:b]
            up = np.flatnonzero(~col["is_root"][a:b])
            sent = part[up].copy()
            sent["to"], sent["children"] = col["parent"][a:b][up], 1
            going.push(sent)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in _IN[:4]] + [pa.array(np.ascontiguousarray(total[k])) for k in _SUMS],
            ["conv_id", "depth", "parent", "is_root", "n_children", "n_leaves", "saved_tokens"],
        )


def subtree_totals(found: DataFrame, rows: DataFrame, limit: int, parts: int) -> DataFrame:
    """(conv_id, depth, n_children, n_leaves, saved_tokens) of ``found`` (nodes with parent); ``rows``: the members' prefixes."""
    found = found.withColumn("parent", F.coalesce("parent", F.lit(0).cast("long")))  # the root's: it sends nothing
    own_path = rows.select("c", "depth", "h1", "h2").unionAll(
        rows.select("c").distinct().select("c", *[F.lit(0).cast("long").alias(k) for k in ("depth", "h1", "h2")])
    )
    heavy = found.where(F.col("weight") > limit)
    light_of = own_path.join(heavy.select("depth", "h1", "h2"), ["depth", "h1", "h2"], "left_anti").groupBy("c").agg(F.min(F.struct("depth", "h1", "h2")).alias("root"))
    none = {k: F.lit(0).cast("long") for k in _SUMS}
    light = found.where(F.col("weight") <= limit).join(light_of.withColumnRenamed("c", "conv_id"), "conv_id")
    light = light.withColumn("is_root", F.col("depth") == F.col("root.depth")).withColumns(none)
    inside = light.repartition(parts, "root").sortWithinPartitions(F.desc("depth"), "conv_id").select(_IN).mapInArrow(time_forward, _TOTALS).checkpoint()
    to_top = inside.where("is_root and depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    top = heavy.join(to_top, ["conv_id", "depth"], "left").fillna(0, list(_SUMS)).withColumn("is_root", F.col("depth") == 0)
    across = top.select(_IN).repartition(1).sortWithinPartitions(F.desc("depth"), "conv_id").mapInArrow(time_forward, _TOTALS)
    return inside.unionAll(across).drop("parent", "is_root")


# ---------------------------------------------------------------- ends


@lean
def _runs_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids come in rising order; those of a batch that end at one node become one text."""
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in ("depth", "h1", "h2")])
        c = batch.column("c").to_numpy()
        order = np.lexsort((c, *keys[::-1]))
        keys, c = keys[:, order], c[order]
        head = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if len(c) else np.zeros(0, np.int64)
        ends = np.r_[head[1:], len(c)]
        ids = [",".join(map(str, c[a:b].tolist())) for a, b in zip(head, ends)]
        yield pa.RecordBatch.from_arrays([*(pa.array(k[head]) for k in keys), pa.array(c[head]), pa.array(ids, pa.string())], ["depth", "h1", "h2", "c", "ids"])


@lean
def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs come by node and first id; each node's are hashed as they pass."""
    rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in ("depth", "h1", "h2", "ids"))))
    out: list[tuple] = []
    for node, runs in groupby(rows, lambda r: r[:3]):
        digest = hashlib.sha256(next(runs)[3].encode())
        for run in runs:
            digest.update(b"," + run[3].encode())
        out.append((*node, digest.hexdigest()))
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], ["depth", "h1", "h2", "ends_sha256"])
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], ["depth", "h1", "h2", "ends_sha256"])


def end_hashes(ends: DataFrame, parts: int) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of ``ends(c, depth, h1, h2)``."""
    runs = ends.repartitionByRange(parts, "c").sortWithinPartitions("c").mapInArrow(_runs_of_ids, "depth long, h1 long, h2 long, c long, ids string")
    by_node = runs.repartition(parts, "depth", "h1", "h2").sortWithinPartitions("depth", "h1", "h2", "c")
    return by_node.mapInArrow(_hash_runs, "depth long, h1 long, h2 long, ends_sha256 string")


# ---------------------------------------------------------------- the operator


def trie(conversations: DataFrame) -> DataFrame:
    """A row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = prepare(conversations.sparkSession)
    parts = shuffle_partitions(spark)
    convs, rows = rebuild(numbered_turns(conversations))
    rows = prefixes(rows).checkpoint()
    made = nodes(convs, rows).checkpoint()
    names = made.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent"))
    made = made.join(names, ["depth", "p1", "p2"], "left").checkpoint()
    weight = made.where("depth = 0").select("weight").first()
    limit = max(LEAST_SHARD, (weight[0] if weight else 0) // (SHARDS * parts))
    every = convs.select("c", *[F.lit(0).cast("long").alias(k) for k in ("depth", "h1", "h2")])
    ends = rows.where("depth = n").select("c", "depth", "h1", "h2").unionAll(every.join(convs.where("n = 0").select("c"), "c"))
    out = made.join(subtree_totals(made, rows, limit, parts), ["conv_id", "depth"]).join(end_hashes(ends, parts), ["depth", "h1", "h2"], "left")
    return out.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
