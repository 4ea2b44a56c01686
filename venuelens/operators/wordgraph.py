"""The word graph of TextRank in blocks.

Edges are never rows of words. A task counts the pairs of about CHUNK_TOKENS tokens in numpy and keeps
them as one pack, by the places of its words in a list of its own. Words then get a block (by hash) and a place
in it, the packs are dealt to the cells of two blocks, where equal edges are added up, and an iteration is a product
of every cell with the scores of its two blocks. A task holds a chunk or a cell with a few blocks
at a time; every exchange carries packs, a few bytes an edge.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import freed, remove, scratch_path, ship_package, written
from .neighbours import _ranges, packed, unpacked

#: Tokens that a task counts together, and pairs at once.
CHUNK_TOKENS = 1_000_000
PORTION = 500_000
#: Edges (of all chunks) a cell and words a block, aimed at.
CELL_EDGES = 2_000_000
BLOCK_WORDS = 500_000
#: Words of the blocks whose products a task holds before it hands them on.
HELD_WORDS = 4_000_000
#: Parts of a block, so that more tasks than blocks can number the words.
PARTS = 16

_STATE = "k int, weight binary, score binary, x binary, moved double"


def _heads(key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def _counted(key: np.ndarray, w: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed weights, or how often they come."""
    if w is None:
        key = np.sort(key)
        head = _heads(key)
        return key[head], np.diff(np.r_[head, len(key)])
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = _heads(key)
    return key[head], np.add.reduceat(w[order], head) if len(head) else w


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _counted(*(np.concatenate(c) for c in zip(*parts, strict=True)))


# ---- pairs of a chunk --------------------------------------------------------------
def _pairs(table: pa.Table, window: int, carried: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, u, v, w) of the tokens at most ``window - 1`` positions apart, by places u < v in ``words``; the first ``carried`` rows have met each other."""
    token = table.column("token").combine_chunks().dictionary_encode()
    code = token.indices.to_numpy().astype(np.int64)
    gap = table.column("gap").to_numpy().astype(np.int64)
    gap[:1] = 0
    x = np.cumsum(gap)  # documents lie further apart than any pair
    low, high = np.searchsorted(x, x + 1), np.searchsorted(x, x + (window - 1), side="right")
    low = np.maximum(low, carried)
    n = np.maximum(high - low, 0)
    done = np.r_[0, np.cumsum(n)]
    span, parts, begin = max(1, len(token.dictionary)), [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    while begin < len(n):  # portions; documents that share a key have more pairs than tokens
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + PORTION, side="right")) - 1)
        u, v = np.repeat(code[begin:end], n[begin:end]), code[_ranges(low[begin:end], n[begin:end])]
        apart = u != v
        u, v = u[apart], v[apart]
        parts.append(_counted(np.minimum(u, v) * span + np.maximum(u, v)))
        if sum(len(p[0]) for p in parts) > 4 * PORTION:
            parts = [_joined(parts)]
        begin = end
    key, w = _joined(parts)
    return token.dictionary, key // span, key % span, w


def _chunks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of (token, gap) rows, gap the positions since the row before, ``window`` at the first of a document."""
    held, n, carried = [], 0, 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK_TOKENS + carried:
            table = pa.Table.from_batches(held)
            yield _pairs(table, window, carried)
            back = np.cumsum(table.column("gap").to_numpy()[::-1].astype(np.int64))  # a row's successor is back[i] ahead of the last but i rows
            carried = 1 + int(np.searchsorted(back, window - 1, side="right"))  # those that rows to come can meet
            carried = min(carried, table.num_rows)
            held, n = table.slice(table.num_rows - carried).combine_chunks().to_batches(), carried
    if n > carried:
        yield _pairs(pa.Table.from_batches(held), window, carried)


def _steps(tokens_pos: DataFrame, key: str, window: int) -> DataFrame:
    """(token, gap) rows in order of documents and positions; a document lies in one partition."""
    gap = F.col("pos") - F.lag("pos").over(Window.partitionBy(key).orderBy("pos"))
    rows = tokens_pos.where(F.col(key).isNotNull() & F.col("pos").isNotNull() & F.col("token").isNotNull())
    return rows.select("token", F.coalesce(F.least(gap, F.lit(window)), F.lit(window)).cast("int").alias("gap"))


def pair_rows(tokens_pos: DataFrame, key: str, window: int) -> DataFrame:
    """(u, v, w): the pairs as rows, once for every chunk that has them, in no order of u and v."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, u, v, w in _chunks(batches, window):
            for a in range(0, len(u), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(u[part])), words.take(pa.array(v[part])), pa.array(w[part])], ["u", "v", "w"])

    ship_package(tokens_pos.sparkSession)
    return _steps(tokens_pos, key, window).mapInArrow(rows, "u string, v string, w long")


def _pack_chunks(window: int) -> Callable:
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, (words, u, v, w) in enumerate(_chunks(batches, window)):
            n = np.bincount(u, minlength=len(words))
            step = np.diff(v, prepend=0)
            head = (np.cumsum(n) - n)[n > 0]
            step[head] = v[head]
            yield pa.RecordBatch.from_arrays([
                pa.array([(TaskContext.get().partitionId() << 32) + i], pa.int64()), pa.array([len(u)], pa.int64()),
                pa.array([packed([n, step, w])], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)],
                ["chunk", "n", "pairs", "words"])

    return packs


# ---- cells -------------------------------------------------------------------------
def _deal(blocks: int) -> Callable:
    """A chunk's pairs by cell (i, j), i <= j, and by their words' places in the blocks."""
    def dealt(chunk: pa.Table, ids: pa.Table) -> pa.Table:
        code = ids.column("code").to_numpy()
        block, place = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        block[code], place[code] = ids.column("block").to_numpy(), ids.column("place").to_numpy()
        n, step, w = unpacked(chunk.column("pairs")[0].as_buffer(), 3)
        run, some = np.cumsum(step), n[n > 0]
        head = np.cumsum(some) - some
        u, v = np.repeat(np.arange(len(n)), n), run - np.repeat(run[head] - step[head], some)
        span = int(place.max(initial=0)) + 1
        u, v = block[u] * span + place[u], block[v] * span + place[v]
        u, v = np.minimum(u, v), np.maximum(u, v)
        i, j = u // span, v // span
        order = np.lexsort((v, u, i * blocks + j))
        u, v, w, cell = u[order] % span, v[order] % span, w[order], (i * blocks + j)[order]
        head = _heads(cell)
        ends = np.r_[head[1:], len(cell)]
        packs = [packed([np.diff(u[a:b], prepend=0), v[a:b], w[a:b]]) for a, b in zip(head.tolist(), ends.tolist(), strict=True)]
        return pa.table({"i": pa.array(cell[head] // blocks, pa.int32()), "j": pa.array(cell[head] % blocks, pa.int32()), "pack": pa.array(packs, pa.binary())})

    return dealt


def _edges(pack: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step, v, w = unpacked(pack.as_buffer(), 3)
    return np.cumsum(step), v, w


def _merged(cell: pa.Table) -> pa.Table:
    """One pack of a cell: equal edges of all chunks added up."""
    u, v, w = (np.concatenate(c) for c in zip(*map(_edges, cell.column("pack").combine_chunks()), strict=True))
    span = int(v.max()) + 1
    key, w = _counted(u * span + v, w)
    pack = packed([np.diff(key // span, prepend=0), key % span, w])
    return pa.table({"i": cell.column("i")[:1], "j": cell.column("j")[:1], "pack": pa.array([pack], pa.binary())})


# ---- products ----------------------------------------------------------------------
def _added(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    if a is None:
        return b
    if len(a) < len(b):
        a, b = b, a
    a[:len(b)] += b
    return a


def _parts(found: dict) -> Iterator[pa.RecordBatch]:
    for k, part in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([2], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["k", "kind", "part"])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, kind, part): a block's sums over the edges to another block of w * x, or of w where there is no x."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, j, k, pack, x in zip(*(batch.column(c) for c in ("i", "j", "k", "pack", "x")), strict=True):
            i, j, k = i.as_py(), j.as_py(), k.as_py()
            u, v, w = _edges(pack)
            x = np.frombuffer(x.as_buffer()) if x.is_valid else None
            if k == j:
                found[i] = _added(found.get(i), np.bincount(u, w if x is None else w * x[v]))
            if k == i:
                found[j] = _added(found.get(j), np.bincount(v, w if x is None else w * x[u]))
            if sum(map(len, found.values())) > HELD_WORDS:
                yield from _parts(found)
                found = {}
    yield from _parts(found)


def _scored(damping: float) -> Callable:
    """Rows (k, kind, part) by block: weights 0, scores 1 and sums 2; without weights the sums are the weights, and scores begin at 1."""
    def block(k: int, own: dict) -> pa.RecordBatch:
        total = own.get(2, np.zeros(0))
        weight = own.get(0, total)
        some = weight > 0
        if 0 in own:
            total = np.r_[total, np.zeros(len(weight) - len(total))]
            score = np.where(some, (1 - damping) + damping * total, 0.0)
            moved = float(np.abs(score - own[1]).sum())
        else:
            score, moved = some.astype(np.float64), None
        x = np.divide(score, weight, out=np.zeros(len(weight)), where=some)
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in (weight, score, x)), pa.array([moved], pa.float64())],
                                          ["k", "weight", "score", "x", "moved"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, {}
        for batch in batches:
            for k, kind, part in zip(*(batch.column(c) for c in ("k", "kind", "part")), strict=True):
                if k.as_py() != now:
                    if own:
                        yield block(now, own)
                    now, own = k.as_py(), {}
                own[kind.as_py()] = _added(own.get(kind.as_py()), np.frombuffer(part.as_buffer()).copy())
        if own:
            yield block(now, own)

    return scored


def _unblocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, place, score) rows of the words that have edges."""
    for batch in batches:
        for k, weight, score in zip(*(batch.column(c) for c in ("k", "weight", "score")), strict=True):
            weight, score = np.frombuffer(weight.as_buffer()), np.frombuffer(score.as_buffer())
            some = np.flatnonzero(weight > 0)
            for a in range(0, len(some), 100_000):
                part = some[a:a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k.as_py()), pa.int32()), pa.array(part, pa.int64()), pa.array(score[part])], ["block", "place", "score"])


class WordGraph:
    """The co-occurrence graph of :func:`_steps` in the checkpoint folder, and the scores of its words.

    ``state`` has a row a block: its words' summed weights, scores and scores a weight. ``moved`` is the
    summed change of all scores in the last iteration. Shuffle files go when the job that needed them ends.
    """

    def __init__(self, tokens_pos: DataFrame, key: str, window: int, damping: float):
        self.spark = spark = tokens_pos.sparkSession
        self.damping, self.folder = damping, f"textrank-{uuid4().hex}"
        ship_package(spark)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        with freed(spark):
            chunks = written(_steps(tokens_pos, key, window).mapInArrow(_pack_chunks(window), "chunk long, n long, pairs binary, words array<string>"), f"{self.folder}/chunks/table")
            words = chunks.select("chunk", F.posexplode("words").alias("code", "word"))
            n_words = words.agg(F.approx_count_distinct("word")).first()[0]
            n_edges = chunks.agg(F.sum("n")).first()[0] or 0
            self.blocks = max(math.ceil(math.sqrt(parts)), math.ceil(math.sqrt(2 * n_edges / CELL_EDGES)), math.ceil(n_words / BLOCK_WORDS))
            own = F.xxhash64("word")
            words = words.withColumns({"block": F.pmod(own, F.lit(self.blocks)).cast("int"), "part": F.pmod(F.shiftright(own, 32), F.lit(PARTS)).cast("int")})
            rank = F.dense_rank().over(Window.partitionBy("block", "part").orderBy("word"))
            self.words = written(words.select("chunk", "code", "block", ((rank - 1) * PARTS + F.col("part")).cast("long").alias("place"), "word"), f"{self.folder}/words")
            dealt = chunks.select("chunk", "pairs").groupBy("chunk").cogroup(self.words.select("chunk", "code", "block", "place").groupBy("chunk")).applyInArrow(
                _deal(self.blocks), "i int, j int, pack binary")
            self.cells = written(dealt.groupBy("i", "j").applyInArrow(_merged, "i int, j int, pack binary"), f"{self.folder}/cells")
            remove(spark, scratch_path(spark, f"{self.folder}/chunks"))
            both = self.cells.withColumn("k", F.explode(F.array_distinct(F.array("i", "j")))).withColumn("x", F.lit(None).cast("binary"))
            self.state = self._summed(both.mapInArrow(_products, "k int, kind int, part binary"))

    def _summed(self, parts: DataFrame) -> DataFrame:
        return written(parts.repartition("k").sortWithinPartitions("k").mapInArrow(_scored(self.damping), _STATE), f"{self.folder}/scores")

    def step(self) -> None:
        """One iteration."""
        with freed(self.spark):
            other = F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("l")
            xs = self.state.select("k", "x", other).select(F.least("k", "l").alias("i"), F.greatest("k", "l").alias("j"), "k", "x")
            parts = self.cells.join(xs, ["i", "j"]).mapInArrow(_products, "k int, kind int, part binary")
            old = self.state.select("k", F.inline(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(c).alias("part")) for n, c in enumerate(("weight", "score"))])))
            self.state = self._summed(parts.unionByName(old))

    def drop(self) -> None:
        """Its tables go from the checkpoint folder."""
        remove(self.spark, scratch_path(self.spark, self.folder))

    def moved(self) -> float:
        return self.state.agg(F.sum("moved")).first()[0] or 0.0

    def scores(self) -> DataFrame:
        """(block, place, score) of the words that have edges."""
        return self.state.mapInArrow(_unblocked, "block int, place long, score double")
