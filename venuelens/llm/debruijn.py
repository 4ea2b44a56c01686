"""Substring deduplication over words by De Bruijn compaction.

A word is removed if some window of K words that covers it also starts earlier: in a smaller
doc_id, or in the same document before. Windows are judged on the input. The windows are the
edges of a De Bruijn graph whose nodes are runs of K - 1 words:

1. *Edges in packed runs.* Successive windows whose least-hashed M-word string is the same
   occurrence form a block (a super-k-mer: a path of edges that travels as one). Each task folds
   the blocks of a pack of text: of equal blocks all but the first are removed at once; an anchor
   with different blocks in the pack is open; every anchor leaves the pack as one row.
2. *Buckets of anchors.* An anchor that occurs in one pack only is done. If all packs hold the
   same block, it is one repeated edge path: its first place is the source, the others are
   removed. If not, its blocks are open. A hot anchor has one row a pack here.
3. *Single edges.* Open blocks are read again from their documents and become single edges with
   their nodes (folded in the task in the same way), and each repeated block gives its end nodes.
   A window by edge finds the source, the earliest place, of each repeated edge.
4. *Compaction.* Repeated edges and blocks are joined at the nodes that one of them enters and one
   leaves: first along the source coordinates, where a path mostly follows one document, then the
   runs across documents by joins (:func:`components`). So every piece knows its nonbranching path.
5. *Spans.* Later places that follow each other on one path at one distance from their source are
   one long repeated span (document, first word, end, path, source document, source word). Every
   piece's check, a hash by independent values, must equal its source's; a place without it stays.

So no row is ever compared with all of its like: a key has at most one row a pack or task. Hashes
are 64 bits of the words plus 64 bits (single edges) or 32 bits (blocks, beside 96 of anchor and
block) of check.

Repeated rows with one doc_id: equal places are one occurrence and do not remove each other. A
null doc_id sorts before all others; other ids must fit a long. Null text has no words. Texts may have any length,
one text is one row. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelens.llm.common import documents, flat, lean, mix, prepare, shuffle_partitions, slices, text_or_empty
from venuelens.llm.components import components
from venuelens.llm.words import RunHash, Words, kinds

K = 20
M = 8
STEPS = K - M + 1
#: White space of the contract: a space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text whose blocks a task folds together, and single edges that it folds together.
PACK_BYTES = 24 << 20
FOLD_EDGES = 500_000

_LEAST = -(2**63)
_TABLE = kinds(SPACES)
_SECOND = np.uint64(0x5851F42D4C957F2D)

# ---------------------------------------------------------------- blocks


class Blocks:
    """The blocks of flat documents: row, first and last window (by number in the document), hashes of anchor, block and check."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        self.words = Words(offsets, data, _TABLE)
        values = self.words.hashes(data)
        self.hash, self.check = RunHash(values), RunHash(mix(values ^ _SECOND))
        edges = self.words.edges
        grams = self.hash.windows(M)
        start = np.zeros(0, np.int64)
        if len(grams) >= STEPS:
            mask = np.uint64((1 << int(len(grams)).bit_length()) - 1)
            least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
            width = 1
            while 2 * width <= STEPS:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < STEPS:
                least = np.minimum(least[: len(least) - (STEPS - width)], least[STEPS - width:])
            at = (least & mask).astype(np.int64)
            start = np.flatnonzero(np.arange(len(at)) + K <= edges[1:][self.words.row[: len(at)]])
        if len(start):
            at = at[start]
            new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
            first, last, anchor = start[new], start[np.r_[new[1:] - 1, len(start) - 1]], at[new]
            self.anchor = grams[anchor]
            # where the anchor lies is part of the block
            self.block = mix(self.hash.of(first, last + K) + mix((anchor - first).astype(np.uint64) + np.uint64(1)))
        else:
            first = last = start
            self.anchor = self.block = np.zeros(0, np.uint64)
        self.row = self.words.row[first] if len(first) else start
        base = edges[self.row]
        self.first, self.last = first - base, last - base
        self.sure = self.check.of(first, last + K) if len(first) else np.zeros(0, np.uint64)


def _squeeze(arrays: list[np.ndarray]) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unsqueeze(blob: bytes, dtypes: list[str]) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(body, "<i8", len(dtypes))
    ends = 8 * len(dtypes) + np.cumsum(sizes)
    return [np.frombuffer(body, d, int(s) // np.dtype(d).itemsize, int(e - s)) for d, s, e in zip(dtypes, sizes, ends)]


def _cut(x: np.ndarray, n: int) -> np.ndarray:
    """The lowest n bytes of each value, plane by plane."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).ravel()


def _uncut(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(x) // n, 8), np.uint8)
    out[:, :n] = x.reshape(n, -1).T
    return out.view("<u8").ravel()


_ROW = "bucket int, kind int, kid long, tag int, blob binary"
#: kinds of rows: a pack's anchors; a document's removed windows, open blocks and sources of repeated blocks, as pairs (first, last window)
PACKED, GONE, OPEN, SOURCE = 0, 1, 2, 3
_PACK = ["<i8", "<i4", "<i4", "<i4", "u1", "u1", "u1", "u1", "u1"]


def _rows(bucket, kind, kid, tag, blobs: pa.Array) -> pa.RecordBatch:
    n = len(blobs)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(np.asarray(x, t), n)) for x, t in ((bucket, np.int32), (kind, np.int32), (kid, np.int64), (tag, np.int32))] + [blobs],
        ["bucket", "kind", "kid", "tag", "blob"],
    )


def _by_document(kind: int, kid: np.ndarray, tag: np.ndarray, first: np.ndarray, last: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row a document with its pairs; neighbouring removed blocks become one pair."""
    if not len(kid):
        return
    order = np.lexsort((first, tag, kid))
    kid, tag, first, last = kid[order], tag[order], first[order], last[order]
    other = np.r_[True, (kid[1:] != kid[:-1]) | (tag[1:] != tag[:-1])]
    if kind == GONE:
        new = np.flatnonzero(other | np.r_[True, first[1:] != last[:-1] + 1])
        last = last[np.r_[new[1:] - 1, len(last) - 1]]
        kid, tag, first, other = kid[new], tag[new], first[new], other[new]
    head = np.flatnonzero(other)
    pairs = np.stack([first, last], 1).astype("<i4")
    ends = (np.r_[head, len(kid)] * 8).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pairs.tobytes())])
    yield _rows((kid[head] + tag[head]) % buckets, kind, kid[head], tag[head], blobs)


def _fold(kid: np.ndarray, tag: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, block: np.ndarray,
          sure: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The rows of one pack of blocks; ``row`` points into kid and tag."""
    order = np.lexsort((first, kid[row], sure, block, anchor))
    row, first, last, anchor, block, sure = (x[order] for x in (row, first, last, anchor, block, sure))
    k = kid[row]
    new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
    new = new_anchor | np.r_[True, (block[1:] != block[:-1]) | (sure[1:] != sure[:-1])]
    head = np.flatnonzero(new)
    lead = np.repeat(head, np.diff(np.r_[head, len(row)]))
    gone = ~new & ((k != k[lead]) | (first != first[lead]))
    yield from _by_document(GONE, k[gone], tag[row[gone]], first[gone], last[gone], buckets)
    begin = np.flatnonzero(new_anchor)
    variants = np.add.reduceat(new.astype(np.int64), begin)
    several = new & np.repeat(variants > 1, np.diff(np.r_[begin, len(row)]))
    yield from _by_document(OPEN, k[several], tag[row[several]], first[several], last[several], buckets)
    # one row an anchor: its first block, marked if there are others
    marked = variants > 1
    bucket = ((anchor[begin] >> np.uint64(48)) % np.uint64(buckets)).astype(np.int64)
    by = np.lexsort((first[begin], row[begin], bucket))
    begin, marked = begin[by], marked[by]
    edge = np.searchsorted(bucket[by], np.arange(buckets + 1))
    for b in range(buckets):
        at, m = begin[edge[b]: edge[b + 1]], marked[edge[b]: edge[b + 1]]
        if len(at):
            docs, n = np.unique(row[at], return_counts=True)
            span = (last[at] - first[at]).astype(np.uint8) | (m.astype(np.uint8) << 7)
            blob = _squeeze([
                kid[docs], tag[docs], n.astype("<i4"), np.diff(first[at], prepend=0).astype("<i4"), span,
                _cut(anchor[at], 6), _cut(block[at], 6), _cut(sure[at], 4), np.zeros(0, np.uint8),
            ])
            yield _rows(b, PACKED, 0, 0, pa.array([blob], pa.binary()))


@lean
def _pack_batches(batches: Iterator[pa.RecordBatch], buckets: int, pack_bytes: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    rows = size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held and sum(len(h[2]) for h in held):
            yield from _fold(*(np.concatenate([h[i] for h in held]) for i in range(8)), buckets)

    for batch in batches:
        offsets, data = flat(batch.column("text"))
        kid, tag = batch.column("kid").to_numpy(), batch.column("tag").to_numpy()
        for a, b in slices(offsets):
            f = Blocks(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]])
            held.append((kid[a:b], tag[a:b], f.row + rows, f.first, f.last, f.anchor, f.block, f.sure))
            rows += b - a
        size += len(data)
        if size >= pack_bytes:
            yield from flush()
            held.clear()
            rows = size = 0
    yield from flush()


# ---------------------------------------------------------------- buckets of anchors


def _settle(blobs: list[bytes], buckets: int) -> Iterator[pa.RecordBatch]:
    parts = [_unsqueeze(b, _PACK) for b in blobs]
    kid = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
    tag = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
    first = np.concatenate([np.cumsum(p[3], dtype=np.int64) for p in parts])
    span = np.concatenate([p[4] for p in parts])
    anchor, block, sure = (np.concatenate([_uncut(p[i], n) for p in parts]) for i, n in ((5, 6), (6, 6), (7, 4)))
    order = np.argsort(anchor)
    ranked = anchor[order]
    same = ranked[1:] == ranked[:-1]
    order = order[np.r_[same, False] | np.r_[False, same]]
    if not len(order):
        return
    order = order[np.lexsort((first[order], kid[order], anchor[order]))]
    kid, tag, first, span, anchor, block, sure = (x[order] for x in (kid, tag, first, span, anchor, block, sure))
    marked, last = span >> 7 == 1, first + (span & 127)
    head = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[head, len(kid)])
    lead = np.repeat(head, size)
    differs = marked | (block != block[lead]) | (sure != sure[lead]) | (last - first != last[lead] - first[lead])
    open_ = np.repeat(np.add.reduceat(differs.astype(np.int64), head) > 0, size)
    later = ~open_ & ((kid != kid[lead]) | (first != first[lead]))
    at_head = np.zeros(len(kid), bool)
    at_head[head] = True
    for kind, rows in ((GONE, later), (OPEN, open_ & ~marked), (SOURCE, at_head & ~open_)):
        yield from _by_document(kind, kid[rows], tag[rows], first[rows], last[rows], buckets)


@lean
def _settle_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket: its packed anchors are settled together, other rows pass."""
    blobs: list[bytes] = []
    current = None
    for batch in batches:
        packed = batch.column("kind").to_numpy() == PACKED
        if not packed.all():
            yield batch.filter(pa.array(~packed))
        for i in np.flatnonzero(packed).tolist():
            bucket = batch.column("bucket")[i].as_py()
            if bucket != current and blobs:
                yield from _settle(blobs, buckets)
                blobs = []
            current = bucket
            blobs.append(batch.column("blob")[i].as_py())
    if blobs:
        yield from _settle(blobs, buckets)


# ---------------------------------------------------------------- single edges

#: kinds of pieces: a single edge, a repeated block's source, a run of edges equal to earlier ones of the task
EDGE, PATH, LATER = 0, 1, 2
_PIECE = "kind int, h long, sure long, enters long, leaves long, kid long, tag int, first int, n int, src_kid long, src_first int"


def _pieces(kind: int, h, sure, enters, leaves, kid, tag, first, n, src_kid=None, src_first=None) -> pa.RecordBatch:
    size = len(kid)
    arrays = [pa.array(np.full(size, kind, np.int32))]
    arrays += [pa.array(np.asarray(x).view(np.int64)) if x is not None else pa.nulls(size, pa.int64()) for x in (h, sure, enters, leaves)]
    arrays += [pa.array(np.asarray(kid, np.int64)), pa.array(np.asarray(tag, np.int32)), pa.array(np.asarray(first, np.int32)), pa.array(np.asarray(n, np.int32))]
    arrays += [pa.array(src_kid) if src_kid is not None else pa.nulls(size, pa.int64()), pa.array(np.asarray(src_first, np.int32)) if src_first is not None else pa.nulls(size, pa.int32())]
    return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in _PIECE.split(", ")])


def _fold_edges(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Of a task's equal edges the first goes on; runs of later ones are told with their source."""
    h, sure, enters, leaves, kid, tag, first = (np.concatenate([x[i] for x in held]) for i in range(7))
    order = np.lexsort((first, kid, sure, h))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (sure[order][1:] != sure[order][:-1])]
    head = order[np.flatnonzero(new)]
    lead = np.empty(len(h), np.int64)
    lead[order] = np.repeat(head, np.diff(np.r_[np.flatnonzero(new), len(h)]))
    later = np.flatnonzero((kid != kid[lead]) | (first != first[lead]))
    yield _pieces(EDGE, *(x[head] for x in (h, sure, enters, leaves, kid, tag, first)), np.ones(len(head)))
    if len(later):
        later = later[np.lexsort((first[later], tag[later], kid[later]))]
        k, t, f, sk, sf = kid[later], tag[later], first[later], kid[lead[later]], first[lead[later]]
        go = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (f[1:] != f[:-1] + 1) | (sk[1:] != sk[:-1]) | (sf[1:] != sf[:-1] + 1)])
        n = f[np.r_[go[1:] - 1, len(f) - 1]] - f[go] + 1
        spread = mix(k[go].view(np.uint64) + f[go].astype(np.uint64))
        yield _pieces(LATER, spread, None, None, None, k[go], t[go], f[go], n, sk[go], sf[go])


def _pairs(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs or []), "<i4").reshape(-1, 2).astype(np.int64)


def _expand(f: Blocks, at: np.ndarray, n: np.ndarray) -> tuple:
    """Hashes, checks and end nodes of the runs of ``n`` windows that begin at words ``at`` (of the whole buffer)."""
    end = at + n - 1 + K
    return f.hash.of(at, end), f.check.of(at, end), f.hash.of(at, at + K - 1), f.hash.of(end - K + 1, end)


def _unpacked(docs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the documents of :func:`_word_batches`."""
    undo = zstandard.ZstdDecompressor().decompress
    raw = [undo(d) for d in docs.to_pylist()]
    return np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64), np.frombuffer(b"".join(raw), np.uint8)


def _portions(sizes: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    yield from slices(np.r_[0, np.cumsum(sizes)].astype(np.int64), most)


@lean
def _edge_batches(batches: Iterator[pa.RecordBatch], fold_edges: int) -> Iterator[pa.RecordBatch]:
    """The single edges of open blocks, and the sources of repeated blocks."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        kid, tag = batch.column("kid").to_numpy(), batch.column("tag").to_numpy()
        opened, sources = batch.column("opened").to_pylist(), batch.column("sources").to_pylist()
        for a, b in _portions(batch.column("size").to_numpy()):
            offsets, data = _unpacked(batch.column("doc").slice(a, b - a))
            words = Words(offsets, data, _TABLE)
            values = words.hashes(data)
            f = _Hashes(RunHash(values), RunHash(mix(values ^ _SECOND)))
            for kind, wanted in ((EDGE, opened), (PATH, sources)):
                pairs = [_pairs(wanted[i]) for i in range(a, b)]
                doc = np.repeat(np.arange(b - a), [len(p) for p in pairs])
                first, last = np.concatenate(pairs).T
                if kind == EDGE:  # every window for itself
                    n = last - first + 1
                    doc, first = np.repeat(doc, n), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    n = np.ones(len(first), np.int64)
                else:
                    n = last - first + 1
                if not len(first):
                    continue
                found = _expand(f, words.edges[doc] + first, n)
                if kind == PATH:
                    yield _pieces(PATH, *found, kid[a + doc], tag[a + doc], first, n)
                else:
                    held.append((*found, kid[a + doc], tag[a + doc], first))
                    size += len(first)
            if size >= fold_edges:
                yield from _fold_edges(held)
                held, size = [], 0
    if held:
        yield from _fold_edges(held)


class _Hashes:
    def __init__(self, hash_: RunHash, check: RunHash):
        self.hash, self.check = hash_, check


# ---------------------------------------------------------------- compaction


def repeated_pieces(pieces: DataFrame) -> DataFrame:
    """Repeated single edges and blocks with is_source and their source (src_kid, src_first, src_sure); runs of later edges pass."""
    by_edge = Window.partitionBy("kind", "h").orderBy("kid", "first", "tag")  # a row a task at most
    out = pieces.withColumns({
        "same": F.lead(F.lit(True)).over(by_edge), "at_kid": F.first("kid").over(by_edge), "at_first": F.first("first").over(by_edge), "src_sure": F.first("sure").over(by_edge),
    })
    single = F.col("kind") != LATER
    out = out.withColumns({"src_kid": F.when(single, F.col("at_kid")).otherwise(F.col("src_kid")), "src_first": F.when(single, F.col("at_first")).otherwise(F.col("src_first"))})
    out = out.withColumn("is_source", single & (F.col("kid") == F.col("src_kid")) & (F.col("first") == F.col("src_first")))
    return out.where((F.col("kind") != EDGE) | F.col("same") | ~F.col("is_source")).drop("same", "at_kid", "at_first")


def paths(pieces: DataFrame) -> DataFrame:
    """(h, path) of every repeated piece; path: the smallest piece of its nonbranching path."""
    graph = pieces.where("is_source").select("h", "enters", "leaves", "kid", "tag", "first", "n").dropDuplicates(["h"])
    ends = graph.select(F.col("enters").alias("node"), F.col("h").alias("out"), F.lit(None).cast("long").alias("into")).unionAll(
        graph.select(F.col("leaves").alias("node"), F.lit(None).cast("long").alias("out"), F.col("h").alias("into")))
    links = ends.groupBy("node").agg(F.count("out").alias("n_out"), F.count("into").alias("n_in"), F.max("out").alias("next"), F.max("into").alias("h"))
    links = links.where("n_out = 1 and n_in = 1").select("h", "next")
    linked = graph.join(links, "h", "left").checkpoint()
    # along the source document first: the next piece there is mostly the next of the path
    along = Window.partitionBy("kid", "tag").orderBy("first", "h")
    joined = (F.lag("next").over(along) == F.col("h")) & (F.lag(F.col("first") + F.col("n")).over(along) == F.col("first"))
    runs = linked.withColumn("head", F.when(F.coalesce(joined, F.lit(False)), F.lit(None)).otherwise(F.col("h")))
    runs = runs.select("h", "next", F.last("head", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("run")).checkpoint()
    across = runs.where("next is not null").select("run", F.col("next").alias("h")).join(runs.select("h", F.col("run").alias("to")), "h")
    found = components(across.where("run <> to").select(F.col("run").alias("a"), F.col("to").alias("b")))
    return runs.select("h", "run").join(found.select(F.col("node").alias("run"), "component"), "run", "left").select("h", F.coalesce("component", "run").alias("path"))


def spans(pieces: DataFrame) -> DataFrame:
    """(kid, tag, first, end, path, src_kid, src_first): long repeated spans of words, verified against their source.

    path is null for runs that repeat earlier text of the same task.
    """
    sure = (F.col("kind") == LATER) | (F.col("sure") == F.col("src_sure"))
    gone = pieces.where(~F.col("is_source") & (F.col("kind") != PATH) & sure).select("kind", "h", "kid", "tag", "first", "n", "src_kid", "src_first")
    known = paths(pieces).withColumn("kind", F.lit(EDGE))
    gone = gone.join(known, ["kind", "h"], "left")
    place = Window.partitionBy("kid", "tag").orderBy("first", "n")
    follows = (
        (F.lag(F.col("first") + F.col("n")).over(place) == F.col("first")) & F.lag("path").over(place).eqNullSafe(F.col("path"))
        & (F.lag("src_kid").over(place) == F.col("src_kid")) & (F.lag(F.col("src_first") + F.col("n")).over(place) == F.col("src_first"))
    )
    gone = gone.withColumn("new", (~F.coalesce(follows, F.lit(False))).cast("int"))
    gone = gone.withColumn("number", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return gone.groupBy("kid", "tag", "number").agg(
        F.min("first").alias("first"), F.max(F.col("first") + F.col("n") + (K - 1)).alias("end"), F.first("path").alias("path"),
        F.first("src_kid").alias("src_kid"), F.min("src_first").alias("src_first"),
    ).drop("number")


# ---------------------------------------------------------------- the operator


def _tag(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


@lean
def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as their words with one space between, compressed for the exchange."""
    for batch in batches:
        for a in range(0, len(batch), 500):
            part = batch.slice(a, 500)
            raw = [t.encode() for t in part.column("text").to_pylist()]
            press = zstandard.ZstdCompressor(level=3).compress
            docs = [b" ".join(r.split()) if r else b"" for r in raw]  # bytes split at the six white spaces
            sizes = np.array([len(d) for d in docs], np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("kid"), part.column("tag"), pa.array(sizes), pa.array([press(d) for d in docs], pa.binary())],
                ["doc_id", "kid", "tag", "size", "doc"],
            )


@lean
def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blobs, firsts, lasts = (batch.column(c).to_pylist() for c in ("blobs", "firsts", "lasts"))
        for a, b in _portions(batch.column("size").to_numpy(), 4 << 20):
            offsets, data = _unpacked(batch.column("doc").slice(a, b - a))
            words = Words(offsets, data, _TABLE)
            begin, n = words.edges[:-1], np.diff(words.edges)
            cover = np.zeros(len(words) + 1, np.int64)
            for i in range(a, b):
                pairs = _pairs(blobs[i])
                np.add.at(cover, begin[i - a] + np.r_[pairs[:, 0], np.array(firsts[i] or [], np.int64)], 1)
                np.subtract.at(cover, begin[i - a] + np.r_[pairs[:, 1], np.array(lasts[i] or [], np.int64)] + K, 1)
            gone = np.cumsum(cover)[:-1] > 0
            removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), words.edges[:-1])
            removed[n == 0] = 0
            raw, kept = data.tobytes(), []
            for i in range(b - a):
                text = raw[offsets[i]: offsets[i + 1]]
                if removed[i]:
                    at = np.flatnonzero(~gone[begin[i]: begin[i] + n[i]]) + begin[i]
                    text = b" ".join([raw[s:e] for s, e in zip(words.start[at].tolist(), words.end[at].tolist())])
                kept.append(text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(kept, pa.string()), pa.array(n), pa.array(removed)], ["doc_id", "kept", "n_words", "n_removed"]
            )


def _stages(docs: DataFrame, pack_bytes: int, fold_edges: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents by words (doc_id, kid, tag, size, doc), settled blocks and repeated pieces, the last two written."""
    spark = prepare(docs.sparkSession)
    buckets = max(8, shuffle_partitions(spark))  # a bucket is settled whole: the setting follows the data
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = text_or_empty()
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("kid"), _tag(text).alias("tag"), text.alias("text"))
    packed = keyed.select("kid", "tag", "text").mapInArrow(lambda b: _pack_batches(b, buckets, pack_bytes), _ROW)
    settled = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _settle_batches(b, buckets), _ROW).checkpoint()
    worded = keyed.mapInArrow(_word_batches, f"doc_id {kind}, kid long, tag int, size long, doc binary")
    blobs = {k: F.collect_list(F.when(F.col("kind") == k, F.col("blob"))) for k in (OPEN, SOURCE)}
    asked = settled.where(F.col("kind").isin(OPEN, SOURCE)).groupBy("kid", "tag").agg(blobs[OPEN].alias("opened"), blobs[SOURCE].alias("sources"))
    found = worded.join(asked, ["kid", "tag"]).select("kid", "tag", "size", "doc", "opened", "sources").mapInArrow(lambda b: _edge_batches(b, fold_edges), _PIECE)
    return worded, settled, repeated_pieces(found).checkpoint()


def deduplicate(docs: DataFrame, pack_bytes: int = PACK_BYTES, fold_edges: int = FOLD_EDGES) -> DataFrame:
    """doc_id, kept (the remaining words with one space between), n_words and n_removed of every row of ``docs``."""
    worded, settled, pieces = _stages(docs, pack_bytes, fold_edges)
    none = F.lit(None).cast("int")
    by_block = settled.where(F.col("kind") == GONE).select("kid", "tag", "blob", none.alias("first"), none.alias("last"))
    by_edge = spans(pieces).select("kid", "tag", F.lit(None).cast("binary").alias("blob"), "first", (F.col("end") - K).cast("int").alias("last"))
    gone = by_block.unionAll(by_edge).groupBy("kid", "tag").agg(
        F.collect_list("blob").alias("blobs"), F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return worded.join(gone, ["kid", "tag"], "left").select("doc_id", "size", "doc", "blobs", "firsts", "lasts").mapInArrow(
        _kept_batches, f"doc_id {kind}, kept string, n_words long, n_removed long"
    )


def repeated_spans(docs: DataFrame, pack_bytes: int = PACK_BYTES, fold_edges: int = FOLD_EDGES) -> DataFrame:
    """:func:`spans` over ``docs``: those found edge by edge, with path and source. Whole repeated blocks are in :func:`deduplicate` alone."""
    return spans(_stages(docs, pack_bytes, fold_edges)[2])


def op12_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op12_de_bruijn_dedup": op12_de_bruijn}
