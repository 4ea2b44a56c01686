"""Exact substring deduplication by suffix sorting (deep-shallow).

A byte is removed if some MATCH-byte string that covers it also starts earlier: in a smaller
doc_id, or in the same document before. Strings are judged on the input. Sorting every suffix
of a corpus is out of reach, so candidates are found first and only their suffixes are sorted:

1. *Anchors.* In each window of MATCH bytes the GRAM-byte string with the least hash (leftmost
   of equals) is the window's anchor: equal windows have equal anchors at equal offsets.
   Successive windows with one anchor form a block, about one block in 35 bytes.
   Blocks are packed by bucket of their anchor's hash. Within a task, a block equal to an
   earlier one is already known to be removed, so only the first of equals is sent on.
2. *Buckets.* Blocks whose anchor occurs once are done. Of equal blocks all but the first are
   removed. The first blocks of an anchor that has several different blocks are open.
3. *Suffix sort.* Open blocks go out again with their bytes. In each bucket the suffixes at
   all window starts are sorted to depth MATCH: a multikey quicksort by eight-byte keys to
   the depth SHALLOW, then blind tries for the groups that still agree, which compare a group
   with one member, skip its common prefix and branch on a single byte. All groups' tries
   grow together, level by level, in numpy. Of equal windows all but the first are removed.
4. Removed spans are gathered by document and applied.

Repeated rows with one doc_id: equal places (doc_id, start) are one occurrence and do not
remove each other. A null doc_id sorts before all others. Null text counts as empty; texts
shorter than MATCH stay whole. Empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from venuelens.llm.common import PrefixHash, carry, doc_of, documents, flat, lean, mix, prepare, restored, shuffle_partitions, slices, text_or_empty, widened

MATCH = 100
GRAM = 32
SPAN = MATCH - GRAM + 1
SHALLOW = 24
#: A task packs the blocks of so many bytes of text at once, and sorts so many windows at once.
PACK_BYTES = 24 << 20
SORT_WINDOWS = 1 << 20

_LEAST = -(2**63)


# ---------------------------------------------------------------- blocks

def blocks(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The blocks of flat documents: row, first and last window start (in the document), anchor's place in the
    first window, hashes of the anchor and of the block."""
    empty = np.zeros(0, np.int64)
    if len(data) < MATCH:
        return {k: empty for k in ("row", "first", "last", "off")} | {k: np.zeros(0, np.uint64) for k in ("anchor", "block")}
    hashes = PrefixHash(data)
    grams = mix(hashes.windows(GRAM))
    mask = np.uint64((1 << int(len(data)).bit_length()) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width:])
    at = (least & mask).astype(np.int64)
    owner = doc_of(offsets)[: len(at)]
    start = np.flatnonzero(np.arange(len(at)) + MATCH <= offsets[1:][owner])
    if not len(start):
        return {k: empty for k in ("row", "first", "last", "off")} | {k: np.zeros(0, np.uint64) for k in ("anchor", "block")}
    at = at[start]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    first, last, anchor = start[new], start[np.r_[new[1:] - 1, len(start) - 1]], at[new]
    row = owner[first]
    shape = ((last - first) * MATCH + (anchor - first)).astype(np.uint64)
    return {
        "row": row, "first": first - offsets[row], "last": last - offsets[row], "off": anchor - first,
        "anchor": grams[anchor], "block": mix(hashes.of(first, last + MATCH) + mix(shape + np.uint64(1))),
    }


def _bytes(x: np.ndarray, n: int) -> np.ndarray:
    """The lowest n bytes of each uint64, flat."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).ravel()


def _wide(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(x) // n, 8), np.uint8)
    out[:, :n] = x.reshape(-1, n)
    return out.view("<u8").ravel()


def _pack(arrays: list[np.ndarray]) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    body = sizes.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(body, np.int64, len(kinds))
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def _spans_by_document(kid: np.ndarray, tag: np.ndarray, first: np.ndarray, end: np.ndarray, extra: int, bucket: int) -> pa.RecordBatch | None:
    """One row a document (kid, tag) with its pairs (first, end) as packed int32."""
    if not len(kid):
        return None
    order = np.lexsort((first, tag, kid))
    kid, tag = kid[order], tag[order]
    begin = np.flatnonzero(np.r_[True, (kid[1:] != kid[:-1]) | (tag[1:] != tag[:-1])])
    pairs = np.stack([first[order], end[order]], 1).astype("<i4")
    ends = (np.r_[begin, len(kid)] * 8).astype(np.int32)
    blob = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pairs.tobytes())])
    n = len(begin)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, bucket, np.int32)), pa.array(np.full(n, extra, np.int32)), pa.array(kid[begin]), pa.array(tag[begin]), blob], _ROW_NAMES
    )


_ROW = "bucket int, kind int, kid long, tag int, blob binary"
_ROW_NAMES = ["bucket", "kind", "kid", "tag", "blob"]
#: kinds of rows: packed blocks, removed spans, open blocks of a document, packed open blocks
PACKED, REMOVED, OPEN, TEXTS = 0, 1, 2, 3

_BLOCK_KINDS = [np.int64, np.int32, np.int32, np.int32, np.uint8, np.uint8, np.uint8]


def _packed_rows(kid: np.ndarray, tag: np.ndarray, found: dict[str, np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of one pack: the first of equal blocks by bucket, the rest as removed spans."""
    place = np.lexsort((found["first"], kid[found["row"]], found["block"], found["anchor"]))
    f = {k: v[place] for k, v in found.items()}
    k = kid[f["row"]]
    same = np.r_[False, (f["anchor"][1:] == f["anchor"][:-1]) & (f["block"][1:] == f["block"][:-1])]
    head = np.flatnonzero(~same)
    lead = np.repeat(head, np.diff(np.r_[head, len(k)]))
    gone = same & ((k != k[lead]) | (f["first"] != f["first"][lead]))
    bucket = (f["anchor"] >> np.uint64(40)) % np.uint64(buckets)
    out = _spans_by_document(k[gone], tag[f["row"][gone]], f["first"][gone], f["last"][gone] + MATCH, REMOVED, int(kid[0] % buckets) if len(kid) else 0)
    if out is not None:
        yield out
    sent = np.flatnonzero(~same)
    sent = sent[np.lexsort((f["first"][sent], f["row"][sent], bucket[sent]))]
    bucket = bucket[sent]
    edge = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        at = sent[edge[b]: edge[b + 1]]
        if len(at):
            rows, n = np.unique(f["row"][at], return_counts=True)
            blob = _pack([
                kid[rows], tag[rows], n.astype(np.int32), np.diff(f["first"][at], prepend=0).astype(np.int32),
                (f["last"][at] - f["first"][at]).astype(np.uint8), _bytes(f["anchor"][at], 5), _bytes(f["block"][at], 6),
            ])
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([PACKED], pa.int32()), pa.array([0], pa.int64()), pa.array([0], pa.int32()), pa.array([blob], pa.binary())], _ROW_NAMES
            )


@lean
def _block_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    rows = size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            kid, tag = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            found = {k: np.concatenate([h[2][k] for h in held]) for k in held[0][2]}
            if len(found["row"]):
                yield from _packed_rows(kid, tag, found, buckets)

    for batch in batches:
        offsets, data = flat(batch.column("text"))
        kid, tag = batch.column("kid").to_numpy(), batch.column("tag").to_numpy()
        for a, b in slices(offsets):
            found = blocks(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]])
            found["row"] = found["row"] + rows
            found.pop("off")
            held.append((kid[a:b], tag[a:b], found))
            rows += b - a
        size += len(data)
        if size >= PACK_BYTES:
            yield from flush()
            held.clear()
            rows = size = 0
    yield from flush()


# ---------------------------------------------------------------- buckets

def _settle(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Removed spans and open blocks of one bucket's packed blocks."""
    parts = [_unpack(b, _BLOCK_KINDS) for b in blobs]
    kid = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
    tag = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
    first = np.concatenate([np.cumsum(p[3], dtype=np.int64) for p in parts])
    span = np.concatenate([p[4] for p in parts]).astype(np.int64)
    anchor = _wide(np.concatenate([p[5] for p in parts]), 5)
    block = _wide(np.concatenate([p[6] for p in parts]), 6)
    del parts
    order = np.argsort(anchor)
    ranked = anchor[order]
    same = ranked[1:] == ranked[:-1]
    order = order[np.r_[same, False] | np.r_[False, same]]
    order = order[np.lexsort((first[order], kid[order], block[order], anchor[order]))]
    kid, tag, first, span, anchor, block = (x[order] for x in (kid, tag, first, span, anchor, block))
    if not len(kid):
        return
    new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
    new_block = new_anchor | np.r_[True, block[1:] != block[:-1]]
    head = np.flatnonzero(new_block)
    lead = np.repeat(head, np.diff(np.r_[head, len(kid)]))
    gone = ~new_block & ((kid != kid[lead]) | (first != first[lead]))
    blocks_of_anchor = np.add.reduceat(new_block.astype(np.int64), np.flatnonzero(new_anchor))
    several = np.repeat(blocks_of_anchor > 1, np.diff(np.r_[np.flatnonzero(new_anchor), len(kid)]))
    for rows, end, kind in ((gone, first + span + MATCH, REMOVED), (new_block & several, first + span, OPEN)):
        out = _spans_by_document(kid[rows], tag[rows], first[rows], end[rows], kind, 0)
        if out is not None:
            yield out


@lean
def _settle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (kind, bucket): packed blocks bucket by bucket, then removed spans, which pass."""
    blobs: list[bytes] = []
    current = None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        passed = np.flatnonzero(kind == REMOVED)
        if len(passed):
            yield batch.take(pa.array(passed))
        for i in np.flatnonzero(kind == PACKED).tolist():
            bucket = batch.column("bucket")[i].as_py()
            if bucket != current and blobs:
                yield from _settle(blobs)
                blobs = []
            current = bucket
            blobs.append(batch.column("blob")[i].as_py())
    if blobs:
        yield from _settle(blobs)


# ---------------------------------------------------------------- suffix sort

def _words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place of a buffer that ends in eight spare bytes, big-endian."""
    return np.ndarray(shape=(len(data) - 8,), dtype=">u8", buffer=data.data, strides=(1,))


def _regroup(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, key) without the members that stand alone, and their new groups (sorted, from 0)."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (k[1:] != k[:-1])]
    many = ~(new & np.r_[new[1:], True])
    return order[many], np.cumsum(new)[many]


_BYTE_BOUNDS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def leading_zero_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes of each nonzero value are zero before the first that is not (big-endian)."""
    return 7 - np.searchsorted(_BYTE_BOUNDS, x, side="right")


def equal_windows(data: np.ndarray, place: np.ndarray, group: np.ndarray, length: int = MATCH) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the ``length``-byte strings at ``place`` inside each ``group``; the members of classes of two or more
    equal strings, class by class in order, and their class.

    ``data`` ends in eight spare bytes; every string lies before them.
    """
    words = _words(data)
    members = np.arange(len(place))
    for depth in range(0, min(SHALLOW, length), 8):  # multikey quicksort
        if not len(members):
            break
        key = words[place[members] + depth].astype(np.uint64)
        if length - depth < 8:
            key >>= np.uint64(8 * (8 - (length - depth)))
        order, group = _regroup(group, key)
        members = members[order]
    depth = np.full(len(members), min(SHALLOW, length))
    done, classes, number = [], [], 0
    while len(members):  # blind tries, one level a round
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[head, len(group)])
        mine, other = place[members], np.repeat(place[members[head]], size)
        agree = np.full(len(members), length)
        open_, at = np.arange(len(members)), depth.copy()
        open_ = open_[at < length]
        while len(open_):
            differ = words[mine[open_] + at[open_]].astype(np.uint64) ^ words[other[open_] + at[open_]].astype(np.uint64)
            hit = differ != 0
            agree[open_[hit]] = np.minimum(at[open_[hit]] + leading_zero_bytes(differ[hit]), length)
            open_ = open_[~hit]
            at[open_] += 8
            open_ = open_[at[open_] < length]
        common = np.minimum.reduceat(agree, head)
        whole = np.repeat(common >= length, size)
        if whole.any():
            kept = group[whole]
            rank = np.cumsum(np.r_[True, kept[1:] != kept[:-1]]) - 1
            done.append(members[whole])
            classes.append(rank + number)
            number += int(rank[-1]) + 1
        skip = np.repeat(common, size)[~whole]
        members, group = members[~whole], group[~whole]
        if not len(members):
            break
        order, new_group = _regroup(group, data[place[members] + skip])
        members, group, depth = members[order], new_group, skip[order] + 1
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(done), np.concatenate(classes)


_TEXT_KINDS = [np.int64, np.int32, np.int32, np.uint8, np.uint8, np.uint64, np.uint8]


def _sort_blocks(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Removed spans of one bucket's open blocks."""
    kid, tag, first, span, off, anchor = (np.concatenate([p[i] for p in parts]).astype(np.int64 if i < 5 else np.uint64) for i in range(6))
    data = np.concatenate([p[6] for p in parts] + [np.zeros(8, np.uint8)])
    start = np.r_[0, np.cumsum(span + MATCH)]
    order = np.argsort(anchor, kind="stable")
    weight = np.cumsum((span + 1)[order])
    new = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]])
    ends = np.r_[new[1:], len(order)]
    gone: list[np.ndarray] = []

    def run(rows: np.ndarray, step: np.ndarray) -> None:
        """Windows: block ``rows``, window ``step`` within the block."""
        group = np.unique(anchor[rows], return_inverse=True)[1].astype(np.int64) * (SPAN + 1) + (off[rows] - step)
        members, classes = equal_windows(data, start[rows] + step, group)
        if len(members):
            r, w = rows[members], (first[rows] + step)[members]
            by = np.lexsort((w, kid[r], classes))
            r, w, c = r[by], w[by], classes[by]
            head = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            lead = np.repeat(head, np.diff(np.r_[head, len(c)]))
            later = (kid[r] != kid[r[lead]]) | (w != w[lead])
            gone.append(np.stack([kid[r[later]], tag[r[later]], w[later]]))

    at = 0
    while at < len(new):
        base = weight[new[at]] - (span + 1)[order[new[at]]]
        to = max(at + 1, int(np.searchsorted(weight[ends - 1], base + SORT_WINDOWS, side="right")))
        rows = order[new[at]: ends[to - 1]]
        if to == at + 1 and weight[ends[at] - 1] - base > SORT_WINDOWS:
            for o in range(SPAN):  # a hot anchor: equal windows have it at equal places
                has = rows[(off[rows] - o >= 0) & (off[rows] - o <= span[rows])]
                if len(has):
                    run(has, off[has] - o)
        else:
            n = span[rows] + 1
            run(np.repeat(rows, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        at = to
    if not gone:
        return
    k, t, w = np.concatenate(gone, axis=1)
    by = np.lexsort((w, t, k))
    k, t, w = k[by], t[by], w[by]
    new = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (w[1:] > w[:-1] + 1)])
    last = w[np.r_[new[1:] - 1, len(w) - 1]]
    out = _spans_by_document(k[new], t[new].astype(np.int32), w[new], last + MATCH, REMOVED, 0)
    if out is not None:
        yield out


@lean
def _sort_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list = []
    current = None
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
            if bucket != current and parts:
                yield from _sort_blocks(parts)
                parts = []
            current = bucket
            parts.append(_unpack(blob, _TEXT_KINDS))
    if parts:
        yield from _sort_blocks(parts)


def _pairs(blobs: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(blobs or []), "<i4").reshape(-1, 2).astype(np.int64)


@lean
def _open_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The open blocks of each document with their bytes, packed by bucket."""
    for batch in batches:
        offsets, data = flat(batch.column("text"))
        kid, tag, wanted = batch.column("kid").to_numpy(), batch.column("tag").to_numpy(), batch.column("blobs").to_pylist()
        for a, b in slices(offsets):
            found = blocks(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]])
            key = found["row"] << 40 | found["first"]
            pairs = [_pairs(wanted[i]) for i in range(a, b)]
            ask = np.concatenate([(np.int64(i) << 40) | p[:, 0] for i, p in enumerate(pairs)]) if pairs else np.zeros(0, np.int64)
            at = np.flatnonzero(np.isin(key, ask))
            bucket = (found["anchor"][at] >> np.uint64(40)) % np.uint64(buckets)
            at = at[np.argsort(bucket, kind="stable")]
            edge = np.searchsorted(np.sort(bucket), np.arange(buckets + 1, dtype=np.uint64))
            for i in range(buckets):
                r = at[edge[i]: edge[i + 1]]
                if not len(r):
                    continue
                row, first, last = found["row"][r], found["first"][r], found["last"][r]
                size = last - first + MATCH
                begin = offsets[a + row] + first
                where = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
                blob = _pack([
                    kid[a + row], tag[a + row], first.astype(np.int32), (last - first).astype(np.uint8), found["off"][r].astype(np.uint8),
                    found["anchor"][r], data[where],
                ])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([TEXTS], pa.int32()), pa.array([0], pa.int64()), pa.array([0], pa.int32()), pa.array([blob], pa.binary())], _ROW_NAMES
                )


# ---------------------------------------------------------------- the operator

def _kid() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST))


def _tag(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the rest of ``docs`` with kid and tag; whole, so that both joins below share one exchange of the documents."""
    return carry(docs, "doc_id", "text").withColumns({"kid": _kid(), "tag": _tag(text_or_empty())})


def removed(keyed: DataFrame) -> DataFrame:
    """(kid, tag, blobs): packed (start, end) byte spans to remove, by document of ``keyed(doc_id, text, rest, kid, tag)``;
    documents that stay whole are absent."""
    spark = prepare(keyed.sparkSession)
    buckets = max(8, shuffle_partitions(spark))  # a bucket is sorted whole: the setting follows the data
    packed = keyed.select("kid", "tag", text_or_empty().alias("text")).mapInArrow(lambda b: _block_batches(b, buckets), _ROW)
    settled = packed.repartition("bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_settle_batches, _ROW).checkpoint()
    open_ = settled.where(F.col("kind") == OPEN).groupBy("kid", "tag").agg(F.collect_list("blob").alias("blobs"))
    texts = keyed.join(open_, ["kid", "tag"]).mapInArrow(lambda b: _open_batches(b, buckets), _ROW)
    sorted_ = texts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sort_batches, _ROW)
    gone = settled.where(F.col("kind") == REMOVED).unionAll(sorted_)
    return gone.groupBy("kid", "tag").agg(F.collect_list("blob").alias("blobs"))


def _cut(text: np.ndarray, blobs: list[bytes] | None) -> tuple[bytes, int, int]:
    """(kept bytes, bytes removed, maximal runs removed)."""
    pairs = _pairs(blobs)
    if not len(pairs):
        return text.tobytes(), 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, pairs[:, 0], 1)
    np.subtract.at(edge, pairs[:, 1], 1)
    out = np.cumsum(edge)[:-1] > 0
    return text[~out].tobytes(), int(out.sum()), int((out & ~np.r_[False, out[:-1]]).sum())


def _apply(docs: DataFrame) -> DataFrame:
    """doc_id, text, rest, kept (binary: the remaining bytes), n_bytes, n_removed and n_spans of every row of ``docs``."""
    keyed = _keyed(docs)
    names = ["doc_id", "text", "rest"]
    joined = keyed.join(removed(keyed), ["kid", "tag"], "left").select(*names, "kid", "tag", "blobs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = flat(batch.column("text"))
            cut = [_cut(data[offsets[i]: offsets[i + 1]], b) for i, b in enumerate(batch.column("blobs").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array([c[0] for c in cut], pa.binary()), pa.array(np.diff(offsets)),
                 pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64())],
                [*names, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return joined.mapInArrow(run, widened(keyed.select(*names).schema, kept="binary", n_bytes="long", n_removed="long", n_spans="long"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, kept (binary: the remaining bytes), n_bytes, n_removed and n_spans of every row of ``docs``."""
    return _apply(docs.select("doc_id", "text")).select("doc_id", "kept", "n_bytes", "n_removed", "n_spans")


def strip(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages cut out of text; n_chars, where there is one, follows.

    A cut may fall inside a character; its remaining bytes are dropped.
    """
    out = _apply(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if t is None else (t if not n else k.decode("utf-8", "ignore"))
                for t, k, n in zip(batch.column("text").to_pylist(), batch.column("kept").to_pylist(), batch.column("n_removed").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("rest"), batch.column("n_removed")], ["doc_id", "text", "rest", "n_removed"]
            )

    short = StructType([f for f in out.schema.fields if f.name in ("doc_id", "text", "rest", "n_removed")])
    done = out.mapInArrow(run, short)
    columns = restored(docs, ("doc_id", "text"))
    if "n_chars" in docs.columns:
        old = F.col("rest").getField("n_chars")
        new = F.when(F.col("n_removed") == 0, old).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)).alias("n_chars")
        columns = [new if name == "n_chars" else c for name, c in zip(docs.columns, columns)]
    return done.select(columns)


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op2_suffix_dedup": op2_suffix}
