"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint holds 64 majority bits over the XXH64 hashes of a text's 4-word shingles.
Two fingerprints link at 4 or fewer differing bits; groups are the connected components.

Candidates. A fingerprint is cut into segments of 22, 21 and 21 bits, each read as a
23-bit word of the perfect binary Golay code (23, 12). The *indices* of a segment are the
12-bit messages of all codewords within distance 4 of it: one if it lies within 2 of a
codeword, else six. Two segments that differ in at most 2 bits share an index: the
codeword nearest to a word between them is within 3 + 1 of both. Spread of 4 errors:

* at most 2 in every segment: one index of each of the three segments agrees (36 bits);
* else one segment has 3 or more, so the other two have at most 1 together: one of them
  agrees exactly and the other shares an index (33 or 34 bits, six such keys' kinds).

So the keys miss no pair, and each key is selective. Only distinct fingerprints get keys
(copies are grouped before). Rows are dealt by key and sorted; a task streams through
them, holds the last few rows of the current key only, and verifies each row against them
and against the key's first row. A pair is reported under the first of its common keys alone.
Keys with more rows than that get a second pass: rows
of keys that still span several components are joined with the rows outside the key's
largest component, so rows already linked are never paired with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm.common import carry, documents, lean, prepare, restored
from venuelens.llm.components import components

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: Rows of a key that each row is compared with while streaming; keys with more rows get the second pass.
WINDOW = 16

_GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= _GENERATOR << (bit - 11)
    return v


def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of the upper 12 bits, error patterns of weight <= 4 by syndrome, their number)."""
    high = np.array([_remainder(m << 11) for m in range(4096)], np.uint32)
    unit = [_remainder(1 << i) for i in range(23)]
    found: list[list[int]] = [[] for _ in range(2048)]

    def grow(start: int, error: int, syndrome: int, left: int) -> None:
        found[syndrome].append(error)
        if left:
            for i in range(start, 23):
                grow(i + 1, error | 1 << i, syndrome ^ unit[i], left - 1)

    grow(0, 0, 0, 4)
    errors = np.zeros((2048, 6), np.uint32)
    counts = np.array([len(x) for x in found])
    for s, patterns in enumerate(found):
        errors[s, : len(patterns)] = patterns
    return high, errors, counts


_TABLES: list = []


def indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n x 6 message indices of the codewords within distance 4, which of them count)."""
    if not _TABLES:
        _TABLES.extend(_golay())
    high, errors, counts = _TABLES
    words = words.astype(np.uint32)
    syndrome = high[words >> 11] ^ (words & 0x7FF)
    messages = (words[:, None] ^ errors[syndrome]) >> 11
    return messages.astype(np.int64), np.arange(6)[None, :] < counts[syndrome][:, None]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) of every key of ``prints`` (uint64)."""
    segments = [(prints >> np.uint64(42)), (prints >> np.uint64(21)) & np.uint64(0x1FFFFF), prints & np.uint64(0x1FFFFF)]
    segments = [s.astype(np.int64) for s in segments]
    index, valid = zip(*(indices(s) for s in segments))
    n = len(prints)
    triple = (index[0][:, :, None, None] << 24) | (index[1][:, None, :, None] << 12) | index[2][:, None, None, :]
    use = valid[0][:, :, None, None] & valid[1][:, None, :, None] & valid[2][:, None, None, :]
    at = np.broadcast_to(np.arange(n)[:, None, None, None], use.shape)
    rows, keys = [at[use]], [triple[use]]
    kind = 1
    for i in range(3):
        for j in range(3):
            if i != j:
                key = (np.int64(kind) << 40) | (segments[i][:, None] << 12) | index[j]
                rows.append(np.broadcast_to(np.arange(n)[:, None], key.shape)[valid[j]])
                keys.append(key[valid[j]])
                kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def _least_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index that the i-th words of x and y share, or -1."""
    (a, va), (b, vb) = indices(x), indices(y)
    same = (a[:, :, None] == b[:, None, :]) & va[:, :, None] & vb[:, None, :]
    shared = np.where(same, a[:, :, None], 4096).min((1, 2))
    return np.where(shared < 4096, shared, -1)


def first_common_key(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest key that the fingerprints x[i] and y[i] (uint64) share, or -1."""
    cut = [[(v >> np.uint64(42)).astype(np.int64), (v >> np.uint64(21) & np.uint64(0x1FFFFF)).astype(np.int64), (v & np.uint64(0x1FFFFF)).astype(np.int64)] for v in (x, y)]
    least = [_least_common(cut[0][i], cut[1][i]) for i in range(3)]
    out = np.where((least[0] >= 0) & (least[1] >= 0) & (least[2] >= 0), least[0] << 24 | least[1] << 12 | least[2], -1)
    kind = 1
    for i in range(3):
        for j in range(3):
            if i != j:
                fits = (out < 0) & (cut[0][i] == cut[1][i]) & (least[j] >= 0)
                out = np.where(fits, np.int64(kind) << 40 | cut[0][i] << 12 | least[j], out)
                kind += 1
    return out


_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)
_PLACE = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The unsigned fingerprint of a UTF-8 text; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = len(words) - SHINGLE_WORDS + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[:last].tolist(), ends[SHINGLE_WORDS - 1:].tolist())]
    octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(_PLACE[2 * ones > len(hashes)].sum(dtype=np.uint64)) if len(hashes) else 0


@lean
def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        prints = np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_print_batches, f"doc_id {kind}, fp long")


@lean
def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy()
        for at in range(0, len(prints), 500):
            part = prints[at: at + 500]
            rows, keys = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


@lean
def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (kind 0: two fingerprints) and rows of keys with more than WINDOW + 1 rows (kind 1: key, fingerprint).

    Rows come sorted by key; between batches only the last WINDOW rows and the key's first row stay.
    """
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = np.zeros(0, np.int64)  # of a row within its key
    hub, hub_key = 0, None
    for batch in batches:
        new_key, new_fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        if not len(new_key):
            continue
        old = len(key)
        key, fp = np.concatenate([key, new_key]), np.concatenate([fp, new_fp])
        first = np.flatnonzero(np.r_[True, new_key[1:] != new_key[:-1]])
        begin = np.repeat(first, np.diff(np.r_[first, len(new_key)]))
        new_rank = np.arange(len(new_key)) - begin
        hubs = new_fp[begin]
        if hub_key is not None and new_key[0] == hub_key:
            run = slice(0, first[1] if len(first) > 1 else len(new_key))
            new_rank[run] += rank[-1] + 1
            hubs[run] = hub
        rank = np.concatenate([rank, new_rank])
        left, right, under = [], [], []
        for shift in range(1, WINDOW + 1):
            at = np.arange(max(old, shift), len(key))
            at = at[key[at] == key[at - shift]]
            if not len(at):
                break
            near = _popcount((fp[at] ^ fp[at - shift]).view(np.uint64)) <= MAX_BITS
            left.append(fp[at[near] - shift])
            right.append(fp[at[near]])
            under.append(key[at[near]])
        near = (_popcount((new_fp ^ hubs).view(np.uint64)) <= MAX_BITS) & (new_fp != hubs)
        left.append(hubs[near])
        right.append(new_fp[near])
        under.append(new_key[near])
        a, b = np.concatenate(left), np.concatenate(right)
        once = first_common_key(a.view(np.uint64), b.view(np.uint64)) == np.concatenate(under)  # of a pair's keys the first reports it
        links = np.unique(np.stack([a[once], b[once]], 1), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(links), np.int32)), pa.array(links[:, 0]), pa.array(links[:, 1])], ["kind", "x", "y"]
        )
        # a key is large once a rank passes WINDOW: then the row and the WINDOW + 1 before it go out, and each later row
        over = np.flatnonzero(rank[old:] > WINDOW) + old
        if len(over):
            crossing = over[rank[over] == WINDOW + 1]
            big = np.concatenate([over, (crossing[:, None] - np.arange(1, WINDOW + 2)[None, :]).ravel()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(big), np.int32)), pa.array(key[big]), pa.array(fp[big])], ["kind", "x", "y"]
            )
        hub, hub_key = int(hubs[-1]), int(new_key[-1])
        key, fp, rank = key[-WINDOW - 1:], fp[-WINDOW - 1:], rank[-WINDOW - 1:]


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``prints(fp)`` that connect all pairs within MAX_BITS.

    Not every such pair is a row, but any two of them are joined by a path of verified links.
    """
    spark = prints.sparkSession
    prepare(spark)
    keyed = prints.select("fp").mapInArrow(_key_batches, "key long, fp long")
    found = (
        keyed.repartition("key").sortWithinPartitions("key", "fp")
        .mapInArrow(_link_batches, "kind int, x long, y long").checkpoint()
    )
    near = found.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    large = found.where("kind = 1").select(F.col("x").alias("key"), F.col("y").alias("fp")).distinct()
    if not found.where("kind = 1").limit(1).count():
        return near
    near = near.checkpoint()
    so_far = components(near)
    rows = large.join(so_far.withColumnRenamed("node", "fp"), "fp", "left").select(
        "key", "fp", F.coalesce("component", "fp").alias("component")
    ).checkpoint()
    counts = rows.groupBy("key", "component").count()
    mixed = counts.groupBy("key").agg(F.max(F.struct("count", "component")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(mixed.select("key", F.col("top.component").alias("major")), "key")
    minor = rows.where("component <> major").select("key", F.col("fp").alias("a"), F.col("component").alias("ca"))
    pairs = minor.join(rows.select("key", F.col("fp").alias("b"), F.col("component").alias("cb")), "key")
    more = pairs.where((F.col("ca") != F.col("cb")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)).select("a", "b")
    return near.unionAll(more.distinct())


def groups(prints: DataFrame) -> DataFrame:
    """``prints(doc_id, fp)`` with component_id: the smallest doc_id reachable over links, itself included.

    Rows with equal fingerprints are one node, so a group of any number of copies costs one. A null
    doc_id gets the component of its group (null if it is alone); repeated rows stay repeated.
    """
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    found = components(links(distinct)).checkpoint()
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # by fingerprint: few rows a fingerprint's group of copies after the aggregate, and AQE may split the copies
    of_print = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(of_print, "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    Null and empty texts, and texts of white space, have fingerprint zero and link like any other.
    """
    prepare(docs.sparkSession)
    return groups(fingerprints(docs).checkpoint())


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, with all their columns.

    Rows with a null doc_id are dropped unless their whole group has none.
    """
    found = near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    rows = carry(docs, "doc_id", "text").join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return rows.select(restored(docs, ("doc_id", "text")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash_golay": op9_simhash}
