"""Phrase collocation mining over count streams kept in prefix and suffix order.

Only one kind of record is counted: a word with the three that follow it in its piece (padded at
the piece's end). Every shorter count is a sum of neighbours in the stream's order:

1. *Bounds.* A sample of records, a bounded number a pack of text, is range-partitioned; the least
   record of each partition bounds the buckets, so that no word or phrase makes a bucket large.
   Bounds never change results.
2. *Runs.* Each task sorts the records of a pack in prefix order, adds up equal ones and sends
   each bucket its part, packed with the pack's dictionary of word fingerprints.
3. *Prefix order.* A bucket merges its packs' sorted parts. Counts of 1 to 4 words are sums of
   successive records with one prefix; the counts of at least ``least`` go on. A prefix that
   reaches over a bucket's edge goes on as a part, and the parts are added.
4. *Lockstep merges.* The counts are kept twice, by words from the front and by words from the
   back. Sort-merge joins walk sorted streams side by side: left parts and right-hand extensions
   of a phrase meet it in prefix order, right parts and left-hand extensions in suffix order. No
   hash table is built; a hot first or last word is one side of a join that AQE may split.

A longer phrase that takes a candidate away need only be one word longer: its own inner phrases
around the candidate count at least as much. Languages are kept apart inside the fingerprint (64
bits of word and language); two words of one fingerprint in a bucket raise an error instead of
being mixed. Sums are longs, the scores' products decimals.

A null language is `und`, null or empty text has no words. Repeated rows count each for
themselves. Texts may have any length; an empty table has no phrases; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelens.llm.common import documents, flat, lean, mix, prepare, shuffle_partitions, slices, text_or_empty
from venuelens.llm.words import Words, kinds

ORDER = 4
LEAST = 30
#: Hundredths of a phrase's count that a longer phrase must have to take it away.
TAKEN = 80
TOP = 2000
SCALE = 2_000_000
#: Bytes of text whose records a task sorts together, and records of each that set the bounds.
PACK_BYTES = 16 << 20
SAMPLED = 256

_SPACES, _BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = kinds(_SPACES, _BREAKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_KEYS = ["w1", "w2", "w3", "w4"]

# ---------------------------------------------------------------- records of a pack


def _ragged(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """data[start: start + size] of every pair, one after another."""
    return data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Pack:
    """Words of some text: fingerprints, pieces, and the bytes of each distinct word."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.langs: dict[str, int] = {}
        self.bytes = self.pieces = 0

    def add(self, batch: pa.RecordBatch) -> None:
        offsets, data = flat(batch.column("text"))
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in batch.column("lang").to_pylist()], np.int64)
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        for a, b in slices(offsets):
            lower = _LOWER[data[offsets[a]: offsets[b]]]
            w = Words(offsets[a: b + 1] - offsets[a], lower, _TABLE)
            if not len(w):
                continue
            of = lang[a + w.row]
            piece = w.piece() + self.pieces + 1
            self.pieces = int(piece[-1])
            fp = mix(w.hashes(lower) ^ salt[of]) | np.uint64(1)  # never 0, the padding
            # of each slice only its distinct words' bytes stay
            some, at, where = np.unique(fp, return_index=True, return_inverse=True)
            size = (w.end - w.start)[at]
            self.parts.append((some, size, _ragged(lower, w.start[at], size), of[at], where.astype(np.uint32), piece))
        self.bytes += len(data)

    def records(self) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints in order, records of places among them from 1; 0 pads). Records are in text order."""
        every = np.concatenate([p[0] for p in self.parts])
        self.fps, at = np.unique(every, return_index=True)
        sizes = np.concatenate([p[1] for p in self.parts])
        data = np.concatenate([p[2] for p in self.parts])
        starts = np.cumsum(sizes) - sizes
        self.size, self.lang = sizes[at], np.concatenate([p[3] for p in self.parts])[at]
        self.text = _ragged(data, starts[at], self.size)
        ids = np.concatenate([np.searchsorted(self.fps, p[0]).astype(np.uint32)[p[4]] for p in self.parts]) + np.uint32(1)
        piece = np.concatenate([p[5] for p in self.parts])
        out = np.zeros((ORDER, len(ids)), np.uint32)
        out[0] = ids
        for j in range(1, ORDER):
            out[j, : len(ids) - j] = np.where(piece[j:] == piece[: len(ids) - j], ids[j:], 0)
        return self.fps, out


def _wide(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r = r.astype(np.uint64)
    return (r[0] << np.uint64(32)) | r[1], (r[2] << np.uint64(32)) | r[3]


def summed(records: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Records in prefix order, equal ones added up."""
    front, back = _wide(records)
    order = np.lexsort((back, front))
    front, back = front[order], back[order]
    head = np.flatnonzero(np.r_[True, (front[1:] != front[:-1]) | (back[1:] != back[:-1])])
    total = np.diff(np.r_[head, len(order)]) if n is None else np.add.reduceat(n[order], head)
    return records[:, order[head]], total.astype(np.int64)


def _place(records: np.ndarray, fps: np.ndarray, bound: tuple) -> int:
    """Where the sorted ``records`` reach ``bound``, a record of fingerprints."""
    low, high = 0, records.shape[1]
    for j, f in enumerate(bound):
        f = np.uint64(f)
        at = int(np.searchsorted(fps, f)) if f else 0
        known = f == 0 or (at < len(fps) and fps[at] == f)
        rank = 0 if f == 0 else at + 1
        column = records[j, low:high]
        left = low + int(np.searchsorted(column, np.uint32(rank)))
        if not known:
            return left
        low, high = left, low + int(np.searchsorted(column, np.uint32(rank), side="right"))
    return low


def _squeeze(arrays: list[np.ndarray]) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(r) for r in raw], "<i8").tobytes() + b"".join(raw))


def _unsqueeze(blob: bytes, dtypes: list[str]) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(body, "<i8", len(dtypes))
    ends = 8 * len(dtypes) + np.cumsum(sizes)
    return [np.frombuffer(body, d, int(s) // np.dtype(d).itemsize, int(e - s)) for d, s, e in zip(dtypes, sizes, ends)]


def _planes(x: np.ndarray) -> np.ndarray:
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T


def _unplanes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(4, -1).T).view("<u4").ravel()


#: a bucket's part of a pack: fingerprints, four columns of places, counts; first words: place, size, language; their bytes; languages
_PART = ["<u8", "u1", "u1", "u1", "u1", "<i8", "<u4", "<u4", "<u4", "u1", "u1"]


def _packs(batches: Iterator[pa.RecordBatch], pack_bytes: int) -> Iterator[Pack]:
    pack = Pack()
    for batch in batches:
        pack.add(batch)
        if pack.bytes >= pack_bytes:
            if pack.parts:
                yield pack
            pack = Pack()
    if pack.parts:
        yield pack


@lean
def _sample_batches(batches: Iterator[pa.RecordBatch], pack_bytes: int) -> Iterator[pa.RecordBatch]:
    for pack in _packs(batches, pack_bytes):
        fps, records = pack.records()
        some = records[:, np.linspace(0, records.shape[1] - 1, min(SAMPLED, records.shape[1])).astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.uint64(0), fps][c].view(np.int64)) for c in some], _KEYS)


@lean
def _run_batches(batches: Iterator[pa.RecordBatch], pack_bytes: int, bounds: list[tuple]) -> Iterator[pa.RecordBatch]:
    for pack in _packs(batches, pack_bytes):
        fps, records = pack.records()
        records, n = summed(records)
        edge = [0, *(_place(records, fps, b) for b in bounds), len(n)]
        names = json.dumps(list(pack.langs)).encode()
        starts = np.cumsum(pack.size) - pack.size
        for b, (low, high) in enumerate(zip(edge[:-1], edge[1:])):
            if low == high:
                continue
            part = records[:, low:high]
            used = np.zeros(len(fps) + 1, bool)
            used[part.ravel()] = True
            used[0] = True
            at = np.flatnonzero(used)
            rank = (np.cumsum(used) - 1).astype(np.uint32)
            part = rank[part]
            first = np.unique(part[0])
            word = at[first] - 1
            blob = _squeeze([
                fps[at[1:] - 1], *(_planes(c) for c in part), n[low:high].astype("<i8"), first.astype("<u4"), pack.size[word].astype("<u4"),
                pack.lang[word].astype("<u4"), _ragged(pack.text, starts[word], pack.size[word]), np.frombuffer(names, np.uint8),
            ])
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "blob"])


# ---------------------------------------------------------------- prefix order

_COUNT = "k int, lang string, w1 long, w2 long, w3 long, w4 long, n long, word string"


def _counts(blobs: list[bytes], least: int) -> Iterator[pa.RecordBatch]:
    """The counts of one bucket: order k (0: all words of a language) and its words' fingerprints, 0 beyond them."""
    parts = [_unsqueeze(b, _PART) for b in blobs]
    fps, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    rank = np.split(at + 1, np.cumsum([len(p[0]) for p in parts])[:-1])
    records = np.concatenate([np.r_[0, r].astype(np.uint32)[np.stack([_unplanes(c) for c in p[1:5]])] for p, r in zip(parts, rank)], axis=1)
    records, n = summed(records, np.concatenate([p[5] for p in parts]))
    # first words and their languages, from the packs
    words: dict[int, tuple[str, bytes]] = {}
    for p, r in zip(parts, rank):
        langs = json.loads(p[10].tobytes())
        raw, ends = p[9].tobytes(), np.cumsum(p[7]).tolist()
        for i, a, b, lang in zip(np.r_[0, r][p[6]].tolist(), [0, *ends], ends, p[8].tolist()):
            if words.setdefault(i, (langs[lang], raw[a:b])) != (langs[lang], raw[a:b]):
                raise ValueError("two words have one fingerprint")
    wide = np.r_[np.uint64(0), fps].view(np.int64)
    changed = np.zeros(records.shape[1], bool)
    changed[:1] = True
    for k in range(1, ORDER + 1):
        column = records[k - 1]
        changed = changed | np.r_[True, column[1:] != column[:-1]]
        head = np.flatnonzero(changed)
        total = np.add.reduceat(n, head)
        open_ = np.zeros(len(head), bool)
        open_[[0, -1]] = True  # may reach over the bucket's edge
        keep = (column[head] != 0) & ((total >= least) | open_)
        head, total = head[keep], total[keep]
        first = records[0, head].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(head), k, np.int32)), pa.array([words[i][0] for i in first], pa.string())]
            + [pa.array(wide[records[j, head]] if j < k else np.zeros(len(head), np.int64)) for j in range(ORDER)]
            + [pa.array(total), pa.array([words[i][1].decode() if k == 1 else None for i in first], pa.string())],
            [x.split()[0] for x in _COUNT.split(", ")],
        )
    by_word = np.bincount(records[0], weights=None, minlength=len(fps) + 1)  # records a first word
    ends = np.cumsum(by_word)
    sums = np.r_[0, np.cumsum(n)]
    totals: dict[str, int] = {}
    for i, (lang, _) in words.items():
        totals[lang] = totals.get(lang, 0) + int(sums[ends[i]] - sums[ends[i] - by_word[i]])
    zero = pa.array(np.zeros(len(totals), np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(len(totals), np.int32)), pa.array(list(totals), pa.string()), zero, zero, zero, zero, pa.array(list(totals.values()), pa.int64()), pa.nulls(len(totals), pa.string())],
        [x.split()[0] for x in _COUNT.split(", ")],
    )


@lean
def _merge_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    blobs: list[bytes] = []
    current = None
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
            if bucket != current and blobs:
                yield from _counts(blobs, least)
                blobs = []
            current = bucket
            blobs.append(blob)
    if blobs:
        yield from _counts(blobs, least)


def counts(docs: DataFrame, least: int = LEAST, pack_bytes: int = PACK_BYTES, buckets: int | None = None) -> DataFrame:
    """(k, lang, w1..w4, n, word): every run of k words that occurs ``least`` times or more in its language, and (k = 0) all words.

    w1..w4 are fingerprints (0 beyond k words); word is told for k = 1. The table is written to the checkpoint folder.
    """
    spark = prepare(docs.sparkSession)
    buckets = buckets or max(8, shuffle_partitions(spark))  # a bucket is merged whole: the setting follows the data
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    sample = rows.mapInArrow(lambda b: _sample_batches(b, pack_bytes), "w1 long, w2 long, w3 long, w4 long")
    # unsigned order
    keys = [F.col(c).bitwiseXOR(F.lit(-(2**63))).alias(c) for c in _KEYS]
    ranges = sample.select(keys).repartitionByRange(buckets, *_KEYS).groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*_KEYS)).alias("key"))
    bounds = sorted(tuple((x + 2**63) for x in r.key) for r in ranges.collect())[1:]  # one a bucket
    runs = rows.mapInArrow(lambda b: _run_batches(b, pack_bytes, bounds), "bucket int, blob binary")
    merged = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _merge_batches(b, least), _COUNT)
    total = merged.groupBy("k", "lang", *_KEYS).agg(F.sum("n").alias("n"), F.max("word").alias("word"))
    return total.where((F.col("n") >= least) | (F.col("k") == 0)).checkpoint()


# ---------------------------------------------------------------- lockstep merges


def _padded(words: F.Column) -> F.Column:
    return F.concat(words, F.array_repeat(F.lit(0).cast("long"), ORDER - F.size(words)))


def _merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join by walking both sides in the order of ``keys``."""
    return left.join(right.hint("merge"), keys, "left")


def _as_keys(df: DataFrame, words: F.Column, names: list[str]) -> DataFrame:
    padded = _padded(words)
    return df.withColumns({c: padded[j] for j, c in enumerate(names)})


def candidates(table: DataFrame, taken: int = TAKEN) -> DataFrame:
    """(lang, words, a, l, r, score) of the phrases that no longer phrase takes away, from :func:`counts`.

    words: fingerprints. The cut of the lowest score counts, of equals the first.
    """
    back = ["v1", "v2", "v3", "v4"]
    grams = table.where("k > 0").select("k", "lang", "n", F.slice(F.array(*_KEYS), 1, F.col("k")).alias("words"))
    prefix_order = _as_keys(grams, F.col("words"), _KEYS).select(*_KEYS, F.col("n").alias("l"))
    suffix_order = _as_keys(grams, F.reverse("words"), back).select(*back, F.col("n").alias("r"))
    phrases = grams.where("k > 1").withColumnRenamed("n", "a")
    # extensions: the greatest count of a phrase one word longer, at either end
    longer = grams.where("k > 2").withColumn("inner", F.col("k") - 1)
    to_right = _as_keys(longer, F.slice("words", F.lit(1), F.col("inner")), _KEYS).groupBy(*_KEYS).agg(F.max("n").alias("e1"))
    to_left = _as_keys(longer, F.reverse(F.slice("words", F.lit(2), F.col("inner"))), back).groupBy(*back).agg(F.max("n").alias("e2"))
    kept = _merge(_as_keys(phrases, F.col("words"), _KEYS), to_right, _KEYS).drop(*_KEYS)
    kept = _merge(_as_keys(kept, F.reverse("words"), back), to_left, back).drop(*back)
    most = F.greatest(F.coalesce("e1", F.lit(0)), F.coalesce("e2", F.lit(0))).cast("decimal(20,0)")
    kept = kept.where(most * 100 < F.col("a").cast("decimal(20,0)") * taken).drop("e1", "e2")
    cut = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = _merge(_as_keys(cut, F.slice("words", F.lit(1), F.col("cut")), _KEYS), prefix_order, _KEYS).drop(*_KEYS)
    cut = _merge(_as_keys(cut, F.slice(F.reverse("words"), F.lit(1), F.col("k") - F.col("cut")), back), suffix_order, back).drop(*back)
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20,0)) + r)")
    best = cut.groupBy("lang", "words", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "words", "a", "best.l", "best.r", "best.score")


def top(table: DataFrame, found: DataFrame, limit: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``limit`` phrases of each language."""
    order = [F.desc("score"), F.desc("a")]
    ahead = found.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= limit).drop("place")
    words = table.where("k = 1").select("w1", "word")
    spelled = ahead.select("*", F.posexplode("words").alias("at", "w1")).join(words, "w1").groupBy("lang", "words", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= limit)
    totals = table.where("k = 0").select("lang", "n")  # a row a language
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, limit: int = TOP) -> DataFrame:
    table = counts(docs, least)
    return top(table, candidates(table), limit)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


QUERIES = {"op13_collocations": op13_collocations}
