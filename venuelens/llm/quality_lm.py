"""Quality classifier: interpolated modified Kneser-Ney language model of trusted text.

Units are UTF-16 code units in 12 bits (digits folded to one, white space to a space, units from
4096 on to 2048 values), so an n-gram of five packs into one long and the counted n-grams grow with
the text. Per language:

1. Counts. n-grams of all trusted documents (labels: quality 1, not toxic), by fold, are summed in
   each task, sent packed by bucket of their third and fourth unit and added up there. One table has
   the count of the whole and of each fold; a model without a fold is a difference of two columns.
2. Modified Kneser-Ney for all models at once, a column each: three discounts an order from the
   counts of counts, continuation counts below the top order, interpolation down to the uniform
   distribution. Tables are joined by (language, n-gram).
3. Scoring is a sharded count join. A task's text is a chunk for each language and model; the
   chunk's distinct n-grams go out packed by the same buckets, meet the model's rows there (orders 3
   to 5 and their contexts share the two units, so a bucket knows all it needs; pairs and single
   units, which the alphabet bounds, are in every bucket), and the log probabilities go back to the
   chunk, where each document's are added up. Nothing of the model passes through the driver.
4. Thresholds are cross-fitted: trusted documents fall into FOLDS folds by hash and are scored by
   the model without their fold; all others by the whole model. So no document is judged by a model
   that has seen it. A document is kept if its perplexity is at most its language's QUANTILE among
   the trusted ones.

Chunks are named by their content and the input is read twice (text, n-grams); an input whose order
changes between two reads raises, so write a shuffled one first. Null or empty text: no units,
perplexity null, rejected. A language whose trusted text is all in one fold has no threshold: kept; without
any trusted text perplexity is null too. A null language is a language of its own, apart from an empty one.
Repeated rows are scored alike; repeated labels of one document count as trusted only if all are. Empty labels:
every document with text is kept. A document may be as long as memory for its units allows; one text is one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from venuelens.llm.common import carry, documents, lean, prepare, restored, shuffle_partitions, widened
from venuelens.session import written

ORDER = 5
BITS = 12
#: Quantile of the trusted documents' perplexities, each under the model of the other folds.
QUANTILE = 0.995
#: Folds of trusted documents (by hash of the id).
FOLDS = 4
#: Trusted ids are broadcast up to so many rows (16 MB), else joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of text of a chunk, and how many times that a task holds over all languages and models.
CHUNK_BYTES = 8 << 20
HELD_CHUNKS = 6
#: Entries of a table of places; a larger one is replaced by sorting.
PLACES = 1 << 25

_MASK = (1 << BITS) - 1
_FOLD = np.arange(65536, dtype=np.uint16)
_FOLD[1 << BITS:] = (1 << (BITS - 1)) + (_FOLD[1 << BITS:] & ((1 << (BITS - 1)) - 1))
_FOLD[ord("0"): ord("9") + 1] = ord("0")
_FOLD[[9, 10, 11, 12, 13]] = 32
_FOLD[0] = 1  # 0 stands before a text

# ---------------------------------------------------------------- n-grams of a chunk


def units_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units with ORDER - 1 zeros before each text, positions of the texts' own units, their text)."""
    pad = np.zeros(ORDER - 1, np.uint16)
    parts, sizes = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        own = _FOLD[np.frombuffer((t or "").encode("utf-16-le", "surrogatepass"), np.uint16)]
        sizes[i] = len(own)
        parts += [pad, own]
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    at = np.arange(len(rows), dtype=np.int32 if len(rows) + ORDER * len(texts) < 1 << 31 else np.int64)
    at += (rows + 1) * (ORDER - 1)
    return np.concatenate(parts) if parts else pad[:0], at, rows


def _ranked(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, place of each key among them) for keys below ``size``."""
    if size > PLACES:
        found, place = np.unique(key, return_inverse=True)
        return found, place.astype(np.int32)
    there = np.zeros(size, bool)
    there[key] = True
    place = np.cumsum(there, dtype=np.int32)
    place -= 1
    return np.flatnonzero(there), place[key]


def grams_of(units: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-grams that end at ``at``, in order, and the place of each position's)."""
    alphabet, code = _ranked(units, 1 << BITS)
    n = max(len(alphabet), 1)
    values, place = alphabet.astype(np.uint64), code
    for k in range(2, ORDER + 1):
        key = np.zeros(len(place), np.int32 if len(values) * n < 1 << 31 else np.int64)
        key[1:] = place[:-1]
        key *= n
        key += code
        if k == ORDER:
            key = key[at]
        found, place = _ranked(key, len(values) * n)
        values = (values[found // n] << np.uint64(BITS)) | alphabet[found % n].astype(np.uint64)
    return values, place


def _pair_hash(pair: np.ndarray, lang: str, buckets: int) -> np.ndarray:
    return (pair.astype(np.int64) * 2654435761 + zlib.crc32(lang.encode())) % buckets


def _bucket(grams: np.ndarray, lang: str, buckets: int) -> np.ndarray:
    """The bucket of top n-grams: by the two units before the last."""
    return _pair_hash((grams >> np.uint64(BITS)) & np.uint64((1 << 2 * BITS) - 1), lang, buckets)


def _squeeze(arrays: list[np.ndarray]) -> bytes:
    raw = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(r) for r in raw], "<i8").tobytes() + b"".join(raw))


def _unsqueeze(blob: bytes, dtypes: list[str]) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(body, "<i8", len(dtypes))
    ends = 8 * len(dtypes) + np.cumsum(sizes)
    return [np.frombuffer(body, d, int(s) // np.dtype(d).itemsize, int(e - s)) for d, s, e in zip(dtypes, sizes, ends)]


def _pack_keys(keys: np.ndarray) -> np.ndarray:
    """Rising keys as differences, byte plane by byte plane."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T


def _unpack_keys(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(x.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


# ---------------------------------------------------------------- rows of the exchanges

MODELS = FOLDS + 1
_VALUES = [f"v{m}" for m in range(MODELS)]
_ROW = "bucket int, chunk long, kind int, lang string, m int, key long, " + ", ".join(f"{v} float" for v in _VALUES) + ", blob binary"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]
#: kinds of rows beside the model's orders (below 10): a chunk's n-grams, its text, log probabilities
ASK, TEXT, ANSWER = 10, 11, 12


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (bucket, chunk, kind, lang, m, blob)."""
    n = len(rows)
    b, c, k, lang, m, blob = zip(*rows) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(b, pa.int32()), pa.array(c, pa.int64()), pa.array(k, pa.int32()), pa.array(lang, pa.string()), pa.array(m, pa.int32()), pa.nulls(n, pa.int64())]
        + [pa.nulls(n, pa.float32())] * MODELS + [pa.array(blob, pa.binary())], _NAMES)


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[str, int, pa.Table]]:
    """(language, model, rows) of all rows: a chunk has ``chunk_bytes`` of text, or what is left when a task holds HELD_CHUNKS times that."""
    held: dict[tuple[str, int], list] = {}
    sizes: dict[tuple[str, int], int] = {}

    def out(g: tuple[str, int]) -> tuple[str, int, pa.Table]:
        sizes.pop(g)
        return *g, pa.Table.from_batches(held.pop(g))

    for batch in batches:
        groups: dict[tuple[str, int], list[int]] = {}
        for i, g in enumerate(zip(batch.column("_lang").to_pylist(), batch.column("_m").to_pylist())):
            groups.setdefault(g, []).append(i)
        for g, rows in groups.items():
            part = batch.take(pa.array(rows))
            held.setdefault(g, []).append(part)
            sizes[g] = sizes.get(g, 0) + part.column("text").nbytes
            if sizes[g] >= chunk_bytes:
                yield out(g)
        if sum(sizes.values()) >= HELD_CHUNKS * chunk_bytes:
            for g in sorted(held):
                yield out(g)
    for g in sorted(held):
        yield out(g)


def _name_and_body(table: pa.Table) -> tuple[int, bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table.combine_chunks())
    body = sink.getvalue().to_pybytes()
    return xxhash.xxh64_intdigest(body) - (1 << 63), body


@lean
def _count_batches(batches: Iterator[pa.RecordBatch], buckets: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Counts of each chunk's n-grams, packed by bucket."""
    for lang, m, table in _chunks(batches, chunk_bytes):
        units, at, _ = units_of(table.column("text").to_pylist())
        if len(at):
            grams, place = grams_of(units, at)
            n = np.bincount(place, minlength=len(grams))
            yield _rows([(b, 0, ASK, lang, m, _squeeze([_pack_keys(grams[r]), n[r].astype("<u4")])) for b, r in _by_bucket(grams, lang, buckets)])


def _by_bucket(grams: np.ndarray, lang: str, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its n-grams in order)."""
    bucket = _bucket(grams, lang, buckets)
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edge[b] < edge[b + 1]:
            yield b, order[edge[b]: edge[b + 1]]


_COUNTS = "lang string, gram long, " + ", ".join(f"c{m} long" for m in range(MODELS))


@lean
def _add_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (bucket, lang): the counts of every n-gram, for the whole (c0) and without each fold."""
    current, parts = None, []

    def out() -> Iterator[pa.RecordBatch]:
        gram = np.concatenate([p[0] for p in parts])
        grams, place = np.unique(gram, return_inverse=True)
        by_fold = np.zeros((MODELS, len(grams)), np.int64)
        start = 0
        for keys, n, m in parts:
            by_fold[m] += np.bincount(place[start: start + len(keys)], weights=n, minlength=len(grams)).astype(np.int64)
            start += len(keys)
        whole = by_fold.sum(axis=0)
        columns = [whole, *(whole - by_fold[m] for m in range(1, MODELS))]
        for a in range(0, len(grams), 50_000):
            part = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([current[1]] * len(grams[part]), pa.string()), pa.array(grams[part].view(np.int64)), *(pa.array(c[part]) for c in columns)],
                ["lang", "gram", *(f"c{m}" for m in range(MODELS))])

    for batch in batches:
        for b, lang, m, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "m", "blob"))):
            if (b, lang) != current:
                if parts:
                    yield from out()
                current, parts = (b, lang), []
            keys, n = _unsqueeze(blob, ["u1", "<u4"])
            parts.append((_unpack_keys(keys), n, m))
    if parts:
        yield from out()


def counts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, gram, c0..): counts of the top order over ``docs(_lang, _m, text)``, _m from 1 the fold: of all, and of all but each fold."""
    buckets = max(8, shuffle_partitions(docs.sparkSession))
    packed = docs.select("_lang", "_m", "text").mapInArrow(lambda b: _count_batches(b, buckets, chunk_bytes), _ROW)
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang").mapInArrow(_add_batches, _COUNTS)


# ---------------------------------------------------------------- the models


def _discounts(table: DataFrame) -> DataFrame:
    """(lang, d<model>_<1..3>) from the counts of counts; discounts stay within their counts."""
    of = [F.sum(F.when(F.col(f"c{m}") == k, 1).otherwise(0)).cast("double").alias(f"t{m}_{k}") for m in range(MODELS) for k in (1, 2, 3, 4)]
    t = table.groupBy("lang").agg(*of)
    out = []
    for m in range(MODELS):
        c = {k: F.col(f"t{m}_{k}") for k in (1, 2, 3, 4)}
        y = F.try_divide(c[1], c[1] + 2 * c[2])
        for k in (1, 2, 3):
            d = k - (k + 1) * y * F.try_divide(c[k + 1], c[k])
            out.append(F.least(F.greatest(F.coalesce(d, F.lit(0.5 * k)), F.lit(0.05)), F.lit(float(k)) - 0.05).alias(f"d{m}_{k}"))
    return t.select("lang", *out)


def model(top: DataFrame) -> DataFrame:
    """(lang, kind, key, v0..): log probabilities (kind = order) and log back-off weights (kind = -order of the context), a column a model.

    ``top``: the table of :func:`counts`. Kind 0 holds the log probability of an unknown unit. Null: not in that model.
    """
    each = range(MODELS)
    cs = [f"c{m}" for m in each]
    tables = {ORDER: written(top, "grams")}
    for order in range(ORDER - 1, 0, -1):
        below = F.col("gram").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
        tables[order] = written(tables[order + 1].groupBy("lang", below.alias("gram")).agg(*[F.count_if(F.col(c) > 0).alias(c) for c in cs]), "grams")
    parts, lower = [], None
    for order in range(1, ORDER + 1):
        table = tables[order].join(F.broadcast(_discounts(tables[order])), "lang")  # a row a language
        for m in each:
            c = F.col(cs[m])
            table = table.withColumn(f"d{m}", F.when(c == 1, F.col(f"d{m}_1")).when(c == 2, F.col(f"d{m}_2")).when(c > 2, F.col(f"d{m}_3")))
        table = table.withColumn("context", F.shiftrightunsigned(F.col("gram"), BITS)).select("lang", "gram", "context", *cs, *[f"d{m}" for m in each])
        stats = table.groupBy("lang", "context").agg(
            *[F.sum(c).alias(f"total{m}") for m, c in enumerate(cs)],
            *[F.try_divide(F.sum(f"d{m}"), F.sum(c)).alias(f"weight{m}") for m, c in enumerate(cs)],
            *[F.count_if(F.col(c) > 0).alias(f"types{m}") for m, c in enumerate(cs)],
        )
        share = [F.when(F.col(f"c{m}") > 0, F.try_divide(F.col(f"c{m}") - F.col(f"d{m}"), F.col(f"total{m}"))) for m in each]
        if order == 1:
            joined = table.join(F.broadcast(stats), ["lang", "context"])  # contexts are empty: a row a language
            rest = [F.col(f"weight{m}") / (F.col(f"types{m}") + 1) for m in each]
            parts.append(stats.select("lang", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("key"), *[F.log(rest[m]).cast("float").alias(f"v{m}") for m in each]))
        else:
            below = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))
            joined = table.join(stats, ["lang", "context"]).withColumn("below", below)
            joined = joined.join(lower.select("lang", F.col("gram").alias("below"), *[F.col(f"p{m}").alias(f"q{m}") for m in each]), ["lang", "below"])
            rest = [F.col(f"weight{m}") * F.col(f"q{m}") for m in each]
            parts.append(stats.select("lang", F.lit(1 - order).alias("kind"), F.col("context").alias("key"), *[F.log(f"weight{m}").cast("float").alias(f"v{m}") for m in each]))
        lower = written(joined.select("lang", "gram", *[(share[m] + rest[m]).cast("float").alias(f"p{m}") for m in each]), "order")
        parts.append(lower.select("lang", F.lit(order).alias("kind"), F.col("gram").alias("key"), *[F.log(f"p{m}").cast("float").alias(f"v{m}") for m in each]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return written(out, "model")


def _model_rows(table: DataFrame, buckets: int) -> DataFrame:
    """The model as rows of the exchange: by bucket, pairs and single units in every bucket."""
    key = F.when(F.col("kind") > 0, F.shiftrightunsigned(F.col("key"), BITS)).otherwise(F.col("key")).bitwiseAND(F.lit((1 << 2 * BITS) - 1))
    own = F.pmod(key * 2654435761 + F.crc32("lang"), F.lit(buckets)).cast("int")
    small = F.col("kind").between(-1, 2)
    to = F.when(small, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(own))
    return table.select(F.explode(to).alias("bucket"), F.lit(0).cast("long").alias("chunk"), "kind", "lang", F.lit(0).alias("m"), "key", *_VALUES, F.lit(None).cast("binary").alias("blob"))


# ---------------------------------------------------------------- scoring


def _look(table: tuple[np.ndarray, np.ndarray] | None, m: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, value) of each key in model ``m``."""
    if table is None or not len(keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    value = table[1][m][at]
    return (table[0][at] == keys) & ~np.isnan(value), value


def log_probabilities(tables: dict[int, tuple], m: int, grams: np.ndarray) -> np.ndarray:
    """Log probability of the last unit of each top n-gram given those before, under model ``m``; NaN without a model."""
    known, unknown = _look(tables.get(0), m, np.zeros(1, np.uint64))
    if not known[0]:
        return np.full(len(grams), np.nan)
    out, open_, keys = np.zeros(len(grams)), np.arange(len(grams)), grams
    for order in range(ORDER, 0, -1):
        found, value = _look(tables.get(order), m, keys)
        out[open_[found]] += value[found]
        open_, keys = open_[~found], keys[~found]
        if order > 1:
            known, weight = _look(tables.get(1 - order), m, keys >> np.uint64(BITS))
            out[open_[known]] += weight[known]
            keys = keys & np.uint64((1 << (BITS * (order - 1))) - 1)
    out[open_] += unknown[0]
    return out


@lean
def _ask_batches(batches: Iterator[pa.RecordBatch], buckets: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    for lang, m, table in _chunks(batches, chunk_bytes):
        name, _ = _name_and_body(table)
        units, at, _ = units_of(table.column("text").to_pylist())
        if len(at):
            grams, _ = grams_of(units, at)
            yield _rows([(b, name, ASK, lang, m, _squeeze([_pack_keys(grams[r])])) for b, r in _by_bucket(grams, lang, buckets)])


@lean
def _text_batches(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    for lang, m, table in _chunks(batches, chunk_bytes):
        name, body = _name_and_body(table)
        yield _rows([(-1, name, TEXT, lang, m, zstandard.ZstdCompressor(level=6).compress(body))])


@lean
def _answer_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (bucket, lang, kind): the model's, then the chunks that ask."""
    current, held, tables = None, {}, None
    for batch in batches:
        lang, bucket, kind = batch.column("lang").to_pylist(), batch.column("bucket").to_numpy(), batch.column("kind").to_numpy()
        group = list(zip(bucket.tolist(), lang, kind.tolist()))
        edge = [0, *(i for i in range(1, len(group)) if group[i] != group[i - 1]), len(group)]
        for a, b in zip(edge[:-1], edge[1:]):
            if a == b:
                continue
            if group[a][:2] != current:
                current, held, tables = group[a][:2], {}, None
            if group[a][2] < ASK:
                part = batch.slice(a, b - a)
                held.setdefault(group[a][2], []).append(
                    (part.column("key").to_numpy().view(np.uint64), np.stack([part.column(v).to_numpy(zero_copy_only=False).astype(np.float64) for v in _VALUES])))
                continue
            if tables is None:
                tables = {}
                for k, parts in held.items():
                    keys, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts], axis=1)
                    order = np.argsort(keys)
                    tables[k] = (keys[order], values[:, order])
            out = []
            for i in range(a, b):
                m = batch.column("m")[i].as_py()
                grams = _unpack_keys(_unsqueeze(batch.column("blob")[i].as_py(), ["u1"])[0])
                answer = log_probabilities(tables, m, grams).astype("<f4").view(np.uint8).reshape(-1, 4).T
                out.append((current[0], batch.column("chunk")[i].as_py(), ANSWER, current[1], m, _squeeze([answer])))
                if sum(len(o[-1]) for o in out) > 4 << 20:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)


def _score_chunk(body: bytes, lang: str, answers: list[bytes], buckets: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    table = pa.ipc.open_stream(pa.py_buffer(zstandard.ZstdDecompressor().decompress(body))).read_all()
    units, at, owner = units_of(table.column("text").to_pylist())
    n = np.bincount(owner, minlength=len(table))
    ll = np.zeros(len(table))
    if len(at):
        grams, place = grams_of(units, at)
        parts = [np.ascontiguousarray(_unsqueeze(a, ["u1"])[0].reshape(4, -1).T).view("<f4").ravel() for a in answers]
        value = np.zeros(len(grams))
        order = [r for _, r in _by_bucket(grams, lang, buckets)]
        if [len(r) for r in order] != [len(p) for p in parts]:
            raise RuntimeError("a chunk's n-grams were not all answered: the input changed between two reads")
        value[np.concatenate(order)] = np.concatenate(parts)
        ll = np.bincount(owner, weights=value[place], minlength=len(table))
        n[np.isnan(ll)] = 0
        ll[np.isnan(ll)] = 0
    out = table.select(columns[:-2]).append_column("_ll", pa.array(ll)).append_column("_n", pa.array(n.astype(np.int64)))
    yield from out.combine_chunks().to_batches(max_chunksize=500)


@lean
def _score_batches(batches: Iterator[pa.RecordBatch], buckets: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows come by (chunk, kind, bucket): texts, then answers; chunks of equal content ask alike, one answer serves all."""
    current, bodies, answers, seen = None, [], [], None
    for batch in batches:
        for i, chunk in enumerate(batch.column("chunk").to_pylist()):
            if chunk != current:
                for lang, body in bodies:
                    yield from _score_chunk(body, lang, answers, buckets, columns)
                current, bodies, answers, seen = chunk, [], [], None
            kind, bucket, blob = (batch.column(c)[i].as_py() for c in ("kind", "bucket", "blob"))
            if kind == TEXT:
                bodies.append((batch.column("lang")[i].as_py(), blob))
            elif bucket != seen:
                answers.append(blob)
                seen = bucket
    for lang, body in bodies:
        yield from _score_chunk(body, lang, answers, buckets, columns)


def score(docs: DataFrame, table: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Adds _ll and _n, log-likelihood and scored units (0 without a model), to ``docs(_lang, _m, text, ...)``; _m: the model that judges the row."""
    buckets = max(8, shuffle_partitions(docs.sparkSession))
    schema: StructType = widened(docs.schema, _ll="double", _n="long")
    asks = docs.select("_lang", "_m", *[c for c in docs.columns if c not in ("_lang", "_m")])
    texts = asks.mapInArrow(lambda b: _text_batches(b, chunk_bytes), _ROW)
    asked = asks.mapInArrow(lambda b: _ask_batches(b, buckets, chunk_bytes), _ROW)
    met = asked.unionAll(_model_rows(table, buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang", "kind")
    # the sort puts the model's kinds (below ASK) first
    answers = met.mapInArrow(_answer_batches, _ROW)
    columns = schema.fieldNames()
    return texts.unionAll(answers).repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket").mapInArrow(lambda b: _score_batches(b, buckets, columns), schema)


# ---------------------------------------------------------------- the classifier


def _trusted(labels: DataFrame) -> DataFrame:
    """(_id, _fold): trusted documents and their fold, from 1."""
    sure = labels.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("q"), F.max(F.col("toxic").cast("int")).alias("t"))
    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) + 1).cast("int")
    ids = written(sure.where("q = 1 and coalesce(t, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("_id"), fold.alias("_fold")), "trusted")
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def classify(docs: DataFrame, labels: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, lang, text and the rest of ``docs`` (one struct) with perplexity, threshold and kept added."""
    prepare(docs.sparkSession)
    trusted = _trusted(labels)
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("null"))
    inner = carry(docs, "doc_id", "lang", "text").withColumns({"text": F.col("text").cast("string"), "_lang": lang})
    inner = inner.join(trusted, F.col("doc_id") == F.col("_id"), "left").withColumn("_m", F.coalesce("_fold", F.lit(0))).drop("_id", "_fold")
    scored = score(inner, model(counts(inner.where("_m > 0"), chunk_bytes)), chunk_bytes)
    perplexity = F.when(F.col("_n") > 0, F.exp(-F.col("_ll") / F.col("_n")))
    limits = scored.where("_m > 0 and _n > 0").groupBy("_lang").agg(F.percentile_approx(perplexity, QUANTILE, 10_000).alias("threshold"))
    scored = scored.join(F.broadcast(limits), "_lang", "left").withColumn("perplexity", perplexity)  # a row a language
    empty = F.coalesce(F.length("text"), F.lit(0)) == 0
    return scored.withColumn("kept", ~empty & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    return classify(docs, labels).where("kept").select(restored(docs, ("doc_id", "lang", "text")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "lang", "perplexity", "threshold", "kept")


QUERIES = {"op1_quality_kneser_ney": op1_quality}
