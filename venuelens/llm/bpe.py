"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

1. A task splits its documents into pre-tokens (the tokenizer's pattern) and keeps, for about
   CHUNK_BYTES of text at a time, the distinct words and each pre-token's place among them.
2. The distinct words go out by bucket of their hash, packed by (chunk, bucket). A bucket sees
   all chunks' words, encodes each distinct word once and answers every chunk in its order.
   A frequent word costs one row part a chunk, not one an occurrence.
3. Answers meet their chunk's places; gathering ids by place reassembles each document.

Chunks are named by their content, so the two scans need not agree on partition numbers, and
a chunk whose answers are missing raises instead of giving wrong ids. Decoding joins ids with
the token-byte table (fixed by the vocabulary file) and concatenates.

Null text counts as empty and has no ids. Texts may have any length; repeated rows are encoded
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm.common import documents, flat, lean, prepare, shuffle_partitions

CHUNK_BYTES = 16 << 20
OUT_BYTES = 4 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


_WORKER: dict = {}


def _ranks(path: str) -> dict[bytes, int]:
    if ("ranks", path) not in _WORKER:
        with open(path, "rb") as f:
            _WORKER["ranks", path] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return _WORKER["ranks", path]


def _encoder(path: str, pattern: str):
    if ("encoder", path, pattern) not in _WORKER:
        import tiktoken

        _WORKER["encoder", path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
    return _WORKER["encoder", path, pattern]


def _splitter(pattern: str):
    if ("splitter", pattern) not in _WORKER:
        import regex

        _WORKER["splitter", pattern] = regex.compile(pattern)
    return _WORKER["splitter", pattern]


def token_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the tokens by id."""
    if ("table", path) not in _WORKER:
        by_id = {i: t for t, i in _ranks(path).items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        _WORKER["table", path] = (np.r_[0, np.cumsum([len(t) for t in tokens])], np.frombuffer(b"".join(tokens), np.uint8))
    return _WORKER["table", path]


def _squeeze(*parts: bytes) -> bytes:
    head = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(parts)], "<i8").tobytes() + head + b"".join(parts))


def _unsqueeze(blob: bytes) -> list[memoryview]:
    body = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    n = int(np.frombuffer(body[:8], "<i8")[0])
    sizes = np.frombuffer(body[8: 8 + 8 * n], "<i8")
    at, out = 8 + 8 * n, []
    for s in sizes.tolist():
        out.append(body[at: at + s])
        at += s
    return out


def _ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start: start + length] of every pair, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


_ROW = "chunk long, bucket int, kind int, blob binary"
_NAMES = ["chunk", "bucket", "kind", "blob"]
#: kinds: a chunk's places, words asked for, ids answered
PLACES, WORDS, IDS = 0, 1, 2


def _rows(chunk: int, rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
        _NAMES,
    )


class _Chunk:
    """Distinct words by bucket in order of appearance, and the places of all pre-tokens."""

    def __init__(self, buckets: int):
        self.buckets, self.place, self.at, self.sizes, self.ids, self.bytes = buckets, {}, [], [], [], 0

    def add(self, doc_ids: pa.Array, texts: list[str], size: int, split) -> None:
        place = self.place
        number = place.setdefault
        for text in texts:
            words = split(text)
            self.at.append(np.fromiter((number(w, len(place)) for w in words), np.uint32, len(words)))
            self.sizes.append(len(words))
        self.ids.append(doc_ids)
        self.bytes += size

    def rows(self, kind: int) -> pa.RecordBatch:
        words = list(self.place)
        coded = [w.encode() for w in words]
        bucket = np.fromiter((xxhash.xxh64_intdigest(w) % self.buckets for w in coded), np.int64, len(coded))
        by_bucket = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[by_bucket], np.arange(self.buckets + 1))
        # a word's final place: by bucket, then by appearance; the answers come in that order
        final = np.empty(len(words), np.uint32)
        final[by_bucket] = np.arange(len(words), dtype=np.uint32)
        places = final[np.concatenate(self.at)] if self.at else np.zeros(0, np.uint32)
        sink = pa.BufferOutputStream()
        table = pa.table({"doc_id": pa.chunked_array(self.ids) if self.ids else pa.array([], pa.int64())})
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        low, high = (places & 255).astype(np.uint8), (places >> 8).astype("<u4").view(np.uint8).reshape(-1, 4)
        body = _squeeze(
            sink.getvalue().to_pybytes(), np.array(self.sizes, "<u4").tobytes(), low.tobytes(),
            *(np.ascontiguousarray(high[:, j]).tobytes() for j in range(3)), np.array([len(words)], "<u4").tobytes(),
        )
        name = xxhash.xxh64_intdigest(body) - (1 << 63)
        if kind == PLACES:
            return _rows(name, [(-1, PLACES, body)])
        out = []
        for b in range(self.buckets):
            mine = [coded[i] for i in by_bucket[edge[b]: edge[b + 1]].tolist()]
            if mine:
                out.append((b, WORDS, _squeeze(np.array([len(w) for w in mine], "<u4").tobytes(), b"".join(mine))))
        return _rows(name, out)


@lean
def _chunk_batches(batches: Iterator[pa.RecordBatch], buckets: int, pattern: str, kind: int) -> Iterator[pa.RecordBatch]:
    split = _splitter(pattern).findall
    chunk = _Chunk(buckets)
    for batch in batches:
        chunk.add(batch.column("doc_id"), batch.column("text").to_pylist(), batch.column("text").nbytes, split)
        if chunk.bytes >= CHUNK_BYTES:
            yield chunk.rows(kind)
            chunk = _Chunk(buckets)
    if chunk.sizes:
        yield chunk.rows(kind)


@lean
def _answer_batches(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket: each bucket's distinct words are encoded once, while its rows pass."""
    encode = _encoder(path, pattern)._encode_single_piece
    known: dict[bytes, list[int]] = {}
    current = None
    for batch in batches:
        for chunk, bucket, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "bucket", "blob"))):
            if bucket != current:
                known, current = {}, bucket
            sizes, text = _unsqueeze(blob)
            ends = np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64)
            raw = bytes(text)
            words = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            ids = []
            for w in words:
                found = known.get(w)
                if found is None:
                    found = known[w] = encode(w)
                ids.append(found)
            lengths = np.fromiter(map(len, ids), np.uint32, len(ids))
            flat_ids = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            yield _rows(chunk, [(bucket, IDS, _squeeze(lengths.astype("<u4").tobytes(), flat_ids.astype("<u4").tobytes()))])


def _assemble(places: bytes, answers: list[bytes]) -> Iterator[pa.RecordBatch]:
    ids, sizes, low, *high, n_words = _unsqueeze(places)
    doc_ids = pa.ipc.open_stream(pa.py_buffer(ids)).read_all().column("doc_id").combine_chunks()
    sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
    at = np.frombuffer(low, np.uint8).astype(np.int64)
    for j, plane in enumerate(high):
        at |= np.frombuffer(plane, np.uint8).astype(np.int64) << (8 * (j + 1))
    parts = [_unsqueeze(a) for a in answers]
    lengths = np.concatenate([np.frombuffer(p[0], "<u4") for p in parts] or [np.zeros(0, "<u4")]).astype(np.int64)
    table = np.concatenate([np.frombuffer(p[1], "<u4") for p in parts] or [np.zeros(0, "<u4")])
    if len(lengths) != np.frombuffer(n_words, "<u4")[0]:
        raise RuntimeError("a chunk's words were not all answered: the input changed between two scans")
    starts = np.cumsum(lengths) - lengths
    edge = np.r_[0, np.cumsum(sizes)]
    tokens = np.r_[0, np.cumsum(lengths[at])][edge]
    begin = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(tokens, tokens[begin] + OUT_BYTES // 4, side="right")) - 1)
        end = min(end, len(sizes))
        word = at[edge[begin]: edge[end]]
        out = _ragged(table, starts[word], lengths[word])
        ends = ((tokens[begin: end + 1] - tokens[begin]) * 4).astype(np.int32)
        blob = pa.Array.from_buffers(pa.binary(), end - begin, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.astype("<u4").tobytes())])
        yield pa.RecordBatch.from_arrays([doc_ids.slice(begin, end - begin), blob], ["doc_id", "ids"])
        begin = end


@lean
def _assemble_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (chunk, copy, kind, bucket): places, then answers."""
    current, places, answers, seen = None, [], [], None

    def flush() -> Iterator[pa.RecordBatch]:
        for p in places:
            yield from _assemble(p, answers)

    for batch in batches:
        for chunk, bucket, kind, blob in zip(*(batch.column(c).to_pylist() for c in _NAMES)):
            if chunk != current:
                yield from flush()
                current, places, answers, seen = chunk, [], [], None
            if kind == PLACES:
                places.append(blob)
            elif bucket != seen:  # chunks of equal content ask alike: one answer serves all
                answers.append(blob)
                seen = bucket
    yield from flush()


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every row as little-endian unsigned 32-bit integers."""
    spark = prepare(docs.sparkSession)
    path, pattern = vocabulary or default_vocabulary(), pattern or default_pattern()
    buckets = max(8, shuffle_partitions(spark))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    places, words = (rows.mapInArrow(lambda b, k=k: _chunk_batches(b, buckets, pattern, k), _ROW) for k in (PLACES, WORDS))
    answers = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: _answer_batches(b, path, pattern), _ROW)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return places.unionAll(answers).repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket").mapInArrow(
        _assemble_batches, f"doc_id {kind}, ids binary"
    )


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded(ids, ...)`` with decoded (binary), the concatenated bytes of its tokens."""
    prepare(encoded.sparkSession)
    path = vocabulary or default_vocabulary()
    names = encoded.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, table = token_table(path)
        for batch in batches:
            offsets, data = flat(batch.column("ids"))
            ids = np.frombuffer(data.tobytes(), "<u4")
            length = edges[ids + 1] - edges[ids]
            out = _ragged(table, edges[ids], length)
            ends = np.r_[0, np.cumsum(length)][offsets // 4].astype(np.int32)
            decoded = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*names, "decoded"])

    return encoded.mapInArrow(run, fields + ", decoded binary")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode(encode(documents(spark, sf_dir)))
    return done.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {"op5_bpe_distinct_words": op5_bpe}
