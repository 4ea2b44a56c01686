"""Packing into fixed-length sequences by harmonic classes.

Each document becomes its token ids and an end id. Class k takes lengths above
CAPACITY / (k + 1) and up to CAPACITY / k, so k pieces of it always fit and fill one
sequence: classes need no search, and each worker fills its own from a running number.

* Cutting. Whole sequences of CAPACITY are cut off first. A rest that would leave more than
  1 / SLACK of itself unused in its class's share is cut once more at the next class's full
  share CAPACITY // (k + 1), and so on; what stays over is small.
* Numbering. Pieces are numbered by (partition, class) where they were made; prefix sums over
  the small table of counts by partition and class turn that into numbers of the class, and
  number // k is the sequence. Bins are full but for the last of each class.
* The pieces of those last bins (fewer than k a class, whatever the input) are packed
  together by best fit in one small group.

Null or empty text is one end id. Documents may have any length; repeated rows are packed
each for itself. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelens.llm.common import documents, flat, lean, prepare, slices

CAPACITY = 4096
END_ID = 2
SLACK = 32
#: Rests of so few tokens are never cut.
SMALL = 16
#: Distinct words whose ids a worker remembers; past it the memory starts anew.
REMEMBERED = 300_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_WORKER: dict = {}
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE's letter of each byte: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(rest)}}


def _tools(path: str):
    """(tokenizer, its model, splitter of normalised text into words, byte letters, ids of known words)."""
    if path not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import regex
        from tokenizers import Tokenizer

        with open(path) as f:
            shape = json.load(f)
        steps = [x["type"] for x in shape["normalizer"]["normalizers"]]
        split, by_bytes = shape["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["pattern"]["Regex"] != _PATTERN or by_bytes["use_regex"]:
            raise ValueError(f"{path}: words are not split as expected (NFC, white space, lower case; one pattern; byte letters)")
        tokenizer = Tokenizer.from_file(path)
        letters = _byte_letters()
        _WORKER[path] = (tokenizer, tokenizer.model, regex.compile(split["pattern"]["Regex"]).findall, letters, _Ids(tokenizer.model, letters))
    return _WORKER[path]


#: The vocabulary's pattern as it reads on lower-case ASCII, for a faster splitter.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_split_ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+").findall


def _words(text: str, split) -> list[str]:
    """The words of a text: what the vocabulary's normaliser and pattern make of it."""
    if text.isascii():
        return _split_ascii(text.lower())
    return split(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())  # letter by letter: no final sigma


class _Ids:
    """Ids of the words met so far, in one table: a word's number is looked up once an occurrence."""

    def __init__(self, model, letters: dict[int, int]):
        self.model, self.letters = model, letters
        self.clear()

    def clear(self) -> None:
        self.place: dict = defaultdict(itertools.count().__next__)  # a new word gets the next number
        self.starts, self.lengths, self.table, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0

    def _room(self, words: int, ids: int) -> None:
        while words > len(self.starts):
            self.starts, self.lengths = np.r_[self.starts, np.zeros_like(self.starts)], np.r_[self.lengths, np.zeros_like(self.lengths)]
        while ids > len(self.table):
            self.table = np.r_[self.table, np.zeros_like(self.table)]

    def _put(self, numbers: list[int], found: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._room(max(numbers, default=-1) + 1, self.size + int(sizes.sum()))
        at = np.array(numbers, np.int64)
        self.starts[at], self.lengths[at] = self.size + np.cumsum(sizes) - sizes, sizes
        self.table[self.size: self.size + int(sizes.sum())] = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.size += int(sizes.sum())

    def numbers(self, words: Iterable[str], count: int) -> np.ndarray:
        """The number of each word; new words are encoded."""
        place = self.place
        before = len(place)
        out = np.fromiter(map(place.__getitem__, words), np.int64, count)
        if len(place) > before:
            tokenize, letters = self.model.tokenize, self.letters
            new = list(itertools.islice(reversed(place), len(place) - before))[::-1]
            self._put(list(range(before, len(place))), [[t.id for t in tokenize(w.encode().decode("latin-1").translate(letters))] for w in new])
        return out

    def own(self, ids: list[int]) -> int:
        """The number of a run of ids that stands for itself."""
        number = self.place[len(self.place), "own"]
        self._put([number], [ids])
        return number


def token_ids(texts: list[bytes], path: str, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids): the ids of each UTF-8 text, each followed by end_id.

    Each distinct word is encoded once. A text with the name of a special token in it goes through the tokenizer whole.
    """
    tokenizer, _, split, _, known = _tools(path)
    if len(known.place) > REMEMBERED:
        known.clear()
    parts = []
    end = [] if end_id is None else [known.own([end_id])]
    for raw in texts:
        text = raw.decode("utf-8")
        if any(x in text for x in _SPECIAL):
            parts.append(np.array([known.own(tokenizer.encode(text, add_special_tokens=False).ids), *end], np.int64))
        else:
            words = _words(text, split)
            parts.append(np.r_[known.numbers(words, len(words)), end].astype(np.int64))
    sizes = np.array([len(p) for p in parts], np.int64)
    at = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    count = known.lengths[at]
    total = np.r_[0, np.cumsum(count)]
    ids = known.table[np.repeat(known.starts[at] - total[:-1], count) + np.arange(total[-1])]
    return total[np.r_[0, np.cumsum(sizes)]], ids


def cuts(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with ``lengths`` tokens."""
    whole = lengths // capacity
    doc = np.repeat(np.arange(len(lengths)), whole)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)) * capacity
    out = [(doc, start, np.full(len(doc), capacity, np.int64))]
    doc = np.flatnonzero(lengths % capacity)
    start, rest = whole[doc] * capacity, lengths[doc] % capacity
    while len(doc):
        k = capacity // rest
        fits = (rest <= SMALL) | ((capacity // k - rest) * SLACK <= rest)
        size = np.where(fits, rest, capacity // (k + 1))
        out.append((doc, start, size))
        doc, start, rest = doc[~fits], (start + size)[~fits], (rest - size)[~fits]
    doc, start, size = (np.concatenate([o[i] for o in out]) for i in range(3))
    order = np.lexsort((start, doc))
    return doc[order], start[order], size[order]


@lean
def _piece_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = flat(batch.column("text"))
        raw = data.tobytes()
        for a, b in slices(offsets):
            edge, ids = token_ids([raw[offsets[i]: offsets[i + 1]] for i in range(a, b)], path)
            size = np.diff(edge)
            doc, start, length = cuts(size)
            ends = (np.r_[0, np.cumsum(length)] * 4).astype(np.int32)
            blob = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(a + doc)), pa.array(start), pa.array(length), pa.array(size[doc]), blob],
                ["doc_id", "start", "length", "doc_tokens", "ids"],
            )


def pieces(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): the pieces of every row; ids are little-endian unsigned 32-bit integers."""
    prepare(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda b: _piece_batches(b, path), f"doc_id {kind}, start long, length long, doc_tokens long, ids binary"
    )


def _best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each length, longest first into the fullest sequence that has room."""
    order = np.argsort(-lengths, kind="stable")
    left: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by room
    out, number = np.zeros(len(lengths), np.int64), 0
    most = 0
    for i in order.tolist():
        need = int(lengths[i])
        room = next((r for r in range(need, most + 1) if left[r]), None)
        if room is None:
            room, s = capacity, number
            number += 1
        else:
            s = left[room].pop()
        out[i] = s
        left[room - need].append(s)
        most = max(most, room - need)
    return out


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found(length, ...)`` with sequence_id and offset added. Rows are written to the checkpoint folder first."""
    names = found.columns
    made = found.withColumns({
        "_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id(), "_k": F.floor(F.lit(capacity) / F.col("length")).cast("long"),
    }).checkpoint()
    counts = made.groupBy("_k", "_part").count()
    by_class = Window.partitionBy("_k")
    before = counts.select(
        "_k", "_part", (F.sum("count").over(by_class.orderBy("_part")) - F.col("count")).alias("_before"), F.sum("count").over(by_class).alias("_total")
    )
    numbered = made.withColumn("_n", F.row_number().over(Window.partitionBy("_k", "_part").orderBy("_row")) - 1).join(before, ["_k", "_part"])
    numbered = numbered.withColumn("_bin", F.floor((F.col("_before") + F.col("_n")) / F.col("_k")))
    full = numbered.withColumn("sequence_id", F.when(F.col("_bin") < F.floor(F.col("_total") / F.col("_k")), F.col("_bin") * (2 * capacity) + F.col("_k"))).checkpoint()
    rest = full.where("sequence_id is null").select("_row", "length", F.lit(0).alias("_one"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row")
        return pd.DataFrame({"_row": frame["_row"], "_rest": _best_fit(frame["length"].to_numpy(), capacity) * (2 * capacity)})

    rest = rest.groupBy("_one").applyInPandas(fit, "_row long, _rest long")  # fewer than k pieces of each class k
    done = full.join(rest, "_row", "left").withColumn("sequence_id", F.coalesce("sequence_id", "_rest"))
    so_far = Window.partitionBy("sequence_id").orderBy("_row")  # at most ``capacity`` rows
    return done.withColumn("offset", F.sum("length").over(so_far) - F.col("length")).select(*names, "sequence_id", "offset")


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The placed pieces of every row of ``docs``, by checksum: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    made = pieces(docs, vocabulary).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(made).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def sequences(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each at most CAPACITY ids, unpadded."""
    placed = place(pieces(docs, vocabulary))
    ordered = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return ordered.select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op3_packing_harmonic": op3_packing}
