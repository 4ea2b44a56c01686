"""Quality rules by repetition coverage.

Words are runs outside ASCII white space. Rolling hashes of word n-grams of several
lengths and of whole lines are compared inside each document, in numpy over an Arrow
batch at a time: a row never leaves its task and nothing is shuffled. The verdict
measures characters inside duplicated n-grams (all occurrences) and inside repeated
lines (occurrences after the first), each as a share of the document's word characters.

Null or empty text: all counts 0, ``base_failed`` true. Texts of any length are taken
whole. Repeated rows are judged alike. Columns other than ``doc_id`` and ``text`` are
ignored by :func:`measure` and kept by :func:`keep`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuelens.llm.common import BASE, PrefixHash, carry, doc_of, documents, flat, lean, mix, prepare, restored, slices, sum_by, widened

#: Trusted short documents with one repeated line reach 0.28 up to 9 words and 0.18 at 10.
#: Largest share of word characters inside n-grams found twice or more, by n.
DUPLICATE_SHARE = {5: 0.34, 6: 0.33, 7: 0.32, 8: 0.31, 9: 0.30, 10: 0.24}
#: Largest share of word characters in lines equal to an earlier line, and of such lines.
LINE_CHAR_SHARE = 0.25
LINE_SHARE = 0.40
#: Largest share of one word n-gram's characters, by n.
TOP_SHARE = {2: 0.32, 3: 0.31, 4: 0.30}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_SPACE = np.zeros(256, bool)
_SPACE[np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)] = True

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in DUPLICATE_SHARE) + ", "
    + ", ".join(f"top_chars_{n} long" for n in TOP_SHARE)
)


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found twice or more, equal to an earlier one), each by position."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def _covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Words covered by n-word windows that start where ``starts`` is true."""
    edge = np.zeros(len(starts) + n, np.int32)
    at = np.flatnonzero(starts)
    edge[at] += 1
    np.subtract.at(edge, at + n, 1)
    return np.cumsum(edge)[: len(starts)] > 0


def _top_chars(keys: np.ndarray, chars: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Most characters that occurrences of one n-gram found twice or more hold, by row."""
    out = np.zeros(n_rows, np.int64)
    if len(keys) == 0:
        return out
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    size = np.diff(np.r_[first, len(ranked)])
    total = np.add.reduceat(chars[order], first)
    many = size > 1
    np.maximum.at(out, rows[order[first[many]]], total[many])
    return out


def measures_of(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each document of a flat batch."""
    n = len(offsets) - 1
    owner = doc_of(offsets)
    starts_char = (data & 0xC0) != 0x80
    space = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[offsets[:-1]] = True
    head = head[:-1]
    word = ~space
    word_start = np.flatnonzero(word & (head | np.r_[True, space[:-1]])) if len(data) else np.zeros(0, np.int64)
    word_end = np.flatnonzero(word & np.r_[space[1:] | head[1:], True]) + 1 if len(data) else np.zeros(0, np.int64)
    chars_before = np.r_[0, np.cumsum(starts_char & word)]
    rows = owner[word_start] if len(data) else np.zeros(0, np.int64)
    chars = chars_before[word_end] - chars_before[word_start]
    out = {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": sum_by(chars, rows, n),
        "n_symbols": np.bincount(owner[_SYMBOL[data]], minlength=n),
    }
    hashes = PrefixHash(data)
    # lines: between line feeds, a document's ends also end a line
    feed = np.flatnonzero(data == 10)
    line_start = np.sort(np.r_[offsets[:-1], feed + 1])
    line_end = np.sort(np.r_[feed, offsets[1:]])
    line_row = np.searchsorted(offsets[1:], line_end, side="left") if n else np.zeros(0, np.int64)
    line_chars = chars_before[line_end] - chars_before[line_start]
    full = line_chars > 0
    line_start, line_end, line_row, line_chars = (x[full] for x in (line_start, line_end, line_row, line_chars))
    salt = mix(np.arange(1, n + 1, dtype=np.uint64) * BASE) if n else np.zeros(0, np.uint64)
    line_keys = mix(hashes.of(line_start, line_end) + (line_end - line_start).astype(np.uint64)) ^ salt[line_row]
    _, later = _repeated(line_keys)
    out["n_lines"] = np.bincount(line_row, minlength=n)
    out["n_dup_lines"] = np.bincount(line_row[later], minlength=n)
    out["dup_line_chars"] = sum_by(line_chars[later], line_row[later], n)

    word_keys = mix(hashes.of(word_start, word_end) + (word_end - word_start).astype(np.uint64))
    chars_upto = np.r_[0, np.cumsum(chars)]
    rolling = word_keys.copy()
    for length in range(2, max(DUPLICATE_SHARE) + 1):
        if len(rolling) <= 1:
            rolling = rolling[:0]
        else:
            rolling = rolling[:-1] * BASE + word_keys[length - 1:]
        inside = rows[: len(rolling)] == rows[length - 1:] if len(rolling) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        if length not in TOP_SHARE and length not in DUPLICATE_SHARE:
            continue
        keys = mix(rolling[at]) ^ salt[rows[at]]
        if length in TOP_SHARE:
            out[f"top_chars_{length}"] = _top_chars(keys, chars_upto[at + length] - chars_upto[at], rows[at], n)
        if length == 3 or length in DUPLICATE_SHARE:
            twice, _ = _repeated(keys)
            begins = np.zeros(len(rows), bool)
            begins[at[twice]] = True
            covered = _covered(begins, length)
            if length == 3:
                out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)
            else:
                out[f"dup_chars_{length}"] = sum_by(chars[covered], rows[covered], n)
    return out


@lean
def _map(batches: Iterator[pa.RecordBatch], names: list[str], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = flat(batch.column("text"))
        parts = [measures_of(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]]) for a, b in slices(offsets)]
        found = {c: np.concatenate([p[c] for p in parts] or [np.zeros(0)]) for c in names}
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in keep] + [pa.array(found[c].astype(np.int64)) for c in names], [*keep, *names]
        )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row of ``docs``."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    names = [x.split()[0] for x in MEASURES.split(", ")]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _map(batches, names, ["doc_id"]), f"doc_id {kind}, {MEASURES}"
    )


def _failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _clean():
    """The method's verdict: no measure above its share."""
    chars = F.col("word_chars")
    ok = (F.col("dup_line_chars") <= LINE_CHAR_SHARE * chars) & (F.col("n_dup_lines") <= LINE_SHARE * F.col("n_lines"))
    for n, share in DUPLICATE_SHARE.items():
        ok = ok & (F.col(f"dup_chars_{n}") <= share * chars)
    for n, share in TOP_SHARE.items():
        ok = ok & (F.col(f"top_chars_{n}") <= share * chars)
    return ok


def judge(measured: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    return measured.withColumn("base_failed", _failed()).withColumn("kept", ~F.col("base_failed") & _clean())


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    prepare(docs.sparkSession)
    names = [x.split()[0] for x in MEASURES.split(", ")]
    rows = carry(docs, "text")
    columns = rows.columns
    measured = rows.mapInArrow(lambda batches: _map(batches, names, columns), widened(rows.schema, **dict.fromkeys(names, "long")))
    return measured.where(~_failed() & _clean()).select(restored(docs, ("text",)))


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(measure(documents(spark, sf_dir)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[c for c in judged.columns if c.startswith(("dup_", "top_")) or c == "n_lines"],
    )


QUERIES = {"op10_repetition_coverage": op10_repetition}
