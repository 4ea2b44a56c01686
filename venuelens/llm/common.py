"""Shared pieces of the operators: session settings, flat text buffers, rolling hashes."""

from __future__ import annotations

import ctypes
import sys
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from venuelens.session import checkpoint_dir, ship_package

#: Arrow batches handed to Python: bounded in rows and in bytes, since one document may be very long.
BATCH_ROWS = 2000
BATCH_BYTES = 2 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers, bound the Arrow batches, name the checkpoint folder."""
    ship_package(spark)
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lean(batches_of):
    """Wraps a mapInArrow function: when its task is done, freed memory goes back to the system.

    Workers are reused by later tasks and stages, whose memory must fit beside what stays.
    """

    @wraps(batches_of)
    def run(*args, **kwargs):
        yield from batches_of(*args, **kwargs)
        pa.default_memory_pool().release_unused()
        if sys.platform.startswith("linux"):
            ctypes.CDLL(None).malloc_trim(0)

    return run


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def carry(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` as the columns ``names`` and one struct, rest, of all others, so no further name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*[F.col(f"`{n}`") for n in names], F.struct(*(others or [F.lit(True).alias("none")])).alias("rest"))


def restored(docs: DataFrame, names: tuple[str, ...]) -> list[Column]:
    """The columns of ``docs`` out of what ``carry(docs, *names)`` gave."""
    return [F.col(c) if c in names else F.col("rest").getField(c).alias(c) for c in docs.columns]


def widened(schema: StructType, **kinds: str) -> StructType:
    """``schema`` with more fields, by type name."""
    out = StructType(list(schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return starts - starts[0], raw[starts[0]: starts[-1]]


def doc_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each byte (or unit) under offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


_RNG = np.random.default_rng(20240229)
#: One random 64-bit value a byte; fixed by the seed, so hashes agree in all tasks.
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ..., n - 1 (mod 2**64); the longest table so far is kept in the worker."""
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        _POWERS[int(base)] = held
    return held[:n]


def slices(offsets: np.ndarray, most: int = 1 << 19) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes together (a longer row stands alone)."""
    out, begin = [], 0
    while begin < len(offsets) - 1:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1)
        out.append((begin, end))
        begin = end
    return out


class PrefixHash:
    """Polynomial hash (mod 2**64) of any slice of a byte buffer, from one prefix sum.

    ``of(start, end)`` depends on the bytes of the slice alone, not on where it lies.
    """

    def __init__(self, data: np.ndarray):
        values = BYTE_VALUES[data]
        values *= powers(BASE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])
        self.shift = powers(BASE_INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.shift[start]

    def windows(self, k: int) -> np.ndarray:
        """Hash of every k-byte window."""
        out = self.sums[k:] - self.sums[:-k]
        out *= self.shift[: len(out)]
        return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def sum_by(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of small integers by row."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)
