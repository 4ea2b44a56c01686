"""Joins (J1-J10).

Join strategy is left to Catalyst/AQE (sort-merge, shuffled hash, or a
broadcast chosen from runtime sizes).  Explicit ``broadcast`` hints are only
put on tables whose size is fixed by code (band tables) or counted first
(dictionaries).  The theta joins avoid all-pairs work: J7 compares rows with a
small dictionary and joins substrings with a large one; J8 turns the price band into an equi-join on a log-price bucket,
so only listings with nearby prices meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..session import written
from .bands import UNIT, price_units
from .filters import page as _page

#: Terms of a dictionary that is broadcast and compared row by row.
SMALL_DICTIONARY = 1000


# ---- J1 / J2 -----------------------------------------------------------------------
def favorites_only(df: DataFrame, fav: DataFrame, user=None, key: str = "listing_id") -> DataFrame:
    """Listings in the user's favorites (all users' when ``user`` is None): left semi join."""
    f = fav if user is None else fav.where(F.col("user_id") == F.lit(user))
    return df.join(f.select(key), key, "left_semi")


def exclude_favorites(df: DataFrame, fav: DataFrame, user=None, key: str = "listing_id") -> DataFrame:
    f = fav if user is None else fav.where(F.col("user_id") == F.lit(user))
    return df.join(f.select(key), key, "left_anti")


# ---- J3 ----------------------------------------------------------------------------
def user_favorites(df: DataFrame, fav: DataFrame, user=None, page_no: int | None = None, size: int = 20,
                   key: str = "listing_id") -> DataFrame:
    """Favorites joined to their listing (dangling favorites drop), newest first."""
    f = fav if user is None else fav.where(F.col("user_id") == F.lit(user))
    j = f.join(df, key, "inner")
    order = [F.desc("created_at"), F.asc("user_id"), F.asc(key)]
    return _page(j, order, page_no, size) if page_no else j


# ---- J4 ----------------------------------------------------------------------------
REVIEW_SORTS = {"time": ["ts"], "rating": ["rating", "ts"], "likes": ["likes"]}  # all descending


def listing_reviews(df: DataFrame, rv: DataFrame, listing=None, sort_by: str = "time", page_no: int | None = None,
                    size: int = 20, key: str = "listing_id") -> DataFrame:
    """Reviews of existing listings (semi join on the listing table), sorted, optionally paged."""
    r = rv if listing is None else rv.where(F.col(key) == F.lit(listing))
    r = r.join(df.select(key), key, "left_semi")
    order = [F.desc(c) for c in REVIEW_SORTS[sort_by]] + [F.asc("review_id"), F.asc("user_id")]
    return _page(r, order, page_no, size) if page_no else r


# ---- J5 ----------------------------------------------------------------------------
def enrich_search_with_detail(search: DataFrame, detail: DataFrame | None = None,
                              location: DataFrame | None = None, reviews: DataFrame | None = None,
                              key: str = "listing_id", overlay: Sequence[str] = (),
                              fill_if_dash: Sequence[str] = ()) -> DataFrame:
    """search (left) detail (left) location (left) review summary on the shop key.

    Detail fields overlay the search row (C22); the others add columns.
    """
    from .cleaning import coalesce_source_fields
    out = search
    if detail is not None:
        out = coalesce_source_fields(out, detail, key, overlay, fill_if_dash)
    for extra in (location, reviews):
        if extra is not None:
            out = out.join(extra, key, "left")
    return out


# ---- J6 ----------------------------------------------------------------------------
def fetch_backlog(df: DataFrame, done: DataFrame, key: str = "listing_id") -> DataFrame:
    """Listings that have no row in ``done`` (no detail / no reviews yet), Q19 intent."""
    return df.join(done.select(key), key, "left_anti")


# ---- J7 ----------------------------------------------------------------------------
def dictionary_match(df: DataFrame, key: str, col: str, dim: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Rows x dictionary terms on ``contains``: ``(key, grp, term, priority)`` per hit.

    A dictionary of at most ``SMALL_DICTIONARY`` terms (counted first) is broadcast and each
    row is compared with every term in the task that reads it; a larger one is joined by
    ``substring_join``.  Both give the same rows.
    """
    if dim.limit(SMALL_DICTIONARY + 1).count() > SMALL_DICTIONARY:
        return substring_join(df, key, col, dim, case_insensitive)
    text = F.lower(F.col(col)) if case_insensitive else F.col(col)
    term = F.lower(F.col("term")) if case_insensitive else F.col("term")
    return (df.select(key, col).join(F.broadcast(dim), text.contains(term), "inner")
            .select(key, "grp", "term", "priority"))


#: Bits of the filter of term beginnings.
FILTER_BITS = 1 << 22
#: Bytes of texts that are hashed at once, more only if one text has more.
HASHED_BYTES = 4_000_000
_BASE = 0x9E3779B97F4A7C15


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """The place in the filter of the ``width`` bytes (a power of two) from each position on; windows double their width step by step."""
    h, power = data.astype(np.uint64) + np.uint64(1), _BASE
    done = 1
    while done < width:
        h = h[:-done] * np.uint64(power) + h[done:]
        power, done = power * power % (1 << 64), 2 * done
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)) % np.uint64(FILTER_BITS)


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, width, place): a term's bytes, the largest power of two within, and its beginning's place in the filter of that width."""
    for batch in batches:
        found = set()
        for term in batch.column(0).to_pylist():
            width = 1 << len(term).bit_length() - 1 if term else 0
            found.add((len(term), width, int(_hashes(np.frombuffer(term[:width], np.uint8), width)[0]) if term else 0))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(found), strict=True)], names=["n", "width", "place"])


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(np.r_[0, pc.binary_length(batch.column("_text")).to_numpy()])
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(size, size[low] + HASHED_BYTES, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def _windows(batches: Iterator[pa.RecordBatch], key: str, lengths: dict[int, list[int]], filters: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
    """(key, _term): a row's different substrings of the lengths that terms have, where the filter has their beginning."""
    bits = {w: np.unpackbits(np.frombuffer(f, np.uint8)).view(bool) for w, f in filters.items()}
    for batch in (part for whole in batches for part in _portions(whole)):
        texts = batch.column("_text")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets.astype(np.int64) - offsets[0]
        whole, found = data.tobytes(), set()
        if 0 in lengths:
            found |= {(row, b"") for row in range(len(texts))}
        for width, sizes in lengths.items():
            if not width or len(data) < width:
                continue
            at = np.flatnonzero(bits[width][_hashes(data, width)])
            row = np.searchsorted(offsets, at, side="right") - 1
            for n in sizes:
                inside = at + n <= offsets[row + 1]
                found |= {(r, whole[i:i + n]) for i, r in zip(at[inside].tolist(), row[inside].tolist(), strict=True)}
        rows, terms = zip(*sorted(found), strict=True) if found else ((), ())
        for low in range(0, len(rows), 100_000):
            part = slice(low, low + 100_000)
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows[part], pa.int64())), pa.array(terms[part], pa.binary())], names=[key, "_term"])


def substring_join(df: DataFrame, key: str, col: str, dim: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """``dictionary_match`` for a dictionary of any size: an equi-join of substrings with terms.

    A row gives its different substrings of each length that some term has, as bytes, and they meet
    the terms by value. Only positions where a filter has the next bytes (the largest power of two within
    the term's length) give substrings: their hashes are found for all positions of a batch of texts at once.
    The filter is FILTER_BITS of bits a width, whatever the dictionary's size; where it is full, more substrings
    go to the join and none are lost. Work grows with text x widths, at most as many as the longest term's length
    has binary digits, and with hits. A null text or term matches nothing.
    """
    text = F.lower(F.col(col)) if case_insensitive else F.col(col)
    term = F.lower(F.col("term")) if case_insensitive else F.col("term")
    terms = dim.select("grp", "term", "priority", term.cast("binary").alias("_term")).where("_term is not null")
    starts = terms.select("_term").mapInArrow(_beginnings, "n long, width long, place long")
    sizes = written(starts.distinct(), "beginnings")
    lengths: dict[int, list[int]] = {}
    for r in sizes.select("width", "n").distinct().orderBy("n").collect():
        lengths.setdefault(r.width, []).append(r.n)
    places = sizes.select("width", "place").distinct().toArrow()
    filters = {}
    for width in lengths:
        bits = np.zeros(FILTER_BITS, bool)
        bits[places.column("place").to_numpy()[places.column("width").to_numpy() == width]] = True
        filters[width] = np.packbits(bits).tobytes()
    rows = df.select(F.col(key), text.cast("binary").alias("_text")).where("_text is not null")
    found = rows.mapInArrow(lambda batches: _windows(batches, key, lengths, filters), StructType([rows.schema[key], StructField("_term", BinaryType())]))
    return found.join(terms, "_term").select(key, "grp", "term", "priority")


def first_match(matches: DataFrame, key: str) -> DataFrame:
    """The highest-priority (smallest) dictionary hit per key."""
    return matches.groupBy(key).agg(F.min_by("grp", "priority").alias("grp"))


# ---- J8 ----------------------------------------------------------------------------
def find_competitors(df: DataFrame, band: float = 0.2, key: str = "listing_id", price: str = "price",
                     group: Sequence[str] = ("business_area", "category"), targets: DataFrame | None = None) -> DataFrame:
    """Pairs (listing, competitor) in the same business area and category whose prices
    differ by at most ``band`` x the listing's price (unknown price 0 excluded; compared as whole
    ten-thousandths). For totals over competitors use ``bands.band_totals``, which makes no pairs.

    Exact range join: both sides get a log-price bucket of width ``log(1+band)``;
    the probe side is repeated for the few bucket offsets the band can reach,
    so the equi-join on (group, bucket) only pairs listings of nearby price and
    a crowded group is spread over many buckets.  ``targets`` restricts the left side.
    Both sides are listings, so the join is a sort-merge join whatever their files' size:
    repetitive listings are small on disk and many times that in a broadcast.
    """
    if not 0 < band < 1:
        raise ValueError("band must be in (0, 1)")
    w = math.log1p(band)
    lo = math.floor(math.log(1 - band) / w) - 1
    offsets = list(range(lo, 2))
    g = list(group)
    base = df.where(F.col(price) > 0).select(key, *g, F.col(price).cast("double").alias("p"))
    bucket = F.floor(F.log(F.col("p")) / F.lit(w)).cast("long")
    left = (targets if targets is not None else df).where(F.col(price) > 0).select(
        F.col(key).alias("listing_id"), *g, F.col(price).cast("double").alias("p1"))
    left = left.withColumn("b", F.explode(F.array(*[F.floor(F.log(F.col("p1")) / F.lit(w)).cast("long") + o
                                                    for o in offsets])))
    left = left.withColumn("c1", price_units(F.col("p1")))
    right = base.select(F.col(key).alias("competitor_id"), *g, F.col("p").alias("p2"), bucket.alias("b"), price_units(F.col("p")).alias("c2"))
    j = left.join(right.hint("merge"), [*g, "b"], "inner")
    return (j.where((F.col("listing_id") != F.col("competitor_id"))
                    & (F.abs(F.col("c1") - F.col("c2")) * UNIT <= F.lit(round(band * UNIT)) * F.col("c1")))
            .select("listing_id", "competitor_id", *g,
                    F.round((F.col("p2") - F.col("p1")).cast("decimal(38,10)"), 2).cast("double").alias("price_gap")))


# ---- J9 ----------------------------------------------------------------------------
def orphan_check(child: DataFrame, parent: DataFrame, key: str = "listing_id") -> DataFrame:
    """Child rows whose parent key is missing (the foreign-key rule)."""
    return child.join(parent.select(key), key, "left_anti")


# ---- J10 ---------------------------------------------------------------------------
def band_join(df: DataFrame, col: str, bands: Sequence[tuple], closed: str = "right", key: str = "listing_id",
              close_last: bool = False) -> DataFrame:
    """Each row with the band containing ``col`` (half-open ranges of a fixed band table)."""
    spark = df.sparkSession
    rows = [(i + 1, label, float(lo) if lo is not None else None, float(hi) if hi is not None else None)
            for i, (label, lo, hi) in enumerate(bands)]
    bt = spark.createDataFrame(rows, "bucket int, label string, lo double, hi double")
    x = F.col(col).cast("double")
    last = F.col("bucket") == len(bands)
    if closed == "right":
        cond = (x > F.col("lo")) & (F.col("hi").isNull() | (x <= F.col("hi")))
    else:
        upper = (x <= F.col("hi")) & last if close_last else F.lit(False)
        cond = (x >= F.col("lo")) & (F.col("hi").isNull() | (x < F.col("hi")) | upper)
    return df.select(key, col).join(F.broadcast(bt), cond, "inner").select(key, col, "bucket", "label")
