"""Table-level cleaning operators.

Dictionary lookups against code-fixed dictionaries are compiled into one
``CASE WHEN`` / map-literal expression, so they run as a projection inside
whole-stage codegen: no join, no shuffle, and the dictionary size is bounded
by the code.  Dictionaries that arrive as DataFrames go through the join form
in ``operators.joins.dictionary_match``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims


# ---- C1 ----------------------------------------------------------------------------
def canonical_columns(df: DataFrame, aliases: dict = dims.COLUMN_ALIASES,
                      required: str | None = "restaurant_name") -> DataFrame:
    """Rename columns by the alias map: trimmed exact name first, then lower-cased.

    A UTF-8 byte-order mark on the first header is dropped.  Raises when the
    required column is absent after renaming.
    """
    mapping = {}
    for c in df.columns:
        key = c.replace("﻿", "").strip()
        mapping[c] = aliases.get(key, aliases.get(key.lower(), key))
    out = df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})
    if required and required not in out.columns:
        raise ValueError(f"missing required column {required!r} (after alias mapping)")
    return out


# ---- C2 ----------------------------------------------------------------------------
def add_missing_columns(df: DataFrame, spec: dict) -> DataFrame:
    """Add absent columns: ``spec = {name: (type, default)}``; the default fills every row (Q7)."""
    add = {c: F.lit(default).cast(t) for c, (t, default) in spec.items() if c not in df.columns}
    return df.withColumns(add) if add else df


# ---- C5 / C6 / W9 ------------------------------------------------------------------
def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None,
           keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by ``order_by``; deterministic, unlike dropDuplicates.

    Runs as ``groupBy(keys).agg(min_by(row, order))``: a hash aggregate with a
    map-side partial step, so a key holding a third of the rows is reduced to
    one candidate per map task before the shuffle (a window would sort the
    whole hot group in one task).  ``order_by`` must be a total order within a
    key for a deterministic pick; columns default to all non-key columns.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in (order_by or [F.col(c) for c in others])]
    ordkey = F.struct(*order) if len(order) > 1 else order[0]
    pick = F.min_by if keep == "first" else F.max_by
    if not others:
        return df.select(*keys).distinct()
    agg = df.groupBy(*keys).agg(pick(F.struct(*others), ordkey).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def first_wins(df: DataFrame, keys, order_by) -> DataFrame:
    return dedupe(df, keys, order_by, "first")


def last_wins(df: DataFrame, keys, order_by) -> DataFrame:
    return dedupe(df, keys, order_by, "last")


# ---- C7 ----------------------------------------------------------------------------
def map_literal(mapping: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def normalize_area_exact(df: DataFrame, col: str = "district", aliases: dict | None = None) -> DataFrame:
    """Trimmed exact synonym lookup; unknown -> NULL (a map literal, no join)."""
    aliases = aliases or dims.district_aliases()
    return df.withColumn(col, F.try_element_at(map_literal(aliases), F.trim(F.col(col).cast("string"))))


# ---- C8 ----------------------------------------------------------------------------
def area_contains_expr(cols: Sequence[str], area_dict: dict = dims.BUSINESS_AREA_DICT,
                       match_names: bool = True) -> Column:
    """First dictionary hit over the texts in order; within a text, area names
    before business areas, each in dictionary order (Q9)."""
    expr = None
    for c in cols:
        text = F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
        pairs = []
        if match_names:
            pairs += [(d, d) for d in area_dict]
        pairs += [(d, a) for d, terms in area_dict.items() for a in terms if a]
        for district, term in pairs:
            cond = (text != "") & text.contains(term)
            expr = F.when(cond, district) if expr is None else expr.when(cond, district)
    return expr


def normalize_area_contains(df: DataFrame, cols: Sequence[str] = ("district", "business_area", "address"),
                            area_dict: dict = dims.BUSINESS_AREA_DICT, out: str = "district",
                            match_names: bool = True) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumn(out, area_contains_expr(present, area_dict, match_names))


# ---- C9 ----------------------------------------------------------------------------
def infer_area_rules(df: DataFrame, area_col: str, address_col: str, exact: dict = dims.AREA_RULES_EXACT,
                     address_rules: Sequence[tuple] = dims.AREA_RULES_ADDRESS,
                     default: str | None = dims.AREA_RULES_DEFAULT, exact_late: dict | None = None,
                     out: str = "district") -> DataFrame:
    """CASE ladder: exact business-area lists, then address keywords (LIKE), then the default."""
    ba = F.trim(F.col(area_col))
    expr = None
    for rules in (exact, exact_late or {}):
        for district, names in rules.items():
            cond = ba.isin(list(names))
            expr = F.when(cond, district) if expr is None else expr.when(cond, district)
    for kw, district in address_rules:
        cond = F.col(address_col).like(f"%{kw}%")
        expr = F.when(cond, district) if expr is None else expr.when(cond, district)
    expr = expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)
    return df.withColumn(out, expr)


# ---- C10 ---------------------------------------------------------------------------
def invert_groups(groups: dict) -> dict:
    """``{group: [labels]}`` -> ``{label: group}``, first group listing a label wins."""
    out = {}
    for g, labels in groups.items():
        for lab in labels:
            out.setdefault(lab, g)
    return out


def merge_categories(df: DataFrame, col: str, groups: dict = dims.CATEGORY_MERGE, out: str | None = None) -> DataFrame:
    """Exact trimmed label -> merged group, anything else NULL (map literal lookup)."""
    return df.withColumn(out or col, F.try_element_at(map_literal(invert_groups(groups)), F.trim(F.col(col))))


# ---- C11 ---------------------------------------------------------------------------
def category_synonym_expr(col: str, groups: dict = dims.CUISINE_DICT, default: str = "其他") -> Column:
    """Case-insensitive contains; first group (then term) in dictionary order wins;
    blank -> ``default``; unmatched -> the whole value
    (``enforce_schema`` rejects over-long ones)."""
    v = F.trim(F.coalesce(F.col(col).cast("string"), F.lit("")))
    low = F.lower(v)
    expr = F.when(v == "", F.lit(default))
    for g, terms in groups.items():
        for t in terms:
            expr = expr.when(low.contains(t.lower()), g)
    return expr.otherwise(v)


def normalize_category_synonym(df: DataFrame, col: str = "cuisine_type", groups: dict = dims.CUISINE_DICT,
                               default: str = "其他") -> DataFrame:
    return df.withColumn(col, category_synonym_expr(col, groups, default))


# ---- C18 ---------------------------------------------------------------------------
def drop_blank_names(df: DataFrame, col: str = "restaurant_name", extra_blanks: Sequence[str] = ()) -> DataFrame:
    cond = F.col(col).isNotNull() & (F.trim(F.col(col).cast("string")) != "")
    for b in extra_blanks:
        cond = cond & (F.trim(F.col(col)) != b)
    return df.where(cond)


# ---- C19 ---------------------------------------------------------------------------
def stamp_provenance(df: DataFrame, source: str, at: str | None = None, source_col: str = "data_source",
                     time_col: str = "crawl_time", keep_existing: bool = False) -> DataFrame:
    """Constant source (existing non-null values kept when asked) and a load time.

    ``at`` is a literal timestamp (tests, reproducible loads); None uses the
    query start time.
    """
    ts = F.lit(at).cast("timestamp_ntz") if at else F.current_timestamp()
    src = F.coalesce(F.col(source_col), F.lit(source)) if keep_existing and source_col in df.columns else F.lit(source)
    return df.withColumns({source_col: src, time_col: ts})


# ---- C20 ---------------------------------------------------------------------------
def select_target(df: DataFrame, columns: Sequence[str], types: dict | None = None) -> DataFrame:
    """Final projection in a fixed order; absent columns come out as typed NULLs."""
    types = types or {}
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string"))).alias(c)
                       for c in columns])


# ---- C21 ---------------------------------------------------------------------------
def to_output_record(df: DataFrame) -> DataFrame:
    """Listing row in the response shape: renamed, price / rating / count NULL -> 0,
    coordinates as doubles."""
    def opt(c, alias, expr=None):
        return (expr if expr is not None else F.col(c)).alias(alias) if c in df.columns else F.lit(None).alias(alias)
    return df.select(
        opt("restaurant_id", "id"), opt("restaurant_name", "name"), opt("address", "address"),
        opt("phone", "phone"), opt("business_hours", "business_hours"),
        F.coalesce(F.col("avg_price").cast("double"), F.lit(0.0)).alias("avg_price"),
        F.coalesce(F.col("rating_overall").cast("double"), F.lit(0.0)).alias("rating"),
        F.coalesce(F.col("review_count").cast("long"), F.lit(0)).alias("review_count"),
        opt("cuisine_type", "cuisine_type"), opt("district", "district"), opt("business_area", "business_area"),
        opt("latitude", "latitude", F.col("latitude").cast("double") if "latitude" in df.columns else None),
        opt("longitude", "longitude", F.col("longitude").cast("double") if "longitude" in df.columns else None),
        opt("data_source", "data_source"))


# ---- C22 ---------------------------------------------------------------------------
def coalesce_source_fields(base: DataFrame, detail: DataFrame, key: str, overlay: Sequence[str],
                           fill_if_dash: Sequence[str] = (), missing: str = "-") -> DataFrame:
    """Overlay detail fields on the search row (detail wins when present and not ``-``);
    ``fill_if_dash`` fields are taken from the detail only where the base has ``-``."""
    d = detail.select(key, *[F.col(c).alias(f"_d_{c}") for c in set(overlay) | set(fill_if_dash)])
    j = base.join(d, key, "left")
    cols = {}
    for c in overlay:
        dv = F.col(f"_d_{c}")
        cols[c] = F.when(dv.isNotNull() & (dv != missing), dv).otherwise(F.col(c)) if c in base.columns else dv
    for c in fill_if_dash:
        cols[c] = F.when(F.col(c) == missing, F.coalesce(F.col(f"_d_{c}"), F.col(c))).otherwise(F.col(c))
    j = j.withColumns(cols)
    return j.drop(*[c for c in j.columns if c.startswith("_d_")])


# ---- C33 ---------------------------------------------------------------------------
def enforce_schema(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    """Cast to target types and split rows into (valid, rejects with a reason array).

    ``rules = {col: {"type": t, "not_null": bool, "max_len": n, "allowed": [...],
    "min": x, "max": y}}``.  A value that does not cast is a violation, not an error.
    """
    casts, reasons = {}, []
    for c, r in rules.items():
        raw = F.col(c)
        v = raw.try_cast(r["type"]) if "type" in r else raw
        casts[c] = v
        if "type" in r:
            reasons.append(F.when(raw.isNotNull() & v.isNull(), F.lit(f"{c}:type")))
        if r.get("not_null"):
            reasons.append(F.when(v.isNull() | (F.trim(raw.cast("string")) == ""), F.lit(f"{c}:not_null")))
        if "max_len" in r:
            reasons.append(F.when(F.length(raw.cast("string")) > r["max_len"], F.lit(f"{c}:length")))
        if "allowed" in r:
            reasons.append(F.when(~raw.isin(list(r["allowed"])), F.lit(f"{c}:allowed")))
        if "min" in r:
            reasons.append(F.when(v < F.lit(r["min"]), F.lit(f"{c}:min")))
        if "max" in r:
            reasons.append(F.when(v > F.lit(r["max"]), F.lit(f"{c}:max")))
    checked = df.withColumn("rejected_reason", F.filter(F.array(*reasons), lambda x: x.isNotNull()))
    valid = checked.where(F.size("rejected_reason") == 0).withColumns(casts).drop("rejected_reason")
    rejects = checked.where(F.size("rejected_reason") > 0)  # raw values kept for inspection
    return valid, rejects


LISTING_RULES = {
    "restaurant_id": {"type": "string", "not_null": True, "max_len": 50},
    "restaurant_name": {"type": "string", "not_null": True, "max_len": 200},
    "avg_price": {"type": "decimal(10,2)", "min": 0},
    "rating_overall": {"type": "decimal(3,1)", "min": 0, "max": 5},
    "review_count": {"type": "int", "min": 0},
}

# The target columns in the order of the reference table.
LISTING_COLUMNS = ["restaurant_id", "restaurant_name", "address", "phone", "business_hours", "avg_price",
                   "rating_overall", "review_count", "cuisine_type", "district", "business_area", "latitude",
                   "longitude", "data_source", "crawl_time"]
LISTING_TYPES = {"avg_price": "double", "rating_overall": "double", "review_count": "long", "latitude": "double",
                 "longitude": "double", "crawl_time": "timestamp"}


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
