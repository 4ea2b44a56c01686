"""Cleaning pipelines (C30 importer, C31 dataset transform, C32 landing migration).

Each pipeline is one lazy plan: a chain of projections plus one dedupe
aggregate, no action in between.  The stage log of the importer is itself a
DataFrame built from one aggregate over the same plan (no ``count()`` per
stage); a caller that writes both the table and the log should persist the
cleaned frame or write it first and build the log from the written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import (blank_to_null, coerce_numeric, derive_key, gate_numeric_text, key_or_derived,
                         mask_phone, parse_count, parse_number, prefix_key)
from ..operators import cleaning as C


def _ingest_order(df: DataFrame, order_by) -> tuple[DataFrame, list]:
    if order_by:
        return df, list(order_by)
    # File order: ids are deterministic for the same input splits.
    return df.withColumn("_ingest", F.monotonically_increasing_id()), ["_ingest"]


# ---- C30 ---------------------------------------------------------------------------
def clean_listing_frame(df: DataFrame, phone_style: str = "strict", at: str | None = None,
                        source: str = "import", order_by: Sequence[str] | None = None,
                        aliases: dict = dims.COLUMN_ALIASES, district_aliases: dict | None = None) -> DataFrame:
    """Importer pipeline C1 -> C3 -> C5 -> C7 -> C12 -> C15 -> C18 -> C19, one lazy plan.

    Output keeps the file's columns (renamed) plus ``data_source``/``crawl_time``
    and a helper ``_district_unknown`` flag used by the log (dropped by
    ``clean_listing``).
    """
    df = C.canonical_columns(df, aliases, "restaurant_name")
    if "restaurant_id" not in df.columns:
        df = df.withColumn("restaurant_id", derive_key(["restaurant_name"], 16))
    df, order = _ingest_order(df, order_by)
    df = C.dedupe(df, ["restaurant_id"], order)
    if "_ingest" in df.columns:
        df = df.drop("_ingest")
    if "district" in df.columns:
        raw = F.col("district")
        df = C.normalize_area_exact(df.withColumn("_district_raw", raw), "district", district_aliases)
        df = df.withColumn("_district_unknown", F.col("_district_raw").isNotNull() & F.col("district").isNull()) \
               .drop("_district_raw")
    if "phone" in df.columns:
        df = df.withColumn("phone", mask_phone("phone", phone_style))
    for c in ("avg_price", "rating_overall", "review_count", "latitude", "longitude"):
        if c in df.columns:
            df = df.withColumn(c, coerce_numeric(c, None))
    df = df.withColumns({
        "avg_price": F.coalesce(F.col("avg_price"), F.lit(0.0)) if "avg_price" in df.columns else F.lit(0.0),
        "rating_overall": (F.coalesce(F.col("rating_overall"), F.lit(0.0)) if "rating_overall" in df.columns
                           else F.lit(0.0)),
        "review_count": (F.coalesce(F.col("review_count"), F.lit(0.0)).cast("long") if "review_count" in df.columns
                         else F.lit(0).cast("long")),
    })
    df = df.withColumn("_blank_name", F.col("restaurant_name").isNull()
                       | (F.trim(F.col("restaurant_name").cast("string")) == ""))
    # Q7: every row gets the default source, not only the first one.
    return C.stamp_provenance(df, source, at, keep_existing=True)


def clean_listing(df: DataFrame, **kw) -> DataFrame:
    f = clean_listing_frame(df, **kw)
    return f.where(~F.col("_blank_name")).drop("_blank_name", *([c for c in f.columns if c == "_district_unknown"]))


def clean_listing_log(raw: DataFrame, task_name: str, **kw) -> DataFrame:
    """Stage log rows ``(task_name, seq, stage, level, message, record_count)`` from two aggregates."""
    f = clean_listing_frame(raw, **kw)
    has_district = "_district_unknown" in f.columns
    raw_n = raw.select(F.count(F.lit(1)))
    s = f.agg(F.count(F.lit(1)).alias("kept"),
              F.count_if(F.col("_blank_name")).alias("blank"),
              (F.count_if(F.col("_district_unknown")) if has_district else F.lit(0).cast("long")).alias("unknown")
              ).select("*", raw_n.scalar().alias("raw"))
    def row(seq, stage, level, message, count, emit):
        return F.struct(F.lit(seq).alias("seq"), F.lit(stage).alias("stage"), level.alias("level"),
                        message.alias("message"), count.cast("long").alias("record_count"), emit.alias("emit"))
    raw_c, kept, blank, unknown = F.col("raw"), F.col("kept"), F.col("blank"), F.col("unknown")
    rows = [
        row(1, "load", F.lit("INFO"), F.format_string("file loaded, %d raw records", raw_c), raw_c, F.lit(True)),
        row(2, "dedup", F.lit("INFO"),
            F.format_string("dedupe done, %d duplicates removed, %d left", raw_c - kept, kept), raw_c - kept,
            F.lit(True)),
        row(3, "normalize", F.when(unknown > 0, "WARNING").otherwise("INFO"),
            F.when(unknown > 0, F.format_string("district: %d unknown values cleared", unknown))
             .otherwise(F.format_string("district normalized, %d records", kept)),
            F.when(unknown > 0, unknown).otherwise(kept), F.lit(has_district)),
        row(4, "validate", F.lit("WARNING"), F.format_string("%d records with blank name removed", blank), blank,
            blank > 0),
        row(5, "validate", F.lit("INFO"), F.format_string("cleaning done, %d valid records", kept - blank),
            kept - blank, F.lit(True)),
    ]
    return (s.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("emit").drop("emit")
            .withColumn("task_name", F.lit(task_name))
            .select("task_name", "seq", "stage", "level", "message", "record_count"))


# ---- C31 ---------------------------------------------------------------------------
# The transformed fields in the reference's order.
TRANSFORM_FIELDS = ("restaurant_id", "phone", "business_hours", "avg_price", "rating_overall", "review_count",
                    "cuisine_type", "district", "business_area", "latitude", "longitude")


def transform_listing(df: DataFrame, source: str, at: str | None = None,
                      category_dict: dict = dims.CUISINE_DICT, category_default: str = "其他",
                      area_dict: dict = dims.BUSINESS_AREA_DICT, order_by: Sequence[str] | None = None,
                      aliases: dict = dims.COLUMN_ALIASES) -> DataFrame:
    """Dataset pipeline C1 -> C2 -> C18 -> C6 -> C12 -> C13/C14 -> C11 -> C8 -> C17 -> C3 -> C20."""
    df = C.canonical_columns(df, aliases, "restaurant_name")
    df = C.add_missing_columns(df, {"address": ("string", "")})
    df = C.add_missing_columns(df, {c: ("string", None) for c in TRANSFORM_FIELDS})
    df = df.withColumns({"restaurant_name": F.trim(F.col("restaurant_name").cast("string")),
                         "address": F.trim(F.coalesce(F.col("address").cast("string"), F.lit("")))})
    df = C.drop_blank_names(df, "restaurant_name", extra_blanks=("nan",))
    df, order = _ingest_order(df, order_by)
    df = C.dedupe(df, ["restaurant_name", "address"], order)
    df = df.withColumns({
        "phone": mask_phone("phone", "strict"),
        "business_hours": F.trim(F.col("business_hours").cast("string")),
        "avg_price": parse_number("avg_price", 0.0),
        "rating_overall": parse_number("rating_overall", 0.0),
        "review_count": parse_count("review_count", 0),
        "cuisine_type": C.category_synonym_expr("cuisine_type", category_dict, category_default),
        "district": C.area_contains_expr(["district", "business_area", "address"], area_dict),
        "business_area": blank_to_null("business_area", ("", "nan")),
        "latitude": F.nullif(parse_number("latitude", 0.0), F.lit(0.0)),
        "longitude": F.nullif(parse_number("longitude", 0.0), F.lit(0.0)),
    })
    df = C.stamp_provenance(df, source, at)
    df = df.withColumn("restaurant_id",
                       key_or_derived("restaurant_id", [F.lit(source), "restaurant_name", "address"], 20, "ds_"))
    return C.select_target(df, C.LISTING_COLUMNS, C.LISTING_TYPES)


# ---- C32 ---------------------------------------------------------------------------
# Landing-table column names of the crawler (shop id, name, address,
# phone, mean price, total score, review total, tag1 = category, tag2 = business area).
LANDING_COLUMNS = {"id": "店铺id", "name": "店铺名", "address": "店铺地址", "phone": "店铺电话",
                   "price": "人均价格", "rating": "店铺总分", "reviews": "评论总数", "tag1": "标签1", "tag2": "标签2"}


def migrate_listing(raw: DataFrame, columns: dict = LANDING_COLUMNS, category_groups: dict = dims.CATEGORY_MERGE,
                    exact_rules: dict = dims.AREA_RULES_EXACT, exact_late: dict = dims.AREA_RULES_EXACT_LATE,
                    address_rules=dims.AREA_RULES_ADDRESS, default_area: str = dims.AREA_RULES_DEFAULT,
                    excluded: Sequence[str] = dims.EXCLUDED_TAGS, prefix: str = dims.MIGRATION_PREFIX,
                    source: str = dims.MIGRATION_SOURCE, at: str | None = None,
                    order_by: Sequence[str] | None = None) -> DataFrame:
    """Landing table -> typed listing, then insert-ignore semantics inside the batch (Q21).

    The price gate keeps the reference rule: only an all-digit price is cast,
    so signed prices become 0 (Q11); ``parse_number`` is the lenient form.
    """
    c = {k: F.col(v) for k, v in columns.items()}
    df = raw.where(~c["tag1"].isin(list(excluded)))  # Q12: NULL tags drop too
    df, order = _ingest_order(df, order_by)
    okeys = [f"_o{i}" for i in range(len(order))]
    out = df.select(
        prefix_key(c["id"], prefix).alias("restaurant_id"),
        c["name"].alias("restaurant_name"),
        F.nullif(F.trim(c["address"]), F.lit("-")).alias("address"),
        F.nullif(F.trim(c["phone"]), F.lit("")).alias("phone"),
        gate_numeric_text(c["price"], "^[0-9]+$", "decimal(10,2)", 0).cast("double").alias("avg_price"),
        gate_numeric_text(c["rating"], r"^[0-9]+(\.[0-9]+)?$", "decimal(3,1)", 0).cast("double")
        .alias("rating_overall"),
        parse_count(c["reviews"], 0, "digits").alias("review_count"),
        F.try_element_at(C.map_literal(C.invert_groups(category_groups)), F.trim(c["tag1"])).alias("cuisine_type"),
        c["tag2"].alias("_tag2"), c["address"].alias("_addr"),
        F.nullif(F.trim(c["tag2"]), F.lit("")).alias("business_area"),
        F.lit(source).alias("data_source"),
        (F.lit(at).cast("timestamp_ntz") if at else F.current_timestamp()).alias("crawl_time"),
        *[F.col(o).alias(k) for o, k in zip(order, okeys)])
    out = C.infer_area_rules(out, "_tag2", "_addr", exact_rules, address_rules, default_area, exact_late)
    out = C.dedupe(out, ["restaurant_id"], okeys)
    cols = ["restaurant_id", "restaurant_name", "address", "phone", "avg_price", "rating_overall", "review_count",
            "cuisine_type", "district", "business_area", "data_source", "crawl_time"]
    return out.select(*cols)
