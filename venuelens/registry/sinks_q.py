"""Sinks and table maintenance K1-K12 (writes go to new folders under the checkpoint folder)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import sinks as K
from ..plans import cleaning as P
from ..session import scratch_path
from . import register
from .cleaning_q import AT, RAW_ORDER, REVIEW_ORDER
from .joins_q import _snapshots

_OLD = "SELECT listing_id, name, category, area, price, rating FROM listing WHERE seen_at < TIMESTAMP '1996-01-01'"
_NEW = ("SELECT listing_id, name, category, area, CAST(CASE WHEN category = 'PROMO' THEN price + 1 ELSE price END "
        "AS DECIMAL(10,2)) AS price, rating FROM listing")
_BATCH = ("SELECT listing_id, name, category, area, CAST(price + 1 AS DECIMAL(10,2)) AS price, rating FROM listing "
          "WHERE seen_at >= TIMESTAMP '1995-06-01' AND seen_at < TIMESTAMP '1996-06-01'")


def _batch(t):
    lst = t.listing()
    return lst.where((F.col("seen_at") >= F.lit("1995-06-01").cast("timestamp_ntz"))
                     & (F.col("seen_at") < F.lit("1996-06-01").cast("timestamp_ntz"))).select(
        "listing_id", "name", "category", "area", (F.col("price") + 1).cast("decimal(10,2)").alias("price"), "rating")


def _scratch(t, name):
    return scratch_path(t.spark, f"sinks/{name}/{uuid.uuid4().hex}")


# ---- K1 ----------------------------------------------------------------------------
@register("insert_if_absent", f"""
SELECT * FROM ({_OLD}) UNION ALL
SELECT * FROM ({_NEW}) WHERE listing_id NOT IN (SELECT listing_id FROM ({_OLD}))""", ("listing",))
def _insert_if_absent(t):
    old, new = _snapshots(t)
    return K.insert_if_absent(new, old, "listing_id", ["listing_id"])[0]


@register("insert_if_absent_counts", f"""
SELECT count(*) FILTER (WHERE listing_id NOT IN (SELECT listing_id FROM ({_OLD}))) AS inserted,
       count(*) FILTER (WHERE listing_id IN (SELECT listing_id FROM ({_OLD}))) AS skipped, count(*) AS total
FROM ({_NEW})""", ("listing",))
def _insert_if_absent_counts(t):
    old, new = _snapshots(t)
    return K.insert_if_absent(new, old, "listing_id", ["listing_id"])[1]


# ---- K2 / K3 -----------------------------------------------------------------------
@register("upsert_by_key", f"""
SELECT * FROM ({_OLD}) WHERE listing_id NOT IN (SELECT listing_id FROM ({_BATCH}))
UNION ALL SELECT * FROM ({_BATCH})""", ("listing",))
def _upsert(t):
    old, _ = _snapshots(t)
    return K.upsert_by_key(_batch(t), old, "listing_id", ["price"])[0]


@register("upsert_counts", f"""
SELECT count(*) FILTER (WHERE listing_id NOT IN (SELECT listing_id FROM ({_OLD}))) AS inserted,
       count(*) FILTER (WHERE listing_id IN (SELECT listing_id FROM ({_OLD}))) AS updated FROM ({_BATCH})""",
          ("listing",))
def _upsert_counts(t):
    old, _ = _snapshots(t)
    return K.upsert_by_key(_batch(t), old, "listing_id", ["price"])[1]


@register("upsert_partial", f"""
SELECT coalesce(o.listing_id, b.listing_id) AS listing_id, o.name, o.category, o.area,
       CASE WHEN b.listing_id IS NOT NULL THEN b.price ELSE o.price END AS price, o.rating
FROM ({_OLD}) o FULL OUTER JOIN ({_BATCH}) b ON o.listing_id = b.listing_id""", ("listing",))
def _upsert_partial(t):
    old, _ = _snapshots(t)
    return K.upsert_partial(_batch(t), old, "listing_id", ["price"])


# ---- K4 / K5 -----------------------------------------------------------------------
_RV_NEW = "SELECT * FROM review WHERE ts >= TIMESTAMP '2001-01-01'"


@register("replace_by_key", f"""
SELECT * FROM review WHERE listing_id NOT IN (SELECT listing_id FROM ({_RV_NEW}))
UNION ALL SELECT review_id, listing_id, user_id, rating, taste, environment, service, ts, likes + 100 FROM ({_RV_NEW})""",
          ("review",))
def _replace_by_key(t):
    rv = t.review()
    new = rv.where(F.col("ts") >= F.lit("2001-01-01").cast("timestamp_ntz")).withColumn("likes", F.col("likes") + 100)
    return K.replace_by_key(new, rv, "listing_id")


@register("insert_ignore", f"""
SELECT * FROM review WHERE ts < TIMESTAMP '1996-01-01'
UNION ALL
SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY {', '.join(REVIEW_ORDER)}) AS _rn
                             FROM review) WHERE _rn = 1
  AND review_id NOT IN (SELECT review_id FROM review WHERE ts < TIMESTAMP '1996-01-01')""", ("review",))
def _insert_ignore(t):
    rv = t.review()
    target = rv.where(F.col("ts") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return K.insert_ignore(rv, target, "review_id", REVIEW_ORDER)


# ---- K6 / K7 -----------------------------------------------------------------------
_AREA_COUNTS = ("SELECT area AS name, count(*) AS count FROM listing WHERE area IS NOT NULL AND area <> '' "
                "GROUP BY area")


@register("write_csv_export", _AREA_COUNTS, ("listing",))
def _csv_export(t):
    path = K.write_csv_export(A.area_distribution(t.listing()), _scratch(t, "csv"))
    return K.read_csv_export(t.spark, path, "name string, count long")


@register("load_warehouse_table", _AREA_COUNTS, ("listing",))
def _warehouse(t):
    name = f"venuelens_area_counts_{uuid.uuid4().hex[:8]}"
    df = A.area_distribution(t.listing())
    df.write.mode("overwrite").format("parquet").option("path", _scratch(t, "tables")).saveAsTable(name)
    return t.spark.table(name)


# ---- K8 / K9 -----------------------------------------------------------------------
@register("append_log", """
WITH f AS (SELECT * FROM (SELECT id AS restaurant_id, title AS restaurant_name,
              row_number() OVER (PARTITION BY id ORDER BY title, price, rating, reviews, tel, cuisine, address) AS _rn
           FROM raw_listing) WHERE _rn = 1),
s AS (SELECT count(*) AS kept, count(*) FILTER (WHERE restaurant_name IS NULL OR trim(restaurant_name) = '') AS blank,
             (SELECT count(*) FROM raw_listing) AS raw FROM f),
rows AS (SELECT 1 AS seq, 'load' AS stage, 'INFO' AS level, format('file loaded, {:d} raw records', raw) AS message,
                raw AS record_count FROM s
         UNION ALL SELECT 2, 'dedup', 'INFO', format('dedupe done, {:d} duplicates removed, {:d} left', raw - kept, kept),
                raw - kept FROM s
         UNION ALL SELECT 4, 'validate', 'WARNING', format('{:d} records with blank name removed', blank), blank FROM s
                WHERE blank > 0
         UNION ALL SELECT 5, 'validate', 'INFO', format('cleaning done, {:d} valid records', kept - blank), kept - blank FROM s)
SELECT * FROM job_log
UNION ALL
SELECT (SELECT max(id) FROM job_log) + row_number() OVER (ORDER BY seq) AS id, 'import_1' AS task_name, stage, level,
       record_count, CAST(NULL AS TIMESTAMP) AS create_time FROM rows""", ("job_log", "raw_listing"))
def _append_log(t):
    rows = P.clean_listing_log(t.raw_listing(), "import_1", at=AT, order_by=RAW_ORDER)
    return K.append_log(t.job_log(), rows)


@register("delete_where_kept", "SELECT * FROM job_log WHERE NOT coalesce(task_name = 'task_3', FALSE)", ("job_log",))
def _delete_kept(t):
    return K.delete_where(t.job_log(), F.col("task_name") == "task_3")[0]


@register("delete_where_count", "SELECT count(*) FILTER (WHERE task_name = 'task_3') AS deleted FROM job_log",
          ("job_log",))
def _delete_count(t):
    return K.delete_where(t.job_log(), F.col("task_name") == "task_3")[1]


# ---- K10 / K11 ---------------------------------------------------------------------
_TOGGLES = "SELECT user_id, listing_id + 1 AS listing_id, ts AS created_at FROM review WHERE ts >= TIMESTAMP '2001-01-01'"


@register("toggle_pairs", f"""
WITH tg AS ({_TOGGLES}),
known AS (SELECT * FROM tg WHERE listing_id IN (SELECT listing_id FROM listing)),
flips AS (SELECT user_id, listing_id, max(created_at) AS created_at FROM known GROUP BY 1, 2 HAVING count(*) % 2 = 1)
SELECT f.* FROM favorite f WHERE NOT EXISTS (SELECT 1 FROM flips x WHERE x.user_id = f.user_id AND x.listing_id = f.listing_id)
UNION ALL
SELECT x.user_id, x.listing_id, x.created_at FROM flips x
WHERE NOT EXISTS (SELECT 1 FROM favorite f WHERE x.user_id = f.user_id AND x.listing_id = f.listing_id)""",
          ("listing", "review", "favorite"))
def _toggle_pairs(t):
    rv = t.review()
    toggles = rv.where(F.col("ts") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(
        "user_id", (F.col("listing_id") + 1).alias("listing_id"), F.col("ts").alias("created_at"))
    return K.toggle_pairs(t.favorite(), toggles, t.listing())[0]


@register("toggle_rejected", f"""
SELECT * FROM ({_TOGGLES}) WHERE listing_id NOT IN (SELECT listing_id FROM listing)""", ("listing", "review"))
def _toggle_rejected(t):
    rv = t.review()
    toggles = rv.where(F.col("ts") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(
        "user_id", (F.col("listing_id") + 1).alias("listing_id"), F.col("ts").alias("created_at"))
    return K.toggle_pairs(t.favorite(), toggles, t.listing())[1]


@register("cascade_delete", """
SELECT * FROM review WHERE listing_id NOT IN (SELECT listing_id FROM listing WHERE area = 'Brand#7')""",
          ("listing", "review"))
def _cascade(t):
    return K.cascade_delete(t.review(), t.listing().where(F.col("area") == "Brand#7"))


# ---- K12 ---------------------------------------------------------------------------
@register("fan_out_write", "SELECT listing_id, name, category, area, CAST(price AS DOUBLE) AS price FROM listing",
          ("listing",))
def _fan_out(t):
    base = _scratch(t, "fanout")
    df = t.listing().select("listing_id", "name", "category", "area", F.col("price").cast("double").alias("price"))
    writers = [
        (F.col("category") == "PROMO", lambda d: d.write.mode("overwrite").parquet(f"{base}/promo")),
        (F.col("category") == "ECONOMY", lambda d: d.write.mode("overwrite").parquet(f"{base}/economy")),
        (~F.coalesce(F.col("category").isin("PROMO", "ECONOMY"), F.lit(False)), lambda d: d.write.mode("overwrite").parquet(f"{base}/other")),
    ]
    K.fan_out_write(df, writers)
    return t.spark.read.parquet(f"{base}/promo", f"{base}/economy", f"{base}/other")


# ---- import job (S5 -> C30 -> K1 -> K8) ---------------------------------------------
_TARGET_SQL = """SELECT CAST(listing_id AS VARCHAR) AS restaurant_id, name AS restaurant_name, CAST(price AS DOUBLE) AS avg_price,
       CAST(rating AS DOUBLE) AS rating_overall, review_count, CAST(NULL AS VARCHAR) AS phone, category AS cuisine_type,
       CAST(NULL AS VARCHAR) AS address, business_area AS area_tag, 'crawl' AS data_source, seen_at AS crawl_time
FROM listing"""


def _import_target(t):
    return t.listing().select(
        F.col("listing_id").cast("string").alias("restaurant_id"), F.col("name").alias("restaurant_name"),
        F.col("price").cast("double").alias("avg_price"), F.col("rating").cast("double").alias("rating_overall"),
        F.col("review_count").cast("long").alias("review_count"), F.lit(None).cast("string").alias("phone"),
        F.col("category").alias("cuisine_type"), F.lit(None).cast("string").alias("address"),
        F.col("business_area").alias("area_tag"), F.lit("crawl").alias("data_source"),
        F.col("seen_at").alias("crawl_time"))


def _import(t):
    from ..plans.imports import import_listing_file
    from .sources_q import RAW_COLS
    path = _scratch(t, "import") + "/upload.csv"
    K.write_csv_export(t.raw_listing().select(*RAW_COLS), path)
    return import_listing_file(t.spark, path, _import_target(t), "import_2", AT,
                               order_by=["restaurant_name", "avg_price", "rating_overall", "review_count", "phone",
                                         "cuisine_type", "address"])


_CSV_COLS = ["id", "title", "price", "rating", "reviews", "tel", "cuisine", "address", "area_tag"]
_IMPORT_CLEAN = f"""
rc AS (SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in _CSV_COLS)} FROM raw_listing),
f AS (SELECT * FROM (SELECT id AS restaurant_id, title AS restaurant_name, price AS avg_price, rating AS rating_overall,
         reviews AS review_count, tel AS phone, cuisine AS cuisine_type, address, area_tag,
         row_number() OVER (PARTITION BY id ORDER BY title NULLS FIRST, price NULLS FIRST, rating NULLS FIRST,
                            reviews NULLS FIRST, tel NULLS FIRST, cuisine NULLS FIRST, address NULLS FIRST) AS _rn
      FROM rc) WHERE _rn = 1),
c AS (SELECT restaurant_id, restaurant_name,
             coalesce(TRY_CAST(trim(avg_price) AS DOUBLE), 0.0) AS avg_price,
             coalesce(TRY_CAST(trim(rating_overall) AS DOUBLE), 0.0) AS rating_overall,
             CAST(coalesce(TRY_CAST(trim(review_count) AS DOUBLE), 0.0) AS BIGINT) AS review_count,
             CASE WHEN phone IS NULL THEN NULL WHEN length(regexp_replace(phone, '\\D', '', 'g')) >= 7
                  THEN concat(substr(regexp_replace(phone, '\\D', '', 'g'), 1, 3), '****',
                              right(regexp_replace(phone, '\\D', '', 'g'), 4)) END AS phone,
             cuisine_type, address, area_tag, 'import' AS data_source, TIMESTAMP '{AT}' AS crawl_time
      FROM f WHERE restaurant_name IS NOT NULL AND trim(restaurant_name) <> ''),
tg AS ({_TARGET_SQL}),
ins AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM tg WHERE tg.restaurant_id = c.restaurant_id))"""


@register("import_listing_file", f"WITH {_IMPORT_CLEAN} SELECT * FROM tg UNION ALL SELECT * FROM ins",
          ("listing", "raw_listing"))
def _import_listing_file(t):
    return _import(t)[0]


@register("import_listing_log", f"""
WITH {_IMPORT_CLEAN},
s AS (SELECT count(*) AS kept, count(*) FILTER (WHERE restaurant_name IS NULL OR trim(restaurant_name) = '') AS blank,
             (SELECT count(*) FROM raw_listing) AS raw FROM f),
n AS (SELECT (SELECT count(*) FROM ins) AS inserted, (SELECT count(*) FROM c) AS total)
SELECT 'import_2' AS task_name, 1 AS seq, 'load' AS stage, 'INFO' AS level,
       format('file loaded, {{:d}} raw records', raw) AS message, raw AS record_count FROM s
UNION ALL SELECT 'import_2', 2, 'dedup', 'INFO', format('dedupe done, {{:d}} duplicates removed, {{:d}} left', raw - kept, kept),
       raw - kept FROM s
UNION ALL SELECT 'import_2', 4, 'validate', 'WARNING', format('{{:d}} records with blank name removed', blank), blank
       FROM s WHERE blank > 0
UNION ALL SELECT 'import_2', 5, 'validate', 'INFO', format('cleaning done, {{:d}} valid records', kept - blank),
       kept - blank FROM s
UNION ALL SELECT 'import_2', 6, 'insert', 'INFO', format('import done: {{:d}} inserted, {{:d}} skipped, {{:d}} total',
       inserted, total - inserted, total), inserted FROM n""", ("listing", "raw_listing"))
def _import_listing_log(t):
    return _import(t)[1]
