"""Stand-in views over the driver tables (see FIXTURES.md).

The operators work on the listing / review / favorite / job-log shapes of the
serving database.  The driver tables are TPC-H-like, so each shape is built from
them by one view.  The same view exists twice:

* ``Tables.<view>()`` builds it with the DataFrame API for Spark;
* ``VIEW_SQL[<view>]`` is the SQL text used as a CTE by the DuckDB oracle.

Both are checked against each other in ``tests/test_standins.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """Lazily read driver tables of one scale folder and derive the stand-in views.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)

    # ---- listing -----------------------------------------------------------------
    def listing(self) -> DataFrame:
        li = self.base("lineitem")
        per_part = (li.groupBy("l_partkey")
                    .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"),
                         F.min("l_shipdate").alias("seen_at")))
        p = self.base("part")
        return (p.join(per_part, p.p_partkey == per_part.l_partkey, "left")
                .select(
                    F.col("p_partkey").alias("listing_id"),
                    F.col("p_name").alias("name"),
                    F.col("p_type").alias("category"),
                    F.col("p_brand").alias("area"),
                    F.expr("concat(p_brand, '/', CAST(p_size % 4 AS STRING))").alias("business_area"),
                    F.expr("CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 3 - 2700 AS DECIMAL(10,2))").alias("price"),
                    F.expr("CAST(CASE WHEN p_size = 1 THEN 0 ELSE p_size / 10.0 END AS DECIMAL(3,1))").alias("rating"),
                    F.coalesce("n", F.lit(0)).alias("review_count"),
                    F.coalesce("q", F.lit(0.0)).alias("sales"),
                    F.expr("CAST(31 + (p_partkey % 97) / 100.0 AS DECIMAL(10,6))").alias("latitude"),
                    F.expr("CAST(121 + (p_partkey % 89) / 100.0 AS DECIMAL(10,6))").alias("longitude"),
                    F.expr("CAST((p_partkey * 37) % 3000 AS INT)").alias("distance_m"),
                    F.col("seen_at")))

    # ---- catalog -----------------------------------------------------------------
    def catalog(self) -> DataFrame:
        """The listings and, behind them, venues that are known but that nobody saved or reviewed yet."""
        lst = self.listing()
        known = {"listing_id": F.col("s_suppkey") + 1_000_000_000, "name": F.col("s_name"), "category": F.lit("NEW"),
                 "price": F.lit(0), "rating": F.lit(0), "review_count": F.lit(0), "sales": F.lit(0.0)}
        new = self.base("supplier").select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in lst.schema.fields])
        return lst.unionAll(new)

    # ---- review ------------------------------------------------------------------
    def review(self) -> DataFrame:
        li = self.base("lineitem")
        o = self.base("orders").select("o_orderkey", "o_custkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                .select(
                    F.expr("concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', "
                           "CAST(l_partkey AS STRING))").alias("review_id"),
                    F.col("l_partkey").alias("listing_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.expr("CAST(l_quantity / 10 AS DECIMAL(3,1))").alias("rating"),
                    F.expr("CAST(l_quantity / 10 AS DECIMAL(3,1))").alias("taste"),
                    F.expr("CAST(l_discount * 50 AS DECIMAL(3,1))").alias("environment"),
                    F.expr("CAST(l_tax * 50 AS DECIMAL(3,1))").alias("service"),
                    F.col("l_shipdate").alias("ts"),
                    F.col("l_linenumber").alias("likes")))

    # ---- review_text -------------------------------------------------------------
    def review_text(self) -> DataFrame:
        d = self.base("documents")
        # one row a document by construction, so a reader of the text alone needs no join
        b = self.base("labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
        return (d.join(b, d.doc_id == b.doc_id, "left")
                .select(
                    d.doc_id.alias("review_id"),
                    (d.doc_id % 100).alias("listing_id"),
                    d.text, d.lang,
                    F.expr("CAST(1 + (n_chars % 9) * 0.5 AS DECIMAL(3,1))").alias("rating"),
                    F.when(b.doc_id.isNull(), None).when(b.toxic == 1, -1)
                     .when(b.quality == 1, 1).otherwise(0).alias("sentiment")))

    # ---- favorite ----------------------------------------------------------------
    def favorite(self) -> DataFrame:
        li = self.base("lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey")
        o = self.base("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("listing_id"))
                .agg(F.min("o_orderdate").alias("created_at")))

    # ---- job_log -----------------------------------------------------------------
    def job_log(self) -> DataFrame:
        return self.base("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("task_"), (F.col("user_id") % 10).cast("string")).alias("task_name"),
            F.col("event_type").alias("stage"),
            F.expr("CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' "
                   "ELSE 'INFO' END").alias("level"),
            F.expr("CAST(floor(value) AS BIGINT)").alias("record_count"),
            F.col("ts").alias("create_time"))

    # ---- raw_listing -------------------------------------------------------------
    def raw_listing(self) -> DataFrame:
        return self.base("part").select(
            F.expr("CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END").alias("id"),
            F.expr("CASE WHEN p_partkey % 13 = 0 THEN '  ' ELSE concat(' ', p_name, ' ') END").alias("title"),
            F.expr("CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE concat('¥', CAST(CAST(p_retailprice AS "
                   "DECIMAL(10,2)) AS STRING)) END").alias("price"),
            F.expr("CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE CAST(CAST(p_size / 10.0 AS DECIMAL(3,1)) "
                   "AS STRING) END").alias("rating"),
            F.expr("concat(CAST(p_size AS STRING), ' reviews')").alias("reviews"),
            F.expr("CASE WHEN p_partkey % 3 = 0 THEN concat('138-', lpad(CAST(p_partkey % 10000 AS STRING), 4, '0'), "
                   "'-0', lpad(CAST(p_size AS STRING), 3, '0')) WHEN p_partkey % 3 = 1 THEN '021-12345' "
                   "ELSE '' END").alias("tel"),
            F.expr("concat(lower(p_type), ' goods')").alias("cuisine"),
            F.expr("concat('near ', p_brand, ' street')").alias("address"),
            F.expr("CASE WHEN p_partkey % 17 = 0 THEN '' ELSE concat(p_brand, '/', CAST(p_size % 4 AS STRING)) END")
            .alias("area_tag"))

    # ---- item (dish_info shape) ----------------------------------------------------
    def item(self) -> DataFrame:
        li = self.base("lineitem")
        return (li.groupBy(F.col("l_partkey").alias("listing_id"), F.col("l_suppkey").alias("item_id"))
                .agg(F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                     F.sum("l_quantity").cast("long").alias("monthly_sales"),
                     F.min("l_returnflag").alias("category"),
                     F.count(F.lit(1)).alias("mention_count"))
                .select("item_id", "listing_id",
                        F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("name"),
                        "price", "monthly_sales", "category", "mention_count"))

    # ---- fetch_task (crawl_task shape) --------------------------------------------
    def fetch_task(self) -> DataFrame:
        return self.base("events").select(
            F.col("event_id").alias("task_id"),
            F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string")).alias("source"),
            F.when(F.col("event_type") == "view", "full").otherwise("incremental").alias("task_type"),
            F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
            F.floor(F.col("value") * 10).cast("int").alias("total_count"),
            F.col("ts").alias("start_time"),
            F.expr("ts + make_dt_interval(0, 0, 0, floor(value))").alias("end_time"))


# SQL texts of the same views, valid in DuckDB (and Spark SQL).
VIEW_SQL = {
    "listing": """
SELECT p.p_partkey AS listing_id, p.p_name AS name, p.p_type AS category, p.p_brand AS area,
       concat(p.p_brand, '/', CAST(p.p_size % 4 AS STRING)) AS business_area,
       CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) * 3 - 2700 AS DECIMAL(10,2)) AS price,
       CAST(CASE WHEN p.p_size = 1 THEN 0 ELSE p.p_size / 10.0 END AS DECIMAL(3,1)) AS rating,
       coalesce(x.n, 0) AS review_count, coalesce(x.q, 0.0) AS sales,
       CAST(31 + (p.p_partkey % 97) / 100.0 AS DECIMAL(10,6)) AS latitude,
       CAST(121 + (p.p_partkey % 89) / 100.0 AS DECIMAL(10,6)) AS longitude,
       CAST((p.p_partkey * 37) % 3000 AS INT) AS distance_m, x.seen_at
FROM part p LEFT JOIN (
  SELECT l_partkey, count(*) AS n, sum(l_quantity) AS q, min(l_shipdate) AS seen_at
  FROM lineitem GROUP BY l_partkey) x ON x.l_partkey = p.p_partkey""",
    "catalog": """
SELECT * FROM listing UNION ALL
SELECT s_suppkey + 1000000000, s_name, 'NEW', NULL, NULL, CAST(0 AS DECIMAL(10,2)), CAST(0 AS DECIMAL(3,1)), 0, CAST(0 AS DOUBLE),
       NULL, NULL, NULL, NULL FROM supplier""",
    "review": """
SELECT concat(CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING), '-', CAST(l.l_partkey AS STRING)) AS review_id,
       l.l_partkey AS listing_id, o.o_custkey AS user_id,
       CAST(l.l_quantity / 10 AS DECIMAL(3,1)) AS rating,
       CAST(l.l_quantity / 10 AS DECIMAL(3,1)) AS taste,
       CAST(l.l_discount * 50 AS DECIMAL(3,1)) AS environment,
       CAST(l.l_tax * 50 AS DECIMAL(3,1)) AS service,
       l.l_shipdate AS ts, l.l_linenumber AS likes
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "review_text": """
SELECT d.doc_id AS review_id, d.doc_id % 100 AS listing_id, d.text, d.lang,
       CAST(1 + (d.n_chars % 9) * 0.5 AS DECIMAL(3,1)) AS rating,
       CASE WHEN b.doc_id IS NULL THEN NULL WHEN b.toxic = 1 THEN -1 WHEN b.quality = 1 THEN 1 ELSE 0 END AS sentiment
FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id""",
    "favorite": """
SELECT o.o_custkey AS user_id, l.l_partkey AS listing_id, min(o.o_orderdate) AS created_at
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_returnflag = 'R' GROUP BY o.o_custkey, l.l_partkey""",
    "job_log": """
SELECT event_id AS id, concat('task_', CAST(user_id % 10 AS STRING)) AS task_name, event_type AS stage,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
       CAST(floor(value) AS BIGINT) AS record_count, ts AS create_time
FROM events""",
    "item": """
SELECT l_suppkey AS item_id, l_partkey AS listing_id, concat('item-', CAST(l_suppkey AS STRING)) AS name,
       min(l_extendedprice / l_quantity) AS price, CAST(sum(l_quantity) AS BIGINT) AS monthly_sales,
       min(l_returnflag) AS category, count(*) AS mention_count
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "fetch_task": """
SELECT event_id AS task_id, concat('src', CAST(user_id % 5 AS STRING)) AS source,
       CASE WHEN event_type = 'view' THEN 'full' ELSE 'incremental' END AS task_type,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
       CAST(floor(value * 10) AS INT) AS total_count, ts AS start_time,
       ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time
FROM events""",
    "raw_listing": """
SELECT CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS id,
       CASE WHEN p_partkey % 13 = 0 THEN '  ' ELSE concat(' ', p_name, ' ') END AS title,
       CASE WHEN p_partkey % 7 = 0 THEN '-' ELSE concat('¥', CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)) END AS price,
       CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE CAST(CAST(p_size / 10.0 AS DECIMAL(3,1)) AS STRING) END AS rating,
       concat(CAST(p_size AS STRING), ' reviews') AS reviews,
       CASE WHEN p_partkey % 3 = 0 THEN concat('138-', lpad(CAST(p_partkey % 10000 AS STRING), 4, '0'), '-0', lpad(CAST(p_size AS STRING), 3, '0'))
            WHEN p_partkey % 3 = 1 THEN '021-12345' ELSE '' END AS tel,
       concat(lower(p_type), ' goods') AS cuisine, concat('near ', p_brand, ' street') AS address,
       CASE WHEN p_partkey % 17 = 0 THEN '' ELSE concat(p_brand, '/', CAST(p_size % 4 AS STRING)) END AS area_tag
FROM part""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the stand-in views it names, as CTEs (DuckDB oracle form)."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]}\n)" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
