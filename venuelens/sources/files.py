"""File readers (S1-S3, S5, S7).  Every reader returns string columns; typing is
the cleaning pipelines' job (the reference infers types per file, which makes
the same column differ between uploads)."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"


def _strip_bom(df: DataFrame) -> DataFrame:
    ren = {c: c.replace(BOM, "").strip() for c in df.columns if c != c.replace(BOM, "").strip()}
    return df.withColumnsRenamed(ren) if ren else df


# ---- S1 ----------------------------------------------------------------------------
def read_csv_listing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row (UTF-8, optional byte-order mark), quoted multi-line fields,
    every column a string."""
    r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
         .option("encoding", "UTF-8").option("inferSchema", False))
    if schema is not None:
        r = r.schema(schema)
    return _strip_bom(r.csv(path))


# ---- S2 ----------------------------------------------------------------------------
def read_json_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A JSON array of records (or JSON lines); primitive values kept as strings."""
    r = spark.read.option("multiLine", True).option("primitivesAsString", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


# ---- S3 ----------------------------------------------------------------------------
WRAP_KEYS = ("data", "items", "restaurants", "records")


def read_json_wrapped(spark: SparkSession, path: str, columns: Sequence[str], keys: Sequence[str] = WRAP_KEYS
                      ) -> DataFrame:
    """A JSON object whose rows sit under the first present list key (``data``, ``items``,
    ``restaurants``, ``records``); without one, the object itself is one row.

    Each file is one document (``wholetext``), parsed by one task; many files
    are read in parallel.  ``columns`` names the record fields to keep (strings).
    """
    doc = spark.read.option("wholetext", True).text(path)
    top = F.from_json(F.col("value"), "map<string,string>")
    cands = [F.when(F.trim(top[k]).startswith("["), top[k]) for k in keys]
    rows_json = F.coalesce(*cands, F.concat(F.lit("["), F.trim(F.col("value")), F.lit("]")))
    recs = doc.select(F.explode(F.from_json(rows_json, "array<map<string,string>>")).alias("r"))
    return recs.select(*[F.col("r")[c].alias(c) for c in columns])


# ---- S5 ----------------------------------------------------------------------------
def read_by_extension(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Choose the reader by file extension (csv, json, xlsx/xls); reject anything else."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")
    if ext == "csv":
        return read_csv_listing(spark, path)
    if ext == "json":
        if columns is not None:
            return read_json_wrapped(spark, path, columns)
        return read_json_records(spark, path)
    if ext in ("xlsx", "xls"):
        from .workbooks import read_workbooks
        return read_workbooks(spark, path, columns)
    raise ValueError(f"unsupported file type: {ext!r} (csv, json, xlsx, xls)")


# ---- S7 ----------------------------------------------------------------------------
# Landing listing table of the crawler (all strings, '-' = missing, 'ban' = failed fetch).
RAW_LISTING_COLUMNS = ["店铺id", "店铺名", "评论总数", "人均价格", "标签1", "标签2", "店铺地址", "详情链接", "图片链接",
                       "店铺均分", "推荐菜", "店铺总分", "店铺电话", "其他信息"]
# Landing review table (one row per shop, JSON text columns).
RAW_REVIEW_COLUMNS = ["店铺id", "评论摘要", "评论总数", "好评个数", "中评个数", "差评个数", "带图评论个数", "精选评论"]


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw_listing(spark: SparkSession, path: str, fmt: str = "parquet",
                     columns: Sequence[str] = RAW_LISTING_COLUMNS) -> DataFrame:
    """The all-string landing table with an explicit schema (no inference)."""
    r = spark.read.schema(string_schema(columns))
    if fmt == "csv":
        return r.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return r.format(fmt).load(path)


def landing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mark the landing sentinels: ``-`` (missing) becomes NULL, a row with ``ban`` is a failed fetch."""
    banned = F.lit(False)
    for c in columns:
        banned = banned | (F.col(c) == "ban")
    return df.select(*[F.when(F.col(c) == "-", None).otherwise(F.col(c)).alias(c) for c in columns],
                     F.coalesce(banned, F.lit(False)).alias("fetch_failed"))
