"""Sinks and table maintenance.

No lakehouse format is on the classpath, so table maintenance is set-based
DataFrame algebra: the new table state is ``old`` minus the affected keys
(a left-anti join) plus the incoming rows, written to a *new* path and read
back.  The path being read is never overwritten.  Counts for the caller come
from one aggregate over the same join, not from extra actions per step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cleaning import dedupe


def _keys(key) -> list:
    return [key] if isinstance(key, str) else list(key)


# ---- K1 ----------------------------------------------------------------------------
def insert_if_absent(new: DataFrame, target: DataFrame, key, order_by: Sequence | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """Append rows whose key is not in the target (first row per key within the batch).

    Returns (new table state, counts with inserted / skipped / total).
    """
    k = _keys(key)
    batch = dedupe(new, k, order_by) if order_by is not None else new
    flagged = batch.join(target.select(*k).distinct().withColumn("_exists", F.lit(True)), k, "left")
    fresh = flagged.where(F.col("_exists").isNull()).drop("_exists")
    result = target.unionByName(fresh.select(*target.columns))
    counts = new.select(F.count(F.lit(1)).alias("total")).select(
        "total", flagged.select(F.count_if(F.col("_exists").isNull())).scalar().alias("inserted")).select(
        "inserted", (F.col("total") - F.col("inserted")).alias("skipped"), "total")
    return result, counts


# ---- K2 ----------------------------------------------------------------------------
def upsert_by_key(new: DataFrame, target: DataFrame, key, order_by: Sequence | None = None,
                  touch: str | None = None, at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert or overwrite whole rows by key (the last row per key in the batch wins).

    ``touch`` names an update-time column set to ``at`` on written rows.
    Returns (new table state, counts inserted / updated).
    """
    k = _keys(key)
    batch = dedupe(new, k, order_by, keep="last") if order_by is not None else new
    if touch:
        ts = F.lit(at).cast("timestamp_ntz") if at else F.current_timestamp()
        batch = batch.withColumn(touch, ts)
    batch = batch.select(*target.columns)
    kept = target.join(batch.select(*k), k, "left_anti")
    result = kept.unionByName(batch)
    tk = target.select(*k).distinct().withColumn("_old", F.lit(True))
    c = batch.select(*k).join(tk, k, "left").agg(F.count_if(F.col("_old").isNull()).alias("inserted"),
                                                 F.count_if(F.col("_old")).alias("updated"))
    return result, c


# ---- K3 ----------------------------------------------------------------------------
def upsert_partial(new: DataFrame, target: DataFrame, key, columns: Sequence[str]) -> DataFrame:
    """Upsert of a column subset: listed columns take the incoming value where the key
    arrives, other columns keep the old value (new keys get NULL there)."""
    k = _keys(key)
    n = new.select(*k, *[F.col(c).alias(f"_n_{c}") for c in columns]).withColumn("_in", F.lit(True))
    j = target.join(n, k, "full_outer")
    cols = []
    for c in target.columns:
        if c in k:
            cols.append(F.col(c))
        elif c in columns:
            cols.append(F.when(F.col("_in"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


# ---- K4 ----------------------------------------------------------------------------
def replace_by_key(new: DataFrame, target: DataFrame, key) -> DataFrame:
    """Delete every target row of each incoming key, then insert the incoming rows (multi-row)."""
    k = _keys(key)
    return target.join(new.select(*k).distinct(), k, "left_anti").unionByName(new.select(*target.columns))


# ---- K5 ----------------------------------------------------------------------------
def insert_ignore(new: DataFrame, target: DataFrame, key, order_by: Sequence) -> DataFrame:
    """Batch load ignoring duplicates: first row per key in the batch, existing keys kept (Q21)."""
    k = _keys(key)
    batch = dedupe(new, k, order_by, keep="first")
    return target.unionByName(batch.join(target.select(*k), k, "left_anti").select(*target.columns))


# ---- K6 / K7 -----------------------------------------------------------------------
def write_csv_export(df: DataFrame, path: str, header: bool = True) -> str:
    """Overwrite a CSV export at ``path`` (any Hadoop URI)."""
    (df.write.mode("overwrite").option("header", header).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def read_csv_export(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def load_warehouse_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                         bucket_by: tuple[int, str] | None = None, path: str | None = None) -> str:
    """Create the table if missing and overwrite-load it (catalog table, Parquet).

    ``bucket_by=(n, key)`` writes the table bucketed and sorted on ``key``: two
    tables bucketed the same way on the join key (reviews and listings on
    ``listing_id``) join without a shuffle of either side.  ``partition_by``
    gives directory partitions (e.g. month) for partition pruning.
    """
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, key = bucket_by
        w = w.bucketBy(n, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


# ---- K8 / K9 -----------------------------------------------------------------------
def append_log(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Log with the new stage rows appended (ids continue after the current maximum)."""
    start = log.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    from pyspark.sql import Window
    w = Window.orderBy("task_name", "seq")
    add = rows.select((start + F.row_number().over(w)).cast("long").alias("id"), "task_name", "stage", "level",
                      "message", F.col("record_count").cast("long").alias("record_count"),
                      F.lit(None).cast("timestamp_ntz").alias("create_time"))
    return log.unionByName(add.select(*log.columns))


def delete_where(log: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows kept, number deleted); write the kept rows to a new path."""
    cond = F.coalesce(predicate, F.lit(False))
    return log.where(~cond), log.select(F.count_if(cond).alias("deleted"))


# ---- K10 ---------------------------------------------------------------------------
def toggle_pairs(favorites: DataFrame, toggles: DataFrame, listings: DataFrame,
                 key: str = "listing_id", user: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """Apply favorite toggles: unknown listings are rejected; an odd number of toggles
    of a pair flips its membership.  Returns (new favorites, rejected toggles)."""
    known = toggles.join(listings.select(key), key, "left_semi")
    rejected = toggles.join(listings.select(key), key, "left_anti")
    flips = known.groupBy(user, key).agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("created_at")) \
                 .where(F.col("n") % 2 == 1).drop("n")
    removed = favorites.join(flips.select(user, key), [user, key], "left_anti")
    added = flips.join(favorites.select(user, key), [user, key], "left_anti")
    return removed.unionByName(added.select(*favorites.columns)), rejected


# ---- K11 ---------------------------------------------------------------------------
def cascade_delete(child: DataFrame, deleted_keys: DataFrame, key: str = "listing_id") -> DataFrame:
    """Child rows left after deleting parents: a left-anti join on the key."""
    return child.join(deleted_keys.select(key).distinct(), key, "left_anti")


# ---- K12 ---------------------------------------------------------------------------
def fan_out_write(df: DataFrame, writers: Sequence[tuple[Column | None, Callable[[DataFrame], None]]]) -> int:
    """Write one batch to several sinks by record type, computing the batch once.

    The batch is persisted (memory and disk) for the writes; a lost executor's
    blocks are recomputed from lineage.  Returns the number of writes.
    """
    from pyspark import StorageLevel
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for cond, write in writers:
            write(cached if cond is None else cached.where(cond))
    finally:
        cached.unpersist()
    return len(writers)
