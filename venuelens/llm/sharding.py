"""Contiguous shards of near-equal bytes by global prefix sums, in DataFrame functions only.

Rows are dealt into ranges of doc_id; every range's total of bytes and rows is one line of a
small table, whose prefix sums place the range; a running sum inside the range places the
row. The row whose bytes' middle falls into the i-th of N equal shares of all bytes goes to
shard i, so shards are contiguous in doc_id order and miss the target by less than one row
at each end. Only (doc_id, size, checksum) is shuffled, never the text.

Groups play no part in this law: equal texts are sharded by their doc_ids like any others.
Null text counts 1 byte. Null doc_ids come first. Rows with equal doc_id are ordered by
checksum and size; wholly equal rows in any order. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuelens.llm.common import documents, prepare, text_or_empty

SHARDS = 16


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``."""
    prepare(docs.sparkSession)
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    dealt = rows.repartitionByRange("doc_id", "text_crc32", "size").withColumn("_range", F.spark_partition_id()).checkpoint()
    totals = dealt.groupBy("_range").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    ranges = Window.orderBy("_range")  # a row a range
    before = totals.select(
        "_range", (F.sum("_bytes").over(ranges) - F.col("_bytes")).alias("_bytes_before"), (F.sum("_rows").over(ranges) - F.col("_rows")).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_range").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        dealt.withColumns({"_upto": F.sum("size").over(inside), "_nth": F.row_number().over(Window.partitionBy("_range").orderBy("doc_id", "text_crc32", "size"))})
        .join(before, "_range")
        .withColumn("_middle2", 2 * (F.col("_bytes_before") + F.col("_upto")) - F.col("size"))
        .withColumn("shard", F.least(F.expr(f"_middle2 * {shards} div (2 * _all)"), F.lit(shards - 1)).cast("int"))
        .withColumn("_row", F.col("_rows_before") + F.col("_nth") - 1)
    )
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(  # a row a shard
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes the rows of ``docs`` under path/shard=i, joined back by doc_id (which must then be a key).

    A column named ``shard`` or ``slot`` (in any case) gives way to the operator's.
    """
    found = shard(docs, shards)
    rows = docs.select([c for c in docs.columns if c.lower() not in ("shard", "slot")]).alias("d")
    joined = rows.join(found.select("doc_id", "shard", "slot").alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))).select("d.*", "s.shard", "s.slot")
    joined.write.partitionBy("shard").mode("overwrite").parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op8_sharding_prefix_sums": op8_sharding}
