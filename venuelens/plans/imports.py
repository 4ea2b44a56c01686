"""The import job: file -> cleaned listing rows -> insert-if-absent into the target table,
with the stage log (the reference's upload-to-database flow, SURVEY 3.2).

``import_listing_file`` is lazy: it returns the new table state and the log rows.
``run_import`` writes them: the new state to a new version folder (the folder
being read is never overwritten) and the log rows appended to the log table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import sinks as K
from ..sources.files import read_by_extension
from . import cleaning as P

LOG_COLUMNS = ["task_name", "seq", "stage", "level", "message", "record_count"]


def import_listing_file(spark: SparkSession, path: str, target: DataFrame, task_name: str, at: str | None = None,
                        phone_style: str = "strict", order_by: Sequence[str] | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """(new target state, log rows) for importing the file at ``path`` into ``target``."""
    raw = read_by_extension(spark, path)
    cleaned = P.clean_listing(raw, phone_style=phone_style, at=at, order_by=order_by)
    typed = C.select_target(cleaned, target.columns, {f.name: f.dataType.simpleString() for f in target.schema})
    typed = typed.select(*[F.col(f.name).cast(f.dataType) for f in target.schema])
    result, counts = K.insert_if_absent(typed, target, "restaurant_id")
    clean_log = P.clean_listing_log(raw, task_name, phone_style=phone_style, at=at, order_by=order_by)
    insert_row = counts.select(
        F.lit(task_name).alias("task_name"), F.lit(6).alias("seq"), F.lit("insert").alias("stage"),
        F.lit("INFO").alias("level"),
        F.format_string("import done: %d inserted, %d skipped, %d total", "inserted", "skipped", "total")
        .alias("message"), F.col("inserted").alias("record_count"))
    return result, clean_log.unionByName(insert_row)


def run_import(spark: SparkSession, path: str, target_path: str, new_target_path: str, log_path: str,
               task_name: str, at: str | None = None, **kw) -> str:
    """Write the new table version and append the log rows; returns the new version path."""
    target = spark.read.parquet(target_path)
    result, log = import_listing_file(spark, path, target, task_name, at, **kw)
    result.write.mode("overwrite").parquet(new_target_path)
    log.write.mode("append").parquet(log_path)
    return new_target_path
