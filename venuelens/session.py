"""Session helpers: a tuned local/cluster session and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # broadcast only from measured runtime sizes (AQE), never from planning estimates
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "venuelens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster ``master`` stays None and the launcher decides; shuffle partitions
    then default to what the cluster sets (AQE coalesces small ones).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Starting settings for a large cluster, sized from the input volume.

    * initial shuffle partitions ~ input / 256 MB (never below 2x the cores), so
      a map-side-reduced shuffle of the whole input still fits per task; AQE
      then coalesces small partitions toward the advisory size;
    * scans split at 256 MB;
    * skew split for partitions 5x the median and above 512 MB;
    * broadcast decided by AQE from runtime sizes (64 MB), never from estimates.
    """
    cores = executor_cores * executors
    parts = max(2 * cores, total_input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``venuelens`` importable in executor Python workers (once per application).

    Functions run in ``mapInPandas`` / ``applyInPandasWithState`` refer to this
    package; the driver zips it and ``addPyFile`` distributes the zip to every
    executor, as a packaged library would be on a cluster.
    """
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="venuelens-pkg-")        # read by the driver only
    archive = shutil.make_archive(os.path.join(staging, "venuelens"), "zip", os.path.dirname(pkg), "venuelens")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared folder there; it is used as is.  Only a local
    session (tests, bench) without the setting gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    path = tempfile.mkdtemp(prefix="venuelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written as Parquet in the checkpoint folder and read back: lineage is cut, columns stay prunable."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside drop their shuffle files when they end, not when the driver happens to collect its garbage.

    For jobs whose result is written or collected: a frame that is run a second time is computed anew.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder or file on whatever storage ``path`` names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, path)
    return fs.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, where = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, where = hadoop_path(spark, path)
    fs.delete(where, True)
