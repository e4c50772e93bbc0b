"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the physical work: small partitions are merged, skewed ones split
# (also where that costs one more exchange), and a join side is broadcast only once its
# measured size is under the threshold. No operator hints a broadcast of a table by hand.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # What a task reads of merged partitions; its sorts and hash maps are many times that.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "storeloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for dots."""
    # Call-site capture costs about a third of the time it takes to build a large plan.
    builder = SparkSession.builder.appName(app).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings above on a session that someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder that the cluster names, or one below its warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if spark.conf.get("spark.checkpoint.dir", None) is None and not context.master.startswith("local") \
            and ("://" not in warehouse or warehouse.startswith("file:")):
        warnings.warn(f"spark.checkpoint.dir is not set and the warehouse {warehouse} may be a folder of the "
                      "driver alone: name a folder that all executors reach", stacklevel=2)
    context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", f"{warehouse}/_checkpoints"))


#: Paths of the stored frames that no ``scratch`` block has removed yet.
_stored: list[str] = []


def stored_frames() -> list[str]:
    """Paths of the stored frames that are still there."""
    return list(_stored)


def remove_stored(spark: SparkSession, paths: list[str]) -> None:
    """Removes stored frames that nothing reads any more."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        if name in _stored:
            _stored.remove(name)
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the frames that were stored inside the block. What reads them has to be written or
    collected before the block ends."""
    before = len(_stored)
    try:
        yield
    finally:
        remove_stored(spark, _stored[before:])


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below ``spark.checkpoint.dir``, removed with the ``scratch`` block around it."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    _stored.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame as a table written once below ``spark.checkpoint.dir``.

    Later steps read it like any table (pruned, with a measured size) and no lost executor can
    make them repeat what led to it. It stays until the ``scratch`` block around it ends.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
