"""Session settings and shared work folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job of this package relies on. UTC is a matter of right
# results; the next ones let AQE split skewed join partitions, also where that
# costs one more exchange. Variants are read whole, so they are written so.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.variant.inferShreddingSchema": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session (all are runtime settings).

    Where there are more cores than shuffle partitions, exchanges start from
    several partitions per core; AQE merges those that turn out small. Folders
    are listed by a few tasks per core, not by one task each.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * cores))
    if cores > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(4 * cores))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hindsight")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"/tmp/hindsight-{uuid.uuid4().hex}")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder on storage that the driver and all executors share.

    Below ``spark.checkpoint.dir`` as the session names it; where that is unset,
    below the warehouse, which is shared as well. Never a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(location, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """The same for the length of a block, at whose end the copy goes."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def null_safe(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str] | None = None):
    """Join condition under which a null key equals a null key."""
    condition = F.lit(True)
    for l, r in zip(left_keys, right_keys or left_keys, strict=True):
        condition = condition & left[l].eqNullSafe(right[r])
    return condition
