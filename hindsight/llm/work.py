"""What the operators share: session settings, table reading, staged copies."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindsight.session import configure, stage  # noqa: F401  (stage is used by the operators)

#: Rows in an Arrow batch: texts of very different lengths go to Python in small steps.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null stands for itself."""
    return F.unhex(F.md5(text.cast("binary")))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for jobs that run inside the block: for frames of large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
