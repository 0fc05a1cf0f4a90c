"""Exactly-once file ingestion: the checkpoint remembers what has been read."""

from __future__ import annotations

import re
import uuid
from itertools import batched

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hindsight.schemas import SNAPSHOT
from hindsight.session import delete
from hindsight.sources import landing
from hindsight.sources.bronze import parse_documents, parse_payloads, read_bronze
from hindsight.sources.commits import Commits, Contended, file_system

LANDED_ROWS = "payload string, username string, source_url string, fetched_at timestamp, game_count int"


def document_stream(
    spark: SparkSession, path: str, schema: str = SNAPSHOT, files_per_batch: int = 10_000
) -> DataFrame:
    """JSON documents as they land, one row per file, whatever its lines."""
    reader = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
    return parse_documents(reader.text(path, wholetext=True), schema)


def payload_stream(
    spark: SparkSession, path: str, schema: str = SNAPSHOT, files_per_batch: int = 10_000
) -> DataFrame:
    """The same from payloads landed as rows."""
    reader = spark.readStream.schema(LANDED_ROWS).option("recursiveFileLookup", True)
    rows = reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return parse_payloads(rows, schema)


def ingest_stream(stream: DataFrame, bronze_path: str, checkpoint: str) -> StreamingQuery:
    """Append all that is new, then stop. Running it again without new files appends nothing.

    The file sink commits each batch by name; read the result as any Parquet
    folder. A bronze begun by ``ingest_batch`` is refused: the sink's log would
    hide what is there.
    """
    if Commits(stream.sparkSession, f"{_beside(bronze_path)}/log").numbers():
        raise ValueError(f"{bronze_path} was begun by ingest_batch and goes on by it")
    query = (
        stream.writeStream.format("parquet")
        .option("path", bronze_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


#: Times a run of ``ingest_batch`` starts anew because another one was faster.
ATTEMPTS = 5


def ingest_batch(spark: SparkSession, path: str, bronze_path: str, schema: str = SNAPSHOT) -> int:
    """Append each file below ``path`` once; returns how many there were. A second run appends nothing.

    Which files have been read is remembered beside bronze. On a file system tasks
    list, compare and read them: no file name passes through the driver, but of
    packed ones (``.gz`` and so on), 10,000 at a time. A run's rows are written
    beside bronze and count from its commit on; whoever comes next moves what a run
    that died then has left. Another store, a folder that a stream wrote, and a
    bronze that was begun as a stream are read as a stream.
    """
    beside = _beside(bronze_path)
    streams = (f"{path}/_spark_metadata", f"{bronze_path}/_spark_metadata", f"{beside}/offsets")
    if file_system(spark, path)[0].getScheme() != "file" or any(_exists(spark, p) for p in streams):
        return _ingest_as_stream(document_stream(spark, path, schema), bronze_path, beside)
    log = Commits(spark, f"{beside}/log")
    for _ in range(ATTEMPTS):
        runs = log.read(newest)["runs"] if (newest := log.newest()) else []
        if runs:
            _move(spark, f"{beside}/{runs[-1]}/rows", bronze_path)
        run = uuid.uuid4().hex
        own = f"{beside}/{run}"
        try:
            found = landing.documents_below(spark, path, f"{own}/listing")
            if runs:
                known = spark.read.schema(found.schema).parquet(*[f"{beside}/{r}/files" for r in runs])
                found = found.join(known.select("path").hint("merge"), "path", "left_anti")
            found.write.parquet(f"{own}/files")
            delete(spark, f"{own}/listing")
            files = spark.read.schema(found.schema).parquet(f"{own}/files")
            count = _read(files, schema, f"{own}/rows")
            if count and not log.put(newest + 1, {"runs": [*runs, run]}):
                count = None
        except BaseException:
            delete(spark, own)
            raise
        if count:
            _move(spark, f"{own}/rows", bronze_path)
            return count
        delete(spark, own)
        if count == 0:
            return 0
    raise Contended(f"{bronze_path}: other runs were faster {ATTEMPTS} times")


def _beside(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_read"


def _exists(spark: SparkSession, path: str) -> bool:
    files, location = file_system(spark, path)
    return files.exists(location)


def _ingest_as_stream(documents: DataFrame, bronze_path: str, checkpoint: str) -> int:
    spark = documents.sparkSession
    before = read_bronze(spark, bronze_path)
    known = before.count() if before is not None else 0
    ingest_stream(documents, bronze_path, checkpoint)
    # Counted in bronze, from its files' footers: a query's progress remembers its last hundred batches only.
    after = read_bronze(spark, bronze_path)
    return (after.count() if after is not None else 0) - known


def _read(files: DataFrame, schema: str, to: str) -> int:
    """Write the rows of ``files(path, modified, size)`` and tell how many there are."""
    spark = files.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory
    endings = [jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs.getCodecClasses(conf)]
    name = F.col("path").cast("string")
    packed = F.lower(name).rlike(f"({'|'.join(map(re.escape, endings))})$")
    told = files.agg(F.count("*"), F.count_if(packed), F.sum("size")).first()
    if told[0] > told[1]:
        width = max(-(-told[2] >> 26), min(4 * spark.sparkContext.defaultParallelism, -(-told[0] // 200)), 1)
        texts = landing.read_documents(files.where(~packed).repartition(width))
        source = F.concat(F.lit("file:"), F.col("path").cast("string"))
        parse_documents(texts, schema, source, F.timestamp_millis("modified")).write.parquet(to)
    if told[1]:
        # Spark's reader knows how to unpack them; what would make a name a pattern is escaped.
        names = files.where(packed).select(F.regexp_replace(name, r"([\\{}\[\]*?])", r"\\$1"))
        for some in batched((r[0] for r in names.toLocalIterator()), 10_000):
            parse_documents(spark.read.text(list(some), wholetext=True), schema).write.mode("append").parquet(to)
    return told[0]


def _move(spark: SparkSession, rows: str, bronze_path: str) -> None:
    """Put the files of a committed run into bronze, those that are not there yet; several may do that at once."""
    files, source = file_system(spark, rows)
    bronze = file_system(spark, bronze_path)[1]
    files.mkdirs(bronze)
    parts = files.listStatus(source) if files.exists(source) else []
    for part in (s.getPath() for s in parts if not s.getPath().getName().startswith("_")):
        target = spark._jvm.org.apache.hadoop.fs.Path(bronze, part.getName())
        try:
            files.rename(part, target)
        except Py4JJavaError:
            if not files.exists(target):
                raise
        if not files.exists(target):
            raise OSError(f"{part} can't be moved to {target}")
    files.delete(source, True)
