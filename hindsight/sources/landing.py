"""Which snapshots are due, landing them append-only, and the run summary."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hindsight.functions.text import empty_to_null, path_value, year_month
from hindsight.sources.commits import file_system

MONTH_KEY = ["account", "year", "month"]
PAYLOAD = "games array<struct<uuid: string>>"


class SyncFailed(RuntimeError):
    """At least one snapshot of a run could not be had."""


def with_year_month(archives: DataFrame) -> DataFrame:
    """``archives(account, ordinal, url)`` with the month each URL stands for."""
    year, month = year_month("url")
    return archives.withColumns({"year": year, "month": month})


def landed_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (account, year, month) found below ``path``, from file names alone.

    The binary reader is asked for paths only, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return landed_from_paths(files, "path")


def landed_from_paths(files: DataFrame, path: str) -> DataFrame:
    keys = [empty_to_null(path_value(path, k)).alias(c) for k, c in zip(("username", "year", "month"), MONTH_KEY)]
    return files.select(*keys).dropna(subset=["year", "month"]).distinct()


def sync_plan(archives: DataFrame, landed: DataFrame, trailing_n: int = 2) -> DataFrame:
    """Every archive with ``due`` and ``reason``: missing, trailing or landed.

    Due are archives whose month has not landed and the last ``trailing_n`` of
    each account's listing; 0 means none of the latter. The rank filter is
    limited ahead of its exchange, so a long listing sends ``trailing_n`` rows.
    """
    if trailing_n > 0:
        newest = Window.partitionBy("account").orderBy(F.desc("ordinal"))
        last = archives.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= trailing_n)
        tail = last.select(*MONTH_KEY).distinct().withColumn("_trailing", F.lit(True))
        plan = archives.join(tail, MONTH_KEY, "left")
    else:
        plan = archives.withColumn("_trailing", F.lit(None).cast("boolean"))
    known = landed.select(*MONTH_KEY).distinct().withColumn("_landed", F.lit(True))
    reason = (
        F.when(F.col("_landed").isNull(), "missing").when(F.col("_trailing"), "trailing").otherwise("landed")
    )
    return (
        plan.join(known, MONTH_KEY, "left")
        .withColumns({"due": reason != "landed", "reason": reason})
        .select(*archives.columns, "due", "reason")
    )


def game_count(payload: str | Column) -> Column:
    """Number of games in a JSON document; 0 where it has none."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    return F.coalesce(F.size(F.from_json(payload, PAYLOAD)["games"]), F.lit(0))


def land_snapshots(payloads: DataFrame, path: str, as_files: bool = False) -> None:
    """Append ``payloads(account, year, month, payload, source_url, fetched_at)`` unmodified.

    Nothing is ever overwritten: a re-pull of a month adds to its partition.

    As rows (the default) payloads share Parquet files by month, the account
    being a column: the number of folders does not grow with the accounts.
    ``as_files`` writes one text file per payload below
    ``username=/year=/month=`` and all other columns to ``<path>_log``.
    """
    rows = payloads.withColumn("game_count", game_count("payload")).withColumnRenamed("account", "username")
    if as_files:
        write_documents(rows, "payload", ["username", "year", "month"], path)
        rows.drop("payload").write.mode("append").parquet(f"{path.rstrip('/')}_log")
    else:
        # AQE evens out the partitions, splitting a month that is very large
        rows.hint("rebalance", "year", "month").write.mode("append").partitionBy("year", "month").parquet(path)


# What a folder's name can't hold as it is; Spark escapes the same ones.
_ODD = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


def write_documents(rows: DataFrame, document: str, folders: Sequence[str], path: str) -> None:
    """Each row's ``document`` as a file of its own, added below ``<folder>=<value>/…``; null is an empty file.

    On a file system Spark's writer starts a process for the rights of each file
    and folder, and the driver moves every folder once more. There a task writes
    each file under a hidden name and then gives it its own, which tells the run,
    the partition, the content and, for equal ones, which of them: a task that is
    repeated replaces just what it wrote. A run that fails leaves whole files only.
    """
    spark = rows.sparkSession
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(location).toUri()
    wanted = rows.select(F.col(document).alias("_document"), *folders)
    if root.getScheme() != "file":
        wanted.write.mode("append").partitionBy(*folders).option("maxRecordsPerFile", 1).text(path)
        return
    base, run, names, odd = root.getPath(), uuid.uuid4().hex, list(folders), _ODD

    def segment(name: str, value) -> str:
        text = "" if value is None else str(value)
        return f"{name}={odd.sub(lambda c: f'%{ord(c[0]):02X}', text) or '__HIVE_DEFAULT_PARTITION__'}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        seen: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for text, *values in zip(*(column.to_pylist() for column in batch.columns)):
                data = f"{text or ''}\n".encode()
                folder = "/".join([base, *map(segment, names, values)])
                digest = hashlib.sha256(data).hexdigest()[:32]
                seen[folder, digest] += 1
                name = f"{part:05d}-{digest}-{seen[folder, digest]}-{run}.txt"
                os.makedirs(folder, exist_ok=True)
                with open(f"{folder}/_{attempt}-{name}", "wb") as out:
                    out.write(data)
                os.replace(f"{folder}/_{attempt}-{name}", f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"files": [sum(seen.values())]})

    wanted.mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()


#: Of a file that ``documents_below`` finds: milliseconds and bytes.
FOUND = "path binary, modified bigint, size bigint, folder boolean"


def documents_below(spark: SparkSession, path: str, work: str) -> DataFrame:
    """(path, modified, size) of each file below ``path``, a folder, file or pattern on a file system.

    As for Spark's readers, hidden and empty ones are none. Tasks list the folders,
    a level at a time, and write what they find below ``work``: the driver holds
    no name but those that ``path`` stands for.
    """
    files, location = file_system(spark, path)
    if (given := files.globStatus(location)) is None:
        spark.read.text(path)  # there is no such folder: raises what Spark raises then
    roots = [(s.getPath().toUri().getPath().encode(), s.getModificationTime(), s.getLen(), s.isDirectory()) for s in given]
    wide = 4 * spark.sparkContext.defaultParallelism

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(("path", "modified", "size", "folder"), map(list, zip(*found)))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for given in batches:
            for folder in given.column(0).to_pylist():
                with os.scandir(folder) as entries:
                    for entry in entries:
                        name, inside = entry.name, entry.is_dir()
                        shown = b"=" in name or inside and name.startswith((b"_metadata", b"_common_metadata"))
                        if name.startswith(b".") or name.endswith(b"._COPYING_") or name.startswith(b"_") and not shown:
                            continue
                        try:
                            told = None if inside else entry.stat()
                        except FileNotFoundError:  # gone since, or a link to nothing
                            continue
                        found.append((entry.path, told and told.st_mtime_ns // 1_000_000, told and told.st_size, inside))
                        if len(found) == 10_000:
                            yield batch(found)
                            found = []
        if found:
            yield batch(found)

    levels = [f"{work}/0"]
    spark.createDataFrame(roots, FOUND).coalesce(1).write.parquet(levels[0])
    while count := (folders := spark.read.schema(FOUND).parquet(levels[-1]).where("folder").select("path")).count():
        levels.append(f"{work}/{len(levels)}")
        folders.repartition(min(wide, -(-count // 50))).mapInArrow(scan, FOUND).write.parquet(levels[-1])
    return spark.read.schema(FOUND).parquet(*levels).where("not folder and size > 0").drop("folder")


def read_documents(files: DataFrame) -> DataFrame:
    """(value, path, modified) of ``files(path, modified, …)``, each read whole by the task that has its row."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(("value", "path", "modified"), map(list, zip(*held)))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for given in batches:
            for path, modified in zip(*(column.to_pylist() for column in given.columns)):
                with open(path, "rb") as file:
                    held.append((file.read(), path, modified))
                size += len(held[-1][0])
                if size > 1 << 22 or len(held) == 1000:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    texts = files.select("path", "modified").mapInArrow(read, "value binary, path binary, modified bigint")
    return texts.withColumn("value", F.col("value").cast("string"))


def landed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (account, year, month) among payloads landed as rows; reads no payload."""
    keys = "username string, year string, month string"
    return spark.read.schema(keys).parquet(path).select(F.col("username").alias("account"), "year", "month").distinct()


def sync_summary(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per account: what there was, what was fetched and skipped, what failed.

    ``outcomes(account, year, month, games, error)`` holds the fetched months;
    an ``error`` marks one that did not land and will be missing next time. The
    lists hold months, so their length is that of an account's life.
    """
    month = F.concat_ws("/", "year", "month")
    failed = F.col("error").isNotNull()
    rows = plan.join(outcomes, MONTH_KEY, "left")
    return rows.groupBy("account").agg(
        F.count("*").alias("archives_at_source"),
        F.array_sort(F.collect_list(F.when(F.col("games").isNotNull() & ~failed, month))).alias("fetched"),
        F.count_if(~F.col("due")).alias("skipped"),
        F.coalesce(F.sum(F.when(~failed, F.col("games"))), F.lit(0)).alias("games_fetched"),
        F.array_sort(F.collect_list(F.when(failed, F.concat(month, F.lit(": "), "error")))).alias("errors"),
    )


def fail_on_errors(summary: DataFrame) -> None:
    """Raise once all accounts are through, if any month failed."""
    counted = summary.agg(F.sum(F.size("errors")).alias("n")).first()["n"] or 0
    if counted:
        shown = summary.where(F.size("errors") > 0).select("account", F.slice("errors", 1, 3).alias("errors")).take(5)
        raise SyncFailed(f"{counted} snapshot(s) failed, among them {[row.asDict() for row in shown]}")


def archive_ranges(archives: DataFrame) -> DataFrame:
    """First and last month of each account's listing."""
    month = F.concat_ws("/", "year", "month")
    return archives.groupBy("account").agg(
        F.min_by(month, "ordinal").alias("first_month"),
        F.max_by(month, "ordinal").alias("last_month"),
        F.count("*").alias("archives"),
    )


