"""Bronze: every snapshot once, with its provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindsight.schemas import BRONZE, SNAPSHOT


def _decoded(path: Column) -> Column:
    """A file path as it was given: ``_metadata`` encodes blanks, percent signs and other letters."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def parse_documents(
    files: DataFrame, schema: str = SNAPSHOT, path: Column | None = None, modified: Column | None = None
) -> DataFrame:
    """Whole files (``value``) as bronze rows: the fields of ``schema``, the document as it came, and where from.

    Fields that ``schema`` doesn't name are in ``_variant``; ``reopened`` reads
    them later. What is no JSON, or names a field twice, is kept as text in ``_raw``.
    Files that no reader of Spark has opened need ``path`` and ``modified``.
    """
    opened = files.withColumn("_doc", F.from_json("value", schema))
    return opened.select(
        "_doc.*",
        (_decoded(F.col("_metadata.file_path")) if path is None else path).alias("_source_file"),
        (F.col("_metadata.file_modification_time") if modified is None else modified).alias("_file_modified_at"),
        F.current_timestamp().alias("_ingested_at"),
        *as_variant("value"),
    )


def parse_payloads(rows: DataFrame, schema: str = SNAPSHOT) -> DataFrame:
    """Landed payload rows as bronze rows, the document opened by ``schema``.

    Many snapshots share a file, so what tells them apart is said per row: the
    time of the snapshot is when it was fetched, and fetch time and account
    follow the file's path.
    """
    opened = rows.withColumn("_doc", F.from_json("payload", schema))
    fetched = F.date_format("fetched_at", "yyyyMMdd'T'HHmmss.SSSSSS'Z'")
    path = _decoded(F.col("_metadata.file_path"))
    return opened.select(
        "_doc.*",
        F.concat(path, F.lit("?fetched="), fetched, F.lit("&username="), "username").alias("_source_file"),
        F.col("fetched_at").alias("_file_modified_at"),
        F.current_timestamp().alias("_ingested_at"),
        *as_variant("payload"),
    )


def as_variant(text: str) -> list[Column]:
    """``_variant``, the document in Spark's binary form, parsed once; ``_raw``, its text where that can't be."""
    parsed = F.try_parse_json(text)
    return [parsed.alias("_variant"), F.when(parsed.isNull(), F.col(text)).alias("_raw")]


def reopened(bronze: DataFrame, schema: str) -> DataFrame:
    """Bronze with its documents read by another schema: for fields that the first one didn't name.

    Read from ``_variant`` without parsing; from text only where there is no more
    than that, as in rows written before that column. A value that its type can't take is null.
    """
    doc = F.from_json("_raw", schema)
    if "_variant" in bronze.columns:
        doc = F.when(F.col("_variant").isNotNull(), F.try_variant_get("_variant", "$", f"struct<{schema}>")).otherwise(doc)
    return bronze.withColumn("_doc", doc).select("_doc.*", *[c for c in bronze.columns if c.startswith("_")])


def drift(bronze: DataFrame, schema: str = SNAPSHOT, array: str = "games") -> DataFrame:
    """(path, seen, declared, rows): each field of the documents and of their array's elements, as which type it came how often.

    ``declared`` is its type in ``schema``, null for a field that the schema
    doesn't name. One row a field and type: what is new, mistyped or gone shows
    before any schema is changed.
    """
    spark = bronze.sparkSession
    document = T.StructType.fromDDL(schema)
    inside = document[array].dataType.elementType
    declared = {f.name: f.dataType for f in document} | {f"{array}[].{f.name}": f.dataType for f in inside}
    known = F.create_map(*[F.lit(x) for name, kind in declared.items() for x in (name, kind.simpleString())])
    element = F.explode(F.try_variant_get("_variant", f"$.{array}", "array<variant>"))

    def fields(rows: DataFrame, prefix: str) -> DataFrame:
        each = rows.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        return each.select(F.concat(F.lit(prefix), "key").alias("path"), F.schema_of_variant("value").alias("seen"))

    elements = fields(bronze.select(element.alias("v")), f"{array}[].")
    whole = fields(bronze.select(F.col("_variant").alias("v")), "")
    # Of the array itself only that it is one: its elements' fields are told one by one.
    whole = whole.withColumn("seen", F.when(F.col("path") == array, F.regexp_extract("seen", r"^\w+", 0)).otherwise(F.col("seen")))
    counted = whole.unionByName(elements).groupBy("path", "seen").agg(F.count("*").alias("rows"))
    return counted.select("path", "seen", F.try_element_at(known, F.col("path")).alias("declared"), "rows")


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> str:
    """What the documents would be read as: a help for writing a schema, never used to read."""
    reader = spark.read.option("multiLine", True).option("samplingRatio", sampling_ratio)
    return reader.option("recursiveFileLookup", True).json(path).schema.simpleString()


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """Bronze with the union of all fields ever written; None before the first file."""
    location = spark._jvm.org.apache.hadoop.fs.Path(bronze_path)
    files = location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(location):
        return None
    return spark.read.option("mergeSchema", True).parquet(bronze_path)


def widen(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; top-level fields only one side has are null on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def empty_bronze(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BRONZE)


def bronze_counts(bronze: DataFrame) -> DataFrame:
    """Snapshots and game rows, duplicates included; a null array adds nothing."""
    return bronze.agg(
        F.count("*").alias("snapshot_files"), F.sum(F.size("games")).alias("game_rows_incl_duplicates")
    )


def dedup_preview(bronze: DataFrame) -> DataFrame:
    """How many game rows there are and how many games they stand for."""
    games = bronze.select(F.explode("games.uuid").alias("uuid"))
    return games.agg(
        F.count("uuid").alias("game_rows_incl_duplicates"), F.count_distinct("uuid").alias("distinct_games")
    )


def sample_games(bronze: DataFrame, n: int = 1) -> DataFrame:
    """Some raw game objects, flattened, to look at: those of the least keys, so the same ones each time."""
    return bronze.select(F.explode("games").alias("g")).select("g.*").orderBy(F.asc_nulls_last("uuid"), "url", "end_time").limit(n)
