"""Table sources: item CSV, link records, messages, object listings and images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediabatch import schemas
from mediabatch.functions.keys import content_type

CSV_GLOB = "*.[cC][sS][vV]"
SHORT_ROW = "_short_row"


def _csv(spark: SparkSession, paths, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("pathGlobFilter", CSV_GLOB)
        .option("recursiveFileLookup", True)
        # A pruned parse cannot tell short rows; the files have little beyond the wanted columns.
        .option("columnPruning", False)
        # Files whose header differs from the first one fail instead of shifting columns.
        .option("enforceSchema", False)
    )


def read_items(spark: SparkSession, paths, multiline: bool = True) -> DataFrame:
    """Item rows of CSV files that share a header; columns are matched by name, extra ones dropped.

    An empty cell is `''`. A cell the row is too short to have is NULL, which later puts the row into
    the invalid output; a missing creator column reads as `unknown`. `ord` restores file order, which
    the file splits of a scan do not keep. Quoted cells may hold line breaks; for files known to have none
    `multiline=False` lets large ones be read in splits, and `csv_records.read_records` reads any in splits.
    """
    reader = _csv(spark, paths, multiline)
    header = reader.csv(paths).schema.names
    types = ", ".join(f"`{name}` STRING" for name in [*header, SHORT_ROW])
    rows = reader.schema(types).option("columnNameOfCorruptRecord", SHORT_ROW).csv(paths)

    def cell(name: str, absent: str):
        if name not in header:
            return F.lit(absent)
        tokens = F.size(F.split(F.col(SHORT_ROW), ","))
        lost = F.col(SHORT_ROW).isNotNull() & (tokens <= header.index(name))
        return F.when(lost, F.lit(None)).otherwise(F.coalesce(F.col(f"`{name}`"), F.lit("")))

    return rows.select(
        cell("creator_name", "unknown").alias("creator_name"),
        cell("cover_url", "").alias("cover_url"),
        cell("updated_at", "").alias("updated_at"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ord"),
    )


def read_links(spark: SparkSession, **jdbc) -> DataFrame:
    """Link records over JDBC; filters and column choice are pushed into the database by Catalyst.

    Pass `partitionColumn`, `lowerBound`, `upperBound` and `numPartitions` to read in parallel.
    """
    return (
        spark.read.format("jdbc").options(**jdbc).load().select("creator_name", "cover_urls", "updated_at")
    )


def read_messages(spark: SparkSession, path) -> DataFrame:
    """One JSON message per line, kept as text so that malformed ones can be set aside."""
    return spark.read.text(path).select(F.col("value").alias("body"))


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Object listing below `root`; file contents are never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    base = root.rstrip("/") + "/"
    key = F.substring_index(F.col("path"), base, -1)
    listed = files.select(
        key.alias("s3_key"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
    ).where(F.startswith("s3_key", F.lit(prefix)))
    return listed.withColumn("content_type", content_type(F.col("s3_key")))


def read_images(spark: SparkSession, paths) -> DataFrame:
    """Decoded images (`image` struct, BGR bytes); undecodable files stay with sizes of -1."""
    return spark.read.format("image").option("dropInvalid", False).load(paths)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STATE).parquet(path)


def read_assignment(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
