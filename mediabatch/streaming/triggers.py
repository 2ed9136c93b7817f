"""Structured Streaming triggers: arriving CSV files and arriving messages.

Delivery is at least once. Every sink below writes a micro-batch under its own epoch folder and
replaces that folder when the epoch is replayed, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mediabatch.config import DEFAULT_CONFIG, ProcessingConfig
from mediabatch.functions.keys import run_batch_id, trigger_prefix
from mediabatch.operators.ingest import valid_items
from mediabatch.operators.messages import (
    accepted,
    message_items,
    parse_messages,
    rejected,
    reprocess,
    retryable,
)
from mediabatch.operators.state import current_state, expire_stale, moment, recent, update_records
from mediabatch.session import one_layout, shared_dir
from mediabatch.sources.csv_records import key_of, read_records, read_referenced
from mediabatch.sources.readers import CSV_GLOB, read_state
from mediabatch.sources.writers import append_state, write_messages


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def landing_stream(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Paths and sizes of CSV files as they arrive; contents are not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", CSV_GLOB)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path", "length")
    )


def ingest_stream(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    as_of: Callable[[], datetime] = _now,
    max_files: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Run `handle(rows, epoch)` for each micro-batch of valid item rows.

    A micro-batch is a bounded set of files, scanned as one table. Rows carry the `object_key`,
    `batch_id` and `output_prefix` of their file.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        paths = [row.path for row in batch.where("length > 0").toLocalIterator()]
        if not paths:
            return
        with one_layout(spark):
            named = valid_items(read_records(spark, paths)).withColumn("object_key", key_of(F.col("ord.file"), landing))
            key = F.col("object_key")
            now = moment(as_of())
            handle(
                named.withColumns({"batch_id": run_batch_id("s3", now, key), "output_prefix": trigger_prefix(key)}),
                epoch,
            )

    return (
        landing_stream(spark, landing, max_files)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def message_stream(
    spark: SparkSession,
    inbox: str,
    out: str,
    checkpoint: str,
    root: str | None = None,
    as_of: Callable[[], datetime] = _now,
    defaults: ProcessingConfig = DEFAULT_CONFIG,
    handle: Callable[[DataFrame, int], None] | None = None,
    source: DataFrame | None = None,
    max_files: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Parse, route and unpack messages as they arrive.

    Under `out`: `items` (valid rows of the embedded and, with `root`, the referenced CSV texts),
    `routed` (one row per message) and `dead` (rejected ones with reason and attempt).
    """
    bodies = source
    if bodies is None:
        bodies = spark.readStream.option("maxFilesPerTrigger", max_files).text(inbox)
        bodies = bodies.select(F.col("value").alias("body"))

    def each(batch: DataFrame, epoch: int) -> None:
        def store(df: DataFrame, table: str, part: int = 0) -> None:
            # A replayed epoch replaces what its first run left.
            df.write.mode("overwrite").parquet(f"{out}/{table}/epoch={epoch}/part={part}")

        # Parts that an earlier attempt of this epoch left would stay beside the new ones.
        for table in ("parsed", "items", "missing", "routed", "dead"):
            remove(spark, f"{out}/{table}/epoch={epoch}")
        # Parsed once; the other tables are read off the stored result.
        # Two messages may be alike and of one moment: rows are told apart by the message they came in.
        numbered = batch.withColumn(
            "message_id", F.concat_ws("-", F.lit(str(epoch)), F.monotonically_increasing_id().cast("string"))
        )
        store(parse_messages(numbered, as_of(), defaults), "parsed")
        parsed = spark.read.parquet(f"{out}/parsed/epoch={epoch}/part=0")
        carry = ("message_id", "batch_id", "output_prefix", "config")
        embedded = message_items(accepted(parsed, "csv_data"), carry)
        store(valid_items(embedded.withColumnRenamed("line", "ord")), "items")
        reason = F.col("reason")
        if root is not None:
            refs = accepted(parsed, "csv_s3").select("s3_key", *carry)
            with one_layout(spark):
                rows, lost = read_referenced(spark, refs, root)
                named = rows.select(*carry, "creator_name", "cover_url", "updated_at", F.col("ord.row").alias("ord"))
                store(valid_items(named), "items", 1)
            store(lost, "missing")
            missing = spark.read.schema("s3_key STRING").parquet(f"{out}/missing/epoch={epoch}")
            parsed = parsed.join(missing.select("s3_key", F.lit(True).alias("gone")), "s3_key", "left")
            reason = F.coalesce(reason, F.when(F.col("gone"), "missing file"))
        routed = parsed.withColumn("reason", reason)
        store(routed.select("message_id", "processing_type", "batch_id", "output_prefix", "reason", "config"), "routed")
        store(rejected(routed), "dead")
        if handle is not None:
            handle(spark.read.parquet(f"{out}/items/epoch={epoch}"), epoch)

    return (
        bodies.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def retry_dead_letters(spark: SparkSession, out: str, inbox: str, as_of: datetime, epoch: int | None = None) -> None:
    """Send readable dead letters with deliveries left back to the inbox, with relaxed settings.

    `epoch` picks one micro-batch's dead letters; a message is thus sent again once per rejection.
    """
    dead = spark.read.parquet(f"{out}/dead")
    if epoch is not None:
        dead = dead.where(F.col("epoch") == epoch)
    again = reprocess(retryable(dead.drop("epoch", "part")), as_of)
    write_messages(again.select(F.col("new_body").alias("body")), inbox)


def status_stream(
    spark: SparkSession,
    updates: DataFrame,
    state_path: str,
    checkpoint: str,
    as_of: Callable[[], datetime] = _now,
    **trigger,
) -> StreamingQuery:
    """Apply status updates to the state log as they arrive, and fail records that got stuck.

    Each micro-batch appends new versions of existing records; a replay appends the same values as
    another version, which the current view cannot tell from the first.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        now = as_of()
        shared_dir(spark)
        current = current_state(recent(read_state(spark, state_path), now), now)
        # Cut off from the log before the log grows.
        changed = update_records(current, batch, now).checkpoint()
        append_state(changed, state_path)
        stuck = expire_stale(current_state(recent(read_state(spark, state_path), now), now), now).checkpoint()
        append_state(stuck, state_path)

    return (
        updates.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
