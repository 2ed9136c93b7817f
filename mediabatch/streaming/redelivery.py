"""Messages that arrive more than once: each is handled once, and none that came too late is lost.

A message's identity is a digest of its sender and body. Within the watermark Spark's state drops further deliveries. Rows older
than the watermark never reach that state; `late_letters` finds them as received messages no copy of which was accepted.
A message sent again after the watermark has passed it is a new one. Defined cases: null sender and null body are values of
their own; a message without a time of sending has no place on the watermark and goes to the dead letters.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

INBOX = "sender STRING, body STRING, sent_at TIMESTAMP"
LATE, UNDATED = "late", "no time of sending"


def identity(sender: Column, body: Column) -> Column:
    """Nulls and the border between the two are told apart by the JSON form."""
    return F.sha2(F.to_json(F.struct(sender.alias("sender"), body.alias("body"))), 256)


def received(spark: SparkSession, inbox: str) -> DataFrame:
    """All messages of the inbox, with their identity."""
    rows = spark.read.schema(INBOX).option("recursiveFileLookup", True).parquet(inbox)
    return rows.withColumn("message_id", identity(F.col("sender"), F.col("body")))


def accept_stream(
    spark: SparkSession, inbox: str, out: str, checkpoint: str, delay: str = "1 hour", max_files: int = 1000, **trigger
) -> StreamingQuery:
    """Write each message of the inbox (Parquet files of `INBOX`) once to `out`, a folder per micro-batch.

    State holds the identities of the last `delay` of event time. A replayed epoch replaces what its first run left.
    """
    rows = (
        spark.readStream.schema(INBOX)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .parquet(inbox)
        .where("sent_at IS NOT NULL")
        .withColumn("message_id", identity(F.col("sender"), F.col("body")))
    )
    once = rows.withWatermark("sent_at", delay).dropDuplicatesWithinWatermark(["message_id"])

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return (
        once.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_letters(received: DataFrame, accepted: DataFrame, until: datetime | None = None) -> DataFrame:
    """Dead letters: one row per received message of which no copy was accepted, with reason and number of deliveries.

    Run it when the stream has caught up; `until` leaves out what was sent later and may still be under way.
    """
    rows = received if until is None else received.where(F.col("sent_at").isNull() | (F.col("sent_at") <= F.lit(until)))
    letters = rows.groupBy("message_id").agg(
        F.first("sender").alias("sender"),
        F.first("body").alias("body"),
        F.max("sent_at").alias("sent_at"),
        F.count("*").alias("deliveries"),
    )
    reason = F.when(F.col("sent_at").isNull(), UNDATED).otherwise(LATE)
    return letters.join(accepted.select("message_id"), "message_id", "left_anti").withColumn("reason", reason)
