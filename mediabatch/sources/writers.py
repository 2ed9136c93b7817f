"""Table sinks. Each writer runs one Spark job."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM_COLUMNS = ("creator_name", "cover_url", "updated_at")


def stamp(as_of: datetime) -> str:
    return as_of.strftime("%Y%m%d_%H%M%S")


# Cells keep their blanks, quotes are doubled, an empty cell stays empty.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_items(df: DataFrame, directory: str, as_of: datetime) -> str:
    """Item rows under a timestamped name; returns the path, or '' when there is nothing to write."""
    if df.isEmpty():
        return ""
    path = f"{directory.rstrip('/')}/cover_urls_{stamp(as_of)}"
    write_csv(df.select(*ITEM_COLUMNS), path)
    return path


def batch_folder(as_of: datetime) -> str:
    return stamp(as_of)


def write_batches(rows: DataFrame, directory: str, as_of: datetime) -> str:
    """One folder per batch below a timestamped one.

    A batch is normally a single file; the rebalance lets Spark cut an oversized batch (one huge
    creator) into several files instead of pushing it through one task.
    """
    path = f"{directory.rstrip('/')}/{batch_folder(as_of)}"
    (
        rows.select("batch_id", "creator_name", "ord", *ITEM_COLUMNS[1:])
        .withColumn("parallel_batch", F.format_string("%02d", F.col("batch_id") + 1))
        .hint("rebalance", "parallel_batch")
        .sortWithinPartitions("parallel_batch", "creator_name", "ord")
        .select("parallel_batch", *ITEM_COLUMNS)
        .write.partitionBy("parallel_batch")
        .options(**CSV_OPTIONS)
        .csv(path)
    )
    return path


def write_messages(messages: DataFrame, directory: str) -> None:
    messages.select("body").write.mode("append").text(directory)


def append_state(rows: DataFrame, path: str) -> None:
    """Append state versions to the log, one folder per day."""
    rows.hint("rebalance", "processing_date").write.mode("append").partitionBy("processing_date").parquet(path)


def write_collages(collages: DataFrame, path: str, mode: str = "append") -> None:
    collages.write.mode(mode).parquet(path)


def write_collage_files(collages: DataFrame, root: str) -> None:
    """One file per key below a folder every executor mounts; a retried task just writes it again."""

    def save(rows):
        for row in rows:
            target = os.path.join(root, row.s3_key)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{target}.{os.getpid()}.part"
            with open(part, "wb") as f:
                f.write(row.png)
            os.replace(part, target)

    collages.select("s3_key", "png").foreachPartition(save)


def write_summary(summary: DataFrame, root: str, as_of: datetime, trigger: str) -> str:
    """Run summary as JSON under the year/month/day/trigger layout."""
    path = f"{root.rstrip('/')}/results/processing-summaries/{as_of:%Y/%m/%d}/{trigger}"
    summary.write.mode("append").json(path)
    return path


def write_landing(rows: DataFrame, root: str, trigger: str, as_of: datetime) -> None:
    """Rows in the date- and trigger-partitioned landing layout, prunable by `dt` and `trigger`."""
    (
        rows.withColumn("dt", F.lit(as_of.strftime("%Y-%m-%d")))
        .withColumn("trigger", F.lit(trigger))
        .write.mode("append")
        .partitionBy("dt", "trigger")
        .options(**CSV_OPTIONS)
        .csv(root)
    )
