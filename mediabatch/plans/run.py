"""A whole run: decide, record, fetch, lay out, compose, record again, summarise.

Each stage is written to the run's folder before the next one reads it. Fetched bytes and finished
collages are thus computed once, and a lost executor costs the running stage only.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediabatch import schemas
from mediabatch.config import DEFAULT_CONFIG, ProcessingConfig
from mediabatch.functions.hashing import legacy_collage_key
from mediabatch.operators.compose import compose, fetch, fetch_counts, http_fetcher
from mediabatch.operators.decisions import plan_work
from mediabatch.operators.ingest import valid_items, with_positions
from mediabatch.operators.layout import combined_rows
from mediabatch.operators.report import run_summary
from mediabatch.operators.state import create_records, current_state, moment, of_day, recent, update_records
from mediabatch.session import shared_dir
from mediabatch.sources.readers import read_images
from mediabatch.sources.writers import append_state


@dataclass
class RunPaths:
    """Folders of one run below a shared work folder."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Write a stage and continue from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def creator_id(creator: Column) -> Column:
    """A creator's name as a folder name."""
    return F.sha2(creator, 256)


def stage_files(fetched: DataFrame, folder: str) -> None:
    """Write fetched bytes as `<id>/<position>` files, where the image reader can decode them.

    A retried task replaces its own files.
    """

    def save(rows):
        for row in rows:
            target = os.path.join(folder, row.creator_id[:2], row.creator_id, f"{row.position}")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{target}.{os.getpid()}.{time.monotonic_ns()}"
            with open(part, "wb") as f:
                f.write(row.bytes)
            os.replace(part, target)

    os.makedirs(folder, exist_ok=True)
    fetched.where(F.col("bytes").isNotNull()).select("creator_id", "position", "bytes").foreachPartition(save)


def staged_images(spark: SparkSession, folder: str) -> DataFrame:
    """Staged files decoded: (creator_id, position, image). The path names both, so nothing is joined."""
    origin = F.col("image.origin")
    return read_images(spark, f"{folder}/*/*").select(
        F.element_at(F.split(origin, "/"), -2).alias("creator_id"),
        F.element_at(F.split(origin, "/"), -1).cast("long").alias("position"),
        "image",
    )


def _build(
    rows: DataFrame,
    creators: DataFrame,
    config: ProcessingConfig,
    fetcher: Callable,
    paths: RunPaths,
    with_png: bool,
) -> tuple[DataFrame, DataFrame]:
    """Fetch, decode and compose `rows` (creator_name, position, cover_url); returns (fetched, collages).

    `creators` has creator_name and s3_key, which the collages take along.
    """
    spark = rows.sparkSession
    named = rows.withColumn("creator_id", creator_id(F.col("creator_name")))
    fetched = _stored(fetch(named, config, fetcher), paths.fetched)
    if fetched.where(F.col("error").isNull()).isEmpty():
        images = spark.createDataFrame([], f"creator_id STRING, position LONG, image {schemas.IMAGE}")
    else:
        # A folder of this run only: what an earlier one staged is not composed again.
        staged = f"{paths.staged}/{uuid.uuid4().hex}"
        stage_files(fetched, staged)
        images = staged_images(spark, staged)
    made = compose(
        images,
        config.rows,
        config.cols,
        keys=("creator_id",),
        order=("position",),
        with_png=with_png,
        creators=creators.withColumn("creator_id", creator_id(F.col("creator_name"))),
    )
    return fetched, _stored(made.drop("creator_id"), paths.collages)


def run_batch(
    items: DataFrame,
    state_path: str,
    objects: DataFrame,
    as_of: datetime,
    work_dir: str,
    config: ProcessingConfig = DEFAULT_CONFIG,
    prefix: str = "",
    batch_id: str | None = None,
    deduplicate: bool = True,
    force: bool = False,
    fetcher: Callable = http_fetcher,
    with_png: bool = False,
) -> DataFrame:
    """Process item rows creator by creator; returns the result row of every creator.

    Results: creator_name, outcome (created, skipped, failed), image_count (URLs after the cap), s3_key,
    reason, placed, download_ms, placement_ms, save_ms. Collages are in the run's `collages` folder.
    A creator that cannot be built fails alone.
    """
    spark = items.sparkSession
    paths = RunPaths(work_dir)
    valid = valid_items(items)
    log = spark.read.schema(schemas.STATE).parquet(state_path) if _exists(spark, state_path) else (
        spark.createDataFrame([], schemas.STATE)
    )
    state = current_state(recent(log, as_of), as_of)
    plan = plan_work(valid, state, objects, config, as_of, prefix, deduplicate, force)
    if not deduplicate:
        plan = plan.withColumn("s3_key", legacy_collage_key(F.col("creator_name"), prefix, moment(as_of)))
    plan = _stored(plan, paths.plan)
    work = plan.where(F.col("action") == "process")
    if deduplicate and batch_id is not None:
        requests = work.withColumn("batch_id", F.lit(batch_id))
        records = create_records(state, requests, as_of, config.to_json(), request_id=batch_id)
        opened = _stored(records, paths.records).where("accepted").drop("accepted")
        append_state(opened, state_path)

    todo = valid.join(work.select("creator_name"), "creator_name", "left_semi")
    ranked = with_positions(todo, config.cap)
    fetched, collages = _build(ranked, work.select("creator_name", "s3_key"), config, fetcher, paths, with_png)

    built = collages.select("creator_name", "placed", F.col("compose_ms").alias("placement_ms"))
    downloads = fetch_counts(fetched).select("creator_name", F.col("fetch_ms").alias("download_ms"))
    outcome = (
        F.when(F.col("action") == "skip", "skipped")
        .when(F.col("placed").isNotNull(), "created")
        .otherwise("failed")
    )
    results = (
        plan.join(built, "creator_name", "left")
        .join(downloads, "creator_name", "left")
        .select(
            "creator_name",
            outcome.alias("outcome"),
            "image_count",
            F.when(outcome == "failed", F.lit(None)).otherwise(F.col("s3_key")).alias("s3_key"),
            F.when(outcome == "failed", "Collage creation failed").otherwise(F.col("reason")).alias("reason"),
            "placed",
            "download_ms",
            "placement_ms",
            F.lit(0).cast("long").alias("save_ms"),
        )
    )
    results = _stored(results, paths.results)
    if deduplicate:
        _close_records(spark, state_path, results, as_of)
    return results


def run_messages(
    items: DataFrame, state_path: str, objects: DataFrame, as_of: datetime, work_dir: str, **options
) -> DataFrame | None:
    """Runs the item rows of messages, each with its own message's settings, prefix and batch.

    `items` are rows as the message trigger stores them, with config, output_prefix and batch_id. Rows with equal
    settings are one run; there are as many runs as different settings, one after the other, so a creator that
    one of them has opened is in progress or done for the next. Returns all result rows, with output_prefix.
    """
    named = items.withColumn("settings", F.sha2(F.to_json(F.struct("config", "output_prefix", "batch_id")), 256))
    out = None
    for row in named.select("settings", "config", "output_prefix", "batch_id").distinct().sort("settings").toLocalIterator():
        own = named.where(F.col("settings") == row.settings)
        results = run_batch(
            own.select("creator_name", "cover_url", "updated_at", "ord"),
            state_path,
            objects,
            as_of,
            f"{work_dir.rstrip('/')}/{row.settings[:16]}",
            ProcessingConfig(**row.config.asDict()),
            row.output_prefix or "",
            row.batch_id,
            **options,
        ).withColumn("output_prefix", F.lit(row.output_prefix))
        out = results if out is None else out.unionByName(results)
    return out


def _close_records(spark: SparkSession, state_path: str, results: DataFrame, as_of: datetime) -> None:
    """Mark today's records of built and failed creators; without a record nothing matches."""
    if not _exists(spark, state_path):
        return
    failed = F.col("outcome") == "failed"
    updates = results.where(F.col("outcome") != "skipped").select(
        "creator_name",
        F.lit(as_of.strftime("%Y-%m-%d")).cast("date").alias("processing_date"),
        F.when(failed, "failed").otherwise("completed").alias("status"),
        F.col("s3_key").alias("collage_s3_key"),
        F.when(~failed, F.coalesce("download_ms", F.lit(0)) + F.coalesce("placement_ms", F.lit(0))).alias(
            "processing_duration_ms"
        ),
        F.when(failed, F.col("reason")).alias("error_message"),
    )
    state = current_state(of_day(spark.read.schema(schemas.STATE).parquet(state_path), as_of), as_of)
    shared_dir(spark)
    # The new versions are cut off from the log they were read from before they are appended to it.
    append_state(update_records(state, updates, as_of).checkpoint(), state_path)


def run_combined(
    items: DataFrame,
    as_of: datetime,
    work_dir: str,
    config: ProcessingConfig = DEFAULT_CONFIG,
    prefix: str = "",
    fetcher: Callable = http_fetcher,
    with_png: bool = False,
) -> DataFrame:
    """One collage over all creators; returns at most one result row, none when it fails."""
    paths = RunPaths(work_dir)
    chosen = combined_rows(valid_items(items), config.rows, config.cols).select(
        F.lit("combined").alias("creator_name"), F.col("position").cast("long").alias("position"), "cover_url"
    )
    chosen = _stored(chosen, paths.plan)
    key = F.lit(f"{prefix}collages/combined_collage_{as_of:%Y%m%d_%H%M%S}.jpg")
    label = chosen.select("creator_name").distinct().withColumn("s3_key", key)
    _, collages = _build(chosen, label, config, fetcher, paths, with_png)
    total = chosen.groupBy("creator_name").agg(F.count(F.lit(1)).alias("image_count"))
    return collages.join(total, "creator_name").select(
        "creator_name", F.lit("created").alias("outcome"), "image_count", "s3_key", "placed"
    )


def summarise(results: DataFrame, items: DataFrame) -> DataFrame:
    return run_summary(results, valid_items(items))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
