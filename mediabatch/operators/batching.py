"""Assigning creators to balanced batches, one batch per creator.

Everything here works on one row per creator (name, image count, first position), never on item rows.
"""

from __future__ import annotations

from datetime import datetime
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.config import DEFAULT_CONFIG
from mediabatch.functions.hashing import name_bucket
from mediabatch.functions.text import canonical_json, csv_cell, json_quote
from mediabatch.session import shared_dir

# Images handled per second and worker, used for the time estimate.
IMAGES_PER_SECOND = 13

# Suggested batch size by data volume (upper bound, batch size), and the size beyond.
SUGGESTED_SIZES = ((1_000, 50), (10_000, 100), (100_000, 200))
SUGGESTED_BEYOND = 300

# What messages name as their source.
REFERENCE_SOURCE, DATA_SOURCE = "local_upload", "direct_data"

# Configuration sent along with a batch message.
BATCH_MESSAGE_CONFIG = {
    "rows": 5, "cols": 7, "quality": 95, "max_workers": 8, "timeout": 30, "max_retries": 3,
}


def creator_sizes(items: DataFrame) -> DataFrame:
    """One row per creator: image count and first position."""
    return items.groupBy("creator_name").agg(
        F.count(F.lit(1)).alias("image_count"), F.min("ord").alias("first_ord")
    )


# -- hash assignment ---------------------------------------------------------------------------


def hash_batches(
    sizes: DataFrame, total_batches: int, algo: str = "sha256", previous: DataFrame | None = None
) -> DataFrame:
    """Batch = stable hash of the name modulo the number of batches. No shuffle of its own."""
    out = sizes.withColumn(
        "batch_id", (name_bucket(F.col("creator_name"), algo) % total_batches).cast("int")
    )
    return keep_previous(out, previous) if previous is not None else out


def keep_previous(assignment: DataFrame, previous: DataFrame) -> DataFrame:
    """Creators that already have a batch keep it."""
    before = previous.select("creator_name", F.col("batch_id").alias("previous_batch"))
    return (
        assignment.join(before, "creator_name", "left")
        .withColumn("batch_id", F.coalesce("previous_batch", "batch_id"))
        .drop("previous_batch")
    )


# -- greedy packing ----------------------------------------------------------------------------


class _OpenBatches:
    """Sizes of the open batches, findable by size."""

    def __init__(self, target: int):
        self.target = target
        self.sizes: list[int] = []
        self.by_size: dict[int, list[int]] = {}

    def open(self, size: int = 0) -> int:
        self.sizes.append(0)
        self.put(len(self.sizes) - 1, size)
        return len(self.sizes) - 1

    def put(self, batch: int, size: int) -> None:
        self.sizes[batch] += size
        heappush(self.by_size.setdefault(self.sizes[batch], []), batch)

    def lowest(self, size: int) -> int | None:
        """Lowest batch id of exactly this size; outdated heap entries are dropped on the way."""
        heap = self.by_size.get(size)
        while heap:
            if self.sizes[heap[0]] == size:
                return heap[0]
            heappop(heap)
        return None

    def closest(self, extra: int) -> int | None:
        """The batch that lands nearest to the target with `extra` more, at most twice the target."""
        for gap in range(self.target + 1):
            sizes = {self.target - gap - extra, self.target + gap - extra}
            found = [self.lowest(size) for size in sizes if size >= 0]
            if any(batch is not None for batch in found):
                return min(batch for batch in found if batch is not None)
        return None


def _pack(target: int, shards: int):
    """Pack one shard: earlier creators keep their batch, then largest first: the hashed batch if it has room, else the
    nearest fit."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["image_count", "first_ord"], ascending=[False, True], kind="stable")
        pdf = pd.concat([pdf[pdf["previous_batch"].notna()], pdf[pdf["previous_batch"].isna()]])
        batches, chosen, kept = _OpenBatches(target), [], False
        rows = zip(pdf["image_count"].tolist(), pdf["bucket"].tolist(), pdf["previous_batch"].tolist())
        for n, bucket, before in rows:
            if not pd.isna(before):
                kept, wanted = True, int(before) // shards
                while len(batches.sizes) <= wanted:
                    batches.open()
                batches.put(wanted, n)
                chosen.append(wanted)
                continue
            if not batches.sizes:
                chosen.append(batches.open(n))
                continue
            wanted = bucket % (len(batches.sizes) + 1)
            while len(batches.sizes) <= wanted:
                batches.open()
            if batches.sizes[wanted] + n <= 1.5 * target:
                batches.put(wanted, n)
                chosen.append(wanted)
                continue
            nearest = batches.closest(n)
            if nearest is None:
                chosen.append(batches.open(n))
            else:
                batches.put(nearest, n)
                chosen.append(nearest)
        local = pd.Series(chosen, dtype="int64")
        if not kept:  # numbering without the empty batches; earlier ids stay as they are
            local = pd.Series(pd.factorize(local, sort=True)[0])
        out = pdf[["creator_name", "image_count"]].copy()
        out["batch_id"] = local.to_numpy() * shards + pdf["shard"].to_numpy()
        return out

    return pack


def balanced_batches(
    sizes: DataFrame,
    target: int,
    shards: int,
    previous: DataFrame | None = None,
    algo: str = "sha256",
) -> DataFrame:
    """Greedy balanced packing: (creator_name, image_count, batch_id).

    Greedy choices depend on all earlier ones, so creators are cut into `shards` hash shards that pack
    independently; one shard is the sequential packing. Choose as many as keep a shard's creators, a row
    each, in a task's memory. The n-th batch of shard s has the id n * shards + s: ids of a shard have no
    gaps, shards with fewer batches leave gaps at the end. With `previous` (packed with the same number of
    shards) every creator that has a batch keeps it, and no batch is renumbered.
    """
    bucket = name_bucket(F.col("creator_name"), algo)
    # Shards and preferred batches use different digest bits, or each shard would see few buckets.
    spread = F.conv(F.substring(F.sha2(F.lower("creator_name"), 256), 9, 8), 16, 10).cast("long")
    rows = sizes.select(
        "creator_name",
        "image_count",
        _sortable(sizes, "first_ord").alias("first_ord"),
        bucket.alias("bucket"),
        (spread % shards).alias("shard"),
    )
    if previous is not None:
        before = previous.select("creator_name", F.col("batch_id").cast("double").alias("previous_batch"))
        rows = rows.join(before, "creator_name", "left").withColumn(
            "shard", F.coalesce(F.col("previous_batch").cast("long") % shards, "shard")
        )
    else:
        rows = rows.withColumn("previous_batch", F.lit(None).cast("double"))
    return rows.groupBy("shard").applyInPandas(
        _pack(target, shards), "creator_name STRING, image_count LONG, batch_id LONG"
    )


def _sortable(df: DataFrame, name: str) -> Column:
    """A position column as something pandas sorts the same way."""
    if df.schema[name].dataType.typeName() != "struct":
        return F.col(name)
    fields = [F.col(f"{name}.{f.name}") for f in df.schema[name].dataType.fields]
    return F.concat_ws("\x01", *[
        F.lpad(c.cast("string"), 20, "0") if f.dataType.typeName() != "string" else c
        for c, f in zip(fields, df.schema[name].dataType.fields)
    ])


# -- next-fit packing --------------------------------------------------------------------------


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Exact 0-based position in a total order, without one task seeing all rows.

    A range-partitioned sort numbers rows inside each partition; the row counts of the earlier
    partitions are added. The sorted rows are checkpointed, so that both uses see the same numbers
    even when executors are lost in between.
    """
    shared_dir(df.sparkSession)
    sorted_rows = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    numbered = sorted_rows.withColumns({"_part": part, "_row": row}).drop("_id")
    # One row per sort partition.
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return numbered.join(offsets, "_part").withColumn(name, F.col("_offset") + F.col("_row")).drop(
        "_part", "_row", "_n", "_offset"
    )


def _next_fit_runs(target: int):
    """Walk the size histogram, largest size first, and note where each run of equal sizes starts."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("image_count", ascending=False)
        batch, filled, start, out = 0, 0, 0, []
        for size, count in zip(pdf["image_count"].tolist(), pdf["creators"].tolist()):
            fits = min(count, max(target - filled, 0) // size) if filled else 0
            per_batch = max(1, target // size)
            # `fits` creators join the open batch, then every `per_batch` of them start a new one.
            fresh = batch + 1 if filled else batch
            out.append((size, start, fits, per_batch, batch, fresh))
            rest = count - fits
            if rest:
                opened = -(-rest // per_batch)
                batch = fresh + opened - 1
                filled = (rest - (opened - 1) * per_batch) * size
            else:
                filled += fits * size
            start += count
        return pd.DataFrame(
            out, columns=["image_count", "run_start", "fits", "per_batch", "open_batch", "fresh_batch"]
        )

    return walk


def next_fit_batches(sizes: DataFrame, target: int = 100) -> DataFrame:
    """Next-fit over creators by falling size: (creator_name, image_count, batch_id), exact at any scale.

    Creators of equal size are interchangeable for the packing, so only the histogram of sizes (one
    row per distinct size) is walked in order; each creator's batch then follows from its rank.
    """
    ranked = global_rank(sizes, [F.desc("image_count"), F.asc("first_ord")])
    histogram = ranked.groupBy("image_count").agg(F.count(F.lit(1)).alias("creators"))
    runs = histogram.groupBy().applyInPandas(
        _next_fit_runs(target),
        "image_count LONG, run_start LONG, fits LONG, per_batch LONG, open_batch LONG, fresh_batch LONG",
    )
    place = F.col("rank") - F.col("run_start")
    later = F.col("fresh_batch") + F.floor((place - F.col("fits")) / F.col("per_batch"))
    batch = F.when(place < F.col("fits"), F.col("open_batch")).otherwise(later).cast("long")
    return ranked.join(runs, "image_count").select("creator_name", "image_count", batch.alias("batch_id"))


# -- assignment tables -------------------------------------------------------------------------


def save_assignment(assignment: DataFrame, path: str) -> None:
    assignment.write.mode("overwrite").parquet(path)


def attach_batches(items: DataFrame, assignment: DataFrame) -> DataFrame:
    """Item rows with their creator's batch."""
    return items.join(assignment.select("creator_name", "batch_id"), "creator_name")


def creators_of_batch(assignment: DataFrame, batch_id: int) -> DataFrame:
    return assignment.where(F.col("batch_id") == batch_id).select("creator_name", "image_count")


def batch_of_creator(assignment: DataFrame, creator: str) -> DataFrame:
    return assignment.where(F.col("creator_name") == creator).select("creator_name", "batch_id")


def batch_stats(assignment: DataFrame) -> DataFrame:
    """Creators and images per batch."""
    return assignment.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("creator_count"),
        F.sum("image_count").alias("image_total"),
        F.max("image_count").alias("largest_creator"),
    )


def batch_balance(assignment: DataFrame, target: int) -> DataFrame:
    """One row on how even the batches are, with the estimated run time of the largest."""
    totals = batch_stats(assignment)
    low, high, mean = F.min("image_total"), F.max("image_total"), F.sum("image_total") / F.count(F.lit(1))
    return totals.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("creator_count").alias("creators"),
        F.sum("image_total").alias("images"),
        low.alias("min_size"),
        high.alias("max_size"),
        mean.alias("avg_size"),
        F.when(mean > 0, (high - low) / mean).otherwise(F.lit(0.0)).alias("balance_score"),
        ((high - low) > 0.5 * target).alias("high_variance"),
        (high / F.lit(IMAGES_PER_SECOND)).alias("estimated_seconds"),
    )


def duplicate_creators(assignment: DataFrame) -> DataFrame:
    """Creators assigned to more than one batch."""
    return (
        assignment.groupBy("creator_name")
        .agg(F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"),
             F.countDistinct("batch_id").alias("batch_count"))
        .where(F.col("batch_count") > 1)
    )


def assignment_issues(by_creator: DataFrame, by_batch: DataFrame) -> DataFrame:
    """Disagreements between the creator-to-batch table and the batch-to-creator table."""
    left = by_creator.select("creator_name", F.col("batch_id").alias("assigned_batch"))
    right = by_batch.groupBy("creator_name").agg(
        F.count(F.lit(1)).alias("listings"), F.min("batch_id").alias("listed_batch")
    )
    issue = (
        F.when(F.col("assigned_batch").isNull(), "listed without assignment")
        .when(F.col("listings").isNull(), "assigned but not listed")
        .when(F.col("listings") > 1, "listed more than once")
        .when(F.col("assigned_batch") != F.col("listed_batch"), "batches differ")
    )
    return (
        left.join(right, "creator_name", "full_outer").withColumn("issue", issue).where(F.col("issue").isNotNull())
    )


def suggest_batch_size(total_images: Column) -> Column:
    out = F.lit(SUGGESTED_BEYOND)
    for bound, size in reversed(SUGGESTED_SIZES):
        out = F.when(total_images <= bound, F.lit(size)).otherwise(out)
    return out


# -- messages ----------------------------------------------------------------------------------


def reference_message(
    bucket: Column, key: Column, as_of: datetime, config: dict | None = None, output_prefix: str = ""
) -> Column:
    """JSON message that names a stored CSV file."""
    return _message({"processing_type": "csv_s3", "s3_bucket": bucket, "s3_key": key}, config, output_prefix,
                    as_of, REFERENCE_SOURCE)


def data_message(csv_data: Column, as_of: datetime, config: dict | None = None, output_prefix: str = "") -> Column:
    """JSON message that carries its CSV text."""
    return _message({"processing_type": "csv_data", "csv_data": csv_data}, config, output_prefix, as_of,
                    DATA_SOURCE)


def _message(parts: dict, config: dict | None, output_prefix: str, as_of: datetime, source: str) -> Column:
    """A JSON object of text columns and fixed values, in the given order."""
    fixed = {
        "processing_config": config or DEFAULT_CONFIG.as_dict(),
        "output_prefix": output_prefix,
        "timestamp": str(as_of),
        "source": source,
    }
    pieces, lead = [], "{"
    for name, value in {**parts, **fixed}.items():
        text = json_quote(value) if isinstance(value, Column) else F.lit(canonical_json(value))
        pieces += [F.lit(f'{lead}"{name}":'), text]
        lead = ","
    return F.concat(*pieces, F.lit("}"))


def batch_messages(rows: DataFrame, as_of: datetime, rows_per_message: int = 1_000) -> DataFrame:
    """The batches as messages that carry their CSV text: (batch_id, part, image_count, body).

    A batch of more than `rows_per_message` rows, as one huge creator makes it, is several messages: a
    message is bounded by the transport. Rows are numbered by one sort over all batches, so that no batch has
    to fit a task.
    """
    prefix = f"parallel_sqs_{as_of:%Y%m%d_%H%M%S}/"
    cells = rows.select("batch_id", "creator_name", "ord", "cover_url", "updated_at")
    ranked = global_rank(cells, [F.asc("batch_id"), F.asc("creator_name"), F.asc("ord")])
    starts = ranked.groupBy("batch_id").agg(F.min("rank").alias("start"))
    part = F.floor((F.col("rank") - F.col("start")) / rows_per_message)
    line = F.concat_ws(",", csv_cell(F.col("creator_name")), csv_cell(F.col("cover_url")),
                       csv_cell(F.col("updated_at")))
    lines = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    text = F.array_join(
        F.concat(F.array(F.lit("creator_name,cover_url,updated_at")), F.transform("lines", lambda p: p["line"])),
        "\n",
    )
    return (
        ranked.join(starts, "batch_id")
        .groupBy("batch_id", part.alias("part"))
        .agg(F.count(F.lit(1)).alias("image_count"), lines.alias("lines"))
        .select(
            "batch_id", "part", "image_count", data_message(text, as_of, BATCH_MESSAGE_CONFIG, prefix).alias("body")
        )
    )
