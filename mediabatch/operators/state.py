"""Processing state as an append-only log of record versions.

A record is keyed by (creator_name, processing_date). Changing one appends a version; the current
view keeps the newest version per key. All functions return rows, the caller appends them.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.functions.numbers import round2

KEY = ["creator_name", "processing_date"]

# Record lifetime in days, minutes until an unfinished record counts as stale.
TTL_DAYS = 30
STALE_MINUTES = 30


def moment(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def epoch_seconds(as_of: datetime) -> int:
    return int(as_of.replace(tzinfo=timezone.utc).timestamp())


def ttl_of(as_of: datetime) -> Column:
    return F.lit(epoch_seconds(as_of + timedelta(days=TTL_DAYS))).cast("long")


def current_state(log: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Newest version of every record; with `as_of`, expired records are gone."""
    newest = Window.partitionBy(*KEY).orderBy(F.desc("updated_at"), F.desc("version"))
    current = log.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    if as_of is None:
        return current
    return current.where(F.col("ttl").isNull() | (F.col("ttl") > epoch_seconds(as_of)))


def recent(log: DataFrame, as_of: datetime) -> DataFrame:
    """The part of the log that can hold unexpired records: its folders by day before that are not read."""
    first = (as_of - timedelta(days=TTL_DAYS + 1)).strftime("%Y-%m-%d")
    return log.where(F.col("processing_date") >= F.lit(first).cast("date"))


def of_day(log: DataFrame, as_of: datetime) -> DataFrame:
    return log.where(F.col("processing_date") == F.lit(as_of.strftime("%Y-%m-%d")).cast("date"))


def compact(log: DataFrame, as_of: datetime) -> DataFrame:
    """The log without superseded versions and expired records."""
    return current_state(log, as_of)


def history(state: DataFrame, k: int = 10, creator: str | None = None) -> DataFrame:
    """The last `k` records per creator, newest first, with their position."""
    if creator is not None:
        state = state.where(F.col("creator_name") == creator)
    newest = Window.partitionBy("creator_name").orderBy(F.desc("processing_date"))
    return state.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= k)


def latest_state(state: DataFrame) -> DataFrame:
    """The most recent record per creator."""
    return history(state, 1).drop("position")


# -- writes ------------------------------------------------------------------------------------


def create_records(
    current: DataFrame, requests: DataFrame, as_of: datetime, config_json: str = "{}", request_id: str = "local-test"
) -> DataFrame:
    """Outcome of opening today's record for each request (creator_name, batch_id, content_hash, image_count).

    A request is refused while that day's record is still `processing`; of several requests for one
    creator only the first by (batch_id, content_hash, image_count) gets through, as it blocks the others,
    and of a repeated request one copy. Returns every request in state-record form with `accepted`; append
    the accepted ones.
    """
    today = F.lit(as_of.strftime("%Y-%m-%d")).cast("date")
    existing = current.where(F.col("processing_date") == today).select(
        "creator_name", F.col("status").alias("old_status"), F.col("version").alias("old_version")
    )
    request = F.struct("batch_id", "content_hash", "image_count")
    first = requests.groupBy("creator_name").agg(F.min(request).alias("first"))
    # Copies of one request are alike, so it does not matter which of them is the first.
    same = Window.partitionBy("creator_name", "batch_id", "content_hash", "image_count").orderBy(F.lit(1))
    requests = requests.withColumn("copy", F.row_number().over(same))
    free = F.coalesce(F.col("old_status") != "processing", F.lit(True)) & (F.col("copy") == 1)
    return requests.join(first.join(existing, "creator_name", "left"), "creator_name").select(
        "creator_name",
        today.alias("processing_date"),
        F.lit("processing").alias("status"),
        "batch_id",
        "content_hash",
        F.col("image_count").cast("long").alias("image_count"),
        F.lit(config_json).alias("processing_config"),
        moment(as_of).alias("created_at"),
        moment(as_of).alias("updated_at"),
        ttl_of(as_of).alias("ttl"),
        F.lit(request_id).alias("lambda_request_id"),
        F.lit(0).cast("long").alias("processing_duration_ms"),
        F.lit("").alias("collage_s3_key"),
        F.lit(None).cast("string").alias("error_message"),
        F.coalesce(F.col("old_version") + 1, F.lit(0).cast("long")).alias("version"),
        (free & request.eqNullSafe(F.col("first"))).alias("accepted"),
    )


def update_records(current: DataFrame, updates: DataFrame, as_of: datetime) -> DataFrame:
    """New versions of existing records; only supplied fields change, unknown keys match nothing.

    `updates` has the key, `status` and any of `collage_s3_key`, `processing_duration_ms`,
    `error_message`; NULL (and an empty key or message) leaves the old value. Several updates of a key make
    one version: they are applied in the order of `ord`, if there is such a column, else in that of a record's life (`processing`
    before its ends, unknown statuses first), then of their values.
    """
    fields = [c for c in updates.columns if c not in (*KEY, "ord")]

    def value(name: str) -> Column:
        return F.nullif(name, F.lit("")) if name in ("collage_s3_key", "error_message") else F.col(name)

    stage = F.when(F.col("status").isin("completed", "failed"), 2).when(F.col("status") == "processing", 1).otherwise(0)
    order = F.col("ord") if "ord" in updates.columns else F.struct(stage, *fields)
    # The last value of each field that was supplied.
    last = [F.max_by(value(c), F.when(value(c).isNotNull(), order)).alias(f"new_{c}") for c in fields]
    u = updates.groupBy(*KEY).agg(*last)

    def merged(name: str):
        if f"new_{name}" not in u.columns:
            return F.col(name)
        return F.coalesce(F.col(f"new_{name}"), F.col(name))

    fixed = {
        "status": F.col("new_status"),
        "updated_at": moment(as_of),
        "version": F.col("version") + 1,
        "collage_s3_key": merged("collage_s3_key"),
        "processing_duration_ms": merged("processing_duration_ms"),
        "error_message": merged("error_message"),
    }
    return current.join(u, KEY).select(*[fixed.get(c, F.col(c)).alias(c) for c in current.columns])


def unmatched_updates(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates whose record does not exist."""
    return updates.join(current.select(*KEY), KEY, "left_anti")


def expire_stale(current: DataFrame, as_of: datetime, max_age_minutes: int = STALE_MINUTES) -> DataFrame:
    """New versions that fail the records stuck in `processing`."""
    cutoff = moment(as_of - timedelta(minutes=max_age_minutes))
    stuck = current.where((F.col("status") == "processing") & (F.col("created_at") < cutoff))
    return stuck.withColumns(
        {
            "status": F.lit("failed"),
            "updated_at": moment(as_of),
            "error_message": F.lit(f"Processing timed out after {max_age_minutes} minutes"),
            "version": F.col("version") + 1,
        }
    )


# -- reports -----------------------------------------------------------------------------------


def batch_records(state: DataFrame, batch_id: str) -> DataFrame:
    """The records of one batch."""
    return state.where(F.col("batch_id") == batch_id).select(
        "creator_name",
        F.coalesce("status", F.lit("unknown")).alias("status"),
        "created_at",
        "updated_at",
        F.coalesce("collage_s3_key", F.lit("")).alias("collage_s3_key"),
        F.coalesce("processing_duration_ms", F.lit(0)).alias("processing_duration_ms"),
    )


def batch_status(state: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Per batch: creators, count per status and completion in percent.

    With `batches`, exactly those ids are reported, unknown ones with zeros.
    """
    if batches is not None:
        state = state.join(batches.select("batch_id").distinct(), "batch_id", "left_semi")
    per_status = state.groupBy("batch_id", F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.sum("n")
    done = F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("n"))), F.lit(0))
    out = per_status.groupBy("batch_id").agg(
        total.alias("total_creators"),
        # At most one entry per status name.
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status_counts"),
        (done / total * 100).alias("completion_percentage"),
    )
    if batches is None:
        return out
    no_counts = F.create_map().cast("map<string,bigint>")
    return (
        batches.select("batch_id")
        .distinct()
        .join(out, "batch_id", "left")
        .select(
            "batch_id",
            F.coalesce("total_creators", F.lit(0).cast("long")).alias("total_creators"),
            F.coalesce("status_counts", no_counts).alias("status_counts"),
            F.coalesce("completion_percentage", F.lit(0.0)).alias("completion_percentage"),
        )
    )


def daily_stats(state: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Completed work per day and, as the row without a date, over the whole period.

    The period is `days` back from today, both ends included.
    """
    end = as_of.strftime("%Y-%m-%d")
    start = (as_of - timedelta(days=days)).strftime("%Y-%m-%d")
    done = state.where(
        (F.col("status") == "completed") & F.col("processing_date").between(
            F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    images, duration = F.coalesce("image_count", F.lit(0)), F.coalesce("processing_duration_ms", F.lit(0))
    sums = done.rollup("processing_date").agg(
        F.count(F.lit(1)).alias("creators"),
        F.coalesce(F.sum(images), F.lit(0)).alias("images"),
        F.coalesce(F.sum(duration), F.lit(0)).alias("duration_ms"),
    )
    return sums.withColumns(
        {
            "avg_images": round2(F.col("images") / F.col("creators")),
            "avg_duration_ms": round2(F.col("duration_ms") / F.col("creators")),
        }
    )
