"""Which creators have to be (re)built."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediabatch.config import ProcessingConfig
from mediabatch.functions.hashing import collage_key
from mediabatch.functions.text import safe_name
from mediabatch.operators.fingerprint import creator_hash
from mediabatch.operators.objects import collage_owners
from mediabatch.operators.state import STALE_MINUTES, latest_state, moment

# An existing collage below this size in bytes is built again.
MIN_EXISTING_BYTES = 100 * 1024

DATE_FORMAT = "%Y-%m-%d"


def _filled(name: str):
    return F.coalesce(F.col(name), F.lit("")) != ""


def processed_decision(
    probe: DataFrame, state: DataFrame, as_of: datetime, processing_date: str | None = None
) -> DataFrame:
    """Is a creator's content already processed? `probe` has creator_name and content_hash.

    First rule that applies: no record; same hash completed; other hash; completed on the day;
    in progress (stale after 30 minutes); otherwise failed or incomplete.
    """
    day = processing_date or as_of.strftime(DATE_FORMAT)
    latest = latest_state(
        state.select(
            "creator_name", "processing_date", "status", "created_at", "collage_s3_key",
            F.col("content_hash").alias("old_hash"),
        )
    ).withColumn("known", F.lit(True))
    status = F.col("status")
    both = _filled("content_hash") & _filled("old_hash")
    same = both & (F.col("content_hash") == F.col("old_hash"))
    changed = both & (F.col("content_hash") != F.col("old_hash"))
    today = (F.col("processing_date") == F.lit(day).cast("date")) & (status == "completed")
    running = status == "processing"
    old = F.col("created_at") < moment(as_of - timedelta(minutes=STALE_MINUTES))
    rule = (
        F.when(F.col("known").isNull(), "no_record")
        .when(same & (status == "completed"), "same_content")
        .when(changed, "changed")
        .when(today, "done_today")
        .when(running & F.col("created_at").isNull(), "error")
        .when(running & old, "stale")
        .when(running, "in_progress")
        .otherwise("incomplete")
    )
    reasons = {
        "no_record": "No processing records found",
        "same_content": "Same content already processed successfully",
        "changed": "Content has changed since last processing",
        "done_today": "Already processed successfully today",
        "error": "Error checking status: no start time",
        "stale": "Previous processing appears stale",
        "in_progress": "Currently being processed",
        "incomplete": "Previous processing failed or incomplete",
    }
    named = F.lit(None).cast("string")
    for key, text in reasons.items():
        named = F.when(F.col("rule") == key, F.lit(text)).otherwise(named)
    return (
        probe.join(latest, "creator_name", "left")
        .withColumn("rule", rule)
        .select(
            *probe.columns,
            F.col("rule").isin("same_content", "done_today", "in_progress").alias("processed"),
            named.alias("reason"),
            (F.col("rule") == "changed").alias("content_changed"),
            (F.col("rule") == "stale").alias("stale"),
            F.col("status").alias("latest_status"),
            F.coalesce("collage_s3_key", F.lit("")).alias("latest_key"),
        )
    )


def skip_decision(
    expected: DataFrame,
    objects: DataFrame,
    prefix: str = "",
    deduplicate: bool = True,
    force: bool = False,
) -> DataFrame:
    """Does an equal collage already exist? `expected` has creator_name and s3_key.

    First rule that applies: deduplication off; forced; exact key too small; exact key; other
    collages of the creator; none.
    """
    if not deduplicate or force:
        why = "Deduplication disabled" if not deduplicate else "Force reprocess enabled"
        return expected.select(
            "*",
            F.lit(False).alias("should_skip"),
            F.lit(why).alias("skip_reason"),
            F.lit(None).cast("long").alias("existing_bytes"),
            F.lit(False).alias("content_has_changed"),
        )
    exact = objects.select("s3_key", F.col("size_bytes").alias("existing_bytes"))
    owners = collage_owners(objects, prefix)
    joined = (
        expected.withColumn("safe", safe_name(F.col("creator_name")))
        .join(exact, "s3_key", "left")
        .join(owners, "safe", "left")
    )
    size = F.col("existing_bytes")
    small = size < MIN_EXISTING_BYTES
    others = size.isNull() & F.col("collages").isNotNull()
    reason = (
        F.when(small, F.concat(F.lit("Existing collage too small ("), size.cast("string"), F.lit(" bytes)")))
        .when(size.isNotNull(), "Identical collage already exists")
        .when(others, "Creator has different content, will create new collage")
        .otherwise("No existing collages found")
    )
    return joined.select(
        *expected.columns,
        F.coalesce(size >= MIN_EXISTING_BYTES, F.lit(False)).alias("should_skip"),
        reason.alias("skip_reason"),
        "existing_bytes",
        others.alias("content_has_changed"),
    )


def plan_work(
    items: DataFrame,
    state: DataFrame,
    objects: DataFrame,
    config: ProcessingConfig,
    as_of: datetime,
    prefix: str = "",
    deduplicate: bool = True,
    force: bool = False,
) -> DataFrame:
    """Per creator of the valid `items`: hash and key of the capped content, and process or skip.

    The state decides first (unless forced), then the stored objects.
    """
    hashes = creator_hash(items, config.hash_metadata(), cap=config.cap).select(
        "creator_name", "content_hash", F.col("total_urls").alias("image_count")
    )
    expected = hashes.withColumn("s3_key", collage_key(F.col("creator_name"), F.col("content_hash"), prefix))
    known = processed_decision(expected, state, as_of)
    checked = skip_decision(known, objects, prefix, deduplicate, force)
    by_state = F.lit(deduplicate and not force) & F.col("processed")
    return checked.select(
        "creator_name",
        "content_hash",
        "image_count",
        F.when(by_state | F.col("should_skip"), "skip").otherwise("process").alias("action"),
        F.when(by_state, F.col("reason")).otherwise(F.col("skip_reason")).alias("reason"),
        F.when(by_state, F.col("latest_key")).otherwise(F.col("s3_key")).alias("s3_key"),
    )
