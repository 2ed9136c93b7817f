"""Run summaries over the per-creator result table.

A result row has creator_name, outcome (created, skipped, failed), image_count, s3_key, reason and,
where known, download_ms, placement_ms and save_ms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_TYPES = ("csv_s3", "csv_data")


def run_summary(results: DataFrame, items: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of a run: creators, created, skipped, failed, listed collages and images.

    Skipped creators are listed among the collages too. With `items` (the valid rows) the URL total
    before the cap is added.
    """
    outcome = F.col("outcome")
    summary = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_creators"),
        F.count_if(outcome == "created").alias("created"),
        F.count_if(outcome == "skipped").alias("skipped"),
        F.count_if(outcome == "failed").alias("failed"),
        F.count_if(outcome.isin("created", "skipped")).alias("collages_listed"),
        F.coalesce(F.sum(F.when(outcome != "failed", F.col("image_count"))), F.lit(0)).alias("listed_images"),
    )
    if items is None:
        return summary
    urls = items.groupBy(*by).agg(F.count(F.lit(1)).alias("total_urls"))
    if by:
        return summary.join(urls, list(by), "left")
    return summary.withColumn("total_urls", urls.select("total_urls").scalar())


def timing_summary(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Total time per stage and mean per collage, in milliseconds, over created collages."""
    created = results.where(F.col("outcome") == "created")
    stages = ["download_ms", "placement_ms", "save_ms"]
    whole = sum((F.coalesce(F.col(c), F.lit(0)) for c in stages), F.lit(0))
    n = F.count(F.lit(1))
    return created.groupBy(*by).agg(
        n.alias("collages"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in stages],
        F.coalesce(F.sum(whole), F.lit(0)).alias("total_ms"),
        F.when(n > 0, F.sum(whole) / n).otherwise(F.lit(0.0)).alias("avg_ms"),
    )


def dead_letter_patterns(dead: DataFrame, body: str = "body") -> DataFrame:
    """Failed messages by type; unreadable ones count as `parse_error`."""
    value = F.try_parse_json(F.col(body))
    parsed = dead.select(value.isNull().alias("bad"), F.try_variant_get(value, "$.processing_type", "string").alias("kind"))
    pattern = F.when(F.col("bad"), "parse_error").otherwise(F.coalesce("kind", F.lit("unknown")))
    return parsed.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("messages"))
