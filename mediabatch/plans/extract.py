"""From link records to batches: one job per product."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from mediabatch.operators.batching import (
    attach_batches,
    balanced_batches,
    creator_sizes,
    next_fit_batches,
)
from mediabatch.operators.ingest import batchable_items, explode_links, filter_links, remove_seen
from mediabatch.sources.csv_records import read_item_files


def extract_items(
    links: DataFrame,
    earlier: list[DataFrame] | None = None,
    date_filter=None,
    creator_filter=None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Filtered, flattened link records without the creators of earlier extracts."""
    chosen = filter_links(links, date_filter, creator_filter, as_of, newest_first=False)
    return remove_seen(explode_links(chosen), *(earlier or []))


def remove_seen_files(items: DataFrame, paths: list[str]) -> DataFrame:
    """Rows of creators that none of the earlier CSV files holds; missing files are passed over."""
    earlier, _ = read_item_files(items.sparkSession, paths)
    return remove_seen(items) if earlier is None else remove_seen(items, earlier)


def batch_items(
    items: DataFrame, target: int = 100, deduplicate: bool = True, shards: int = 1, **packing
) -> DataFrame:
    """Item rows with their batch; without deduplication the plain next-fit packing is used."""
    rows = batchable_items(items)
    sizes = creator_sizes(rows)
    assignment = balanced_batches(sizes, target, shards, **packing) if deduplicate else next_fit_batches(sizes, target)
    return attach_batches(rows, assignment)
