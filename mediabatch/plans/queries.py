"""Registered queries: every operator over whole tables. Each takes (spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediabatch.config import ProcessingConfig
from mediabatch.functions import hashing, keys
from mediabatch.functions.text import safe_name
from mediabatch.operators import (
    batching,
    compose,
    decisions,
    fingerprint,
    ingest,
    layout,
    messages,
    objects,
    report,
    state,
)
from mediabatch.plans import extract
from mediabatch.plans.tables import EVENTS_AS_OF, ORDERS_AS_OF, Tables, text_time
from mediabatch.session import shared_dir
from mediabatch.sources import csv_records, readers, writers
from mediabatch.sources.state_log import StateLog
from mediabatch.streaming import leases, redelivery, triggers

Query = Callable[[SparkSession, str], DataFrame]

CAP = 12
METADATA = {"rows": 5, "cols": 7, "quality": 95, "max_images": CAP}
CONFIG = ProcessingConfig(max_images_per_creator=CAP)
BATCHES = 37
TARGET = 100
SHARDS = 3
PREFIX = "out/"
CELL_W, CELL_H = 32, 24

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Tables(spark, folder))

    QUERIES[build.__name__] = run
    return build


def _valid(t: Tables) -> DataFrame:
    return ingest.valid_items(t.items())


def _run_folder(t: Tables) -> str:
    return f"{shared_dir(t.spark)}/run-{uuid.uuid4().hex}"


def _json_text(values: Column) -> Column:
    return F.array_join(values, "|")


# -- ingest ------------------------------------------------------------------------------------


@query
def capped_fingerprints(t: Tables) -> DataFrame:
    """The flagship slice: each creator's capped URLs, their content hash and the output key."""
    hashes = fingerprint.creator_hash(_valid(t), METADATA, cap=CAP)
    return fingerprint.output_keys(hashes, PREFIX).select(
        "creator_name", F.col("total_urls").alias("image_count"), "content_hash", "file_name", "s3_key"
    )


@query
def valid_items(t: Tables) -> DataFrame:
    return _valid(t)


@query
def invalid_items(t: Tables) -> DataFrame:
    return ingest.invalid_items(t.items())


@query
def batchable_items(t: Tables) -> DataFrame:
    return ingest.batchable_items(t.items())


def _links_out(links: DataFrame) -> DataFrame:
    return links.withColumn("updated_at", text_time(F.col("updated_at")))


@query
def date_range_links(t: Tables) -> DataFrame:
    return _links_out(ingest.filter_links(t.order_links(), "last_30_days", None, ORDERS_AS_OF))


@query
def creator_like(t: Tables) -> DataFrame:
    return _links_out(ingest.filter_links(t.order_links(), None, "0000012"))


@query
def creator_like_any_case(t: Tables) -> DataFrame:
    return _links_out(ingest.filter_links(t.order_links(), None, "CUSTOMER#00000001", ignore_case=True))


@query
def creator_in(t: Tables) -> DataFrame:
    names = ["Customer#000000003", "Customer#000000010", "Customer#000000077"]
    return _links_out(ingest.filter_links(t.order_links(), ("1996-01-01", "2000-12-31"), names))


@query
def explode_links(t: Tables) -> DataFrame:
    return ingest.explode_links(t.links())


@query
def remove_seen_creators(t: Tables) -> DataFrame:
    half = t.seen_creators().where(F.col("creator_name") < "Customer#000000500")
    return ingest.remove_seen(t.items(), half, t.seen_creators())


@query
def cap_per_creator(t: Tables) -> DataFrame:
    return ingest.cap_per_creator(_valid(t), CAP)


@query
def extract_items(t: Tables) -> DataFrame:
    return extract.extract_items(t.links(), [t.seen_creators()], "last_365_days", None, ORDERS_AS_OF)


@query
def csv_items_scan(t: Tables) -> DataFrame:
    """Items written by the CSV sink and scanned back, past a file that is no CSV.

    Names hold commas and quotes, or line breaks.
    """
    name, kind = F.col("creator_name"), F.col("ord") % 3
    odd = F.when(kind == 1, F.concat(name, F.lit(', "x"'))).when(kind == 2, F.concat(name, F.lit("\ny"))).otherwise(name)
    run = _run_folder(t)
    path = writers.write_items(t.items().withColumn("creator_name", odd), run, ORDERS_AS_OF)
    t.items().select("creator_name").write.text(f"{path}/notes")
    return readers.read_items(t.spark, path).drop("ord")


CSV_LAYOUTS = [["creator_name", "cover_url", "updated_at"], ["updated_at", "cover_url", "creator_name"], ["cover_url"]]


def _stored_layouts(t: Tables, rows: DataFrame, root: str) -> DataFrame:
    """Item rows as CSV files of three headers below `root`; returns the files' paths."""
    for i, columns in enumerate(CSV_LAYOUTS):
        writers.write_csv(rows.where(F.col("ord") % 3 == i).select(*columns), f"{root}/{i}")
    listed = t.spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return listed.option("pathGlobFilter", readers.CSV_GLOB).load(root).select("path")


@query
def csv_records_scan(t: Tables) -> DataFrame:
    """CSV files of three headers, with quotes and line breaks in their cells, as one scan that may be split."""
    name = F.concat("creator_name", F.lit(', "x"\n'), F.col("ord").cast("string"))
    rows = t.items().withColumn("creator_name", F.when(F.col("ord") % 2 == 0, name).otherwise(F.col("creator_name")))
    paths = _stored_layouts(t, rows, _run_folder(t))
    return csv_records.read_records(t.spark, [r.path for r in paths.toLocalIterator()]).drop("ord")


@query
def listed_files(t: Tables) -> DataFrame:
    """The folders of batch files in an object listing."""
    rows = batching.attach_batches(ingest.batchable_items(t.items()), _hash_assignment(t))
    run = _run_folder(t)
    writers.write_batches(rows, run, ORDERS_AS_OF)
    listed = readers.list_objects(t.spark, run, "20010802_000000/")
    named = listed.where(F.endswith("s3_key", F.lit(".csv")) & (F.col("size_bytes") > 0))
    return named.select(F.substring_index("s3_key", "/", 2).alias("folder")).distinct()


@query
def landing_rows(t: Tables) -> DataFrame:
    """Rows written in the landing layout and read back by day and trigger."""
    run = _run_folder(t)
    for trigger in ("s3", "sqs"):
        writers.write_landing(t.items().select(*writers.ITEM_COLUMNS), run, trigger, ORDERS_AS_OF)
    back = readers.read_items(t.spark, run)
    place = F.col("ord.file")
    return back.select(
        "creator_name",
        "cover_url",
        F.regexp_extract(place, "dt=([^/]+)", 1).alias("dt"),
        F.regexp_extract(place, "trigger=([^/]+)", 1).alias("trigger"),
    )


# -- fingerprints ------------------------------------------------------------------------------


@query
def creator_counts(t: Tables) -> DataFrame:
    out = fingerprint.creator_counts(ingest.batchable_items(t.items()), with_total=True)
    return out.select("creator_name", "image_count", F.col("is_total").cast("int").alias("is_total"))


@query
def creators_by_size(t: Tables) -> DataFrame:
    return fingerprint.creators_by_size(_valid(t))


@query
def creator_urls(t: Tables) -> DataFrame:
    return fingerprint.creator_urls(_valid(t), CAP).select("creator_name", _json_text(F.col("urls")).alias("urls"))


@query
def creator_hash(t: Tables) -> DataFrame:
    """Uncapped, over all rows: error markers repeat, so multiplicities count; blanks do not."""
    return fingerprint.creator_hash(t.items(), METADATA)


@query
def creator_hash_sha1(t: Tables) -> DataFrame:
    return fingerprint.creator_hash(t.items(), None, "sha1")


@query
def url_set_hash(t: Tables) -> DataFrame:
    return fingerprint.url_set_hash(t.items(), "md5")


def _hash_assignment(t: Tables) -> DataFrame:
    return batching.hash_batches(batching.creator_sizes(t.items()), BATCHES)


@query
def batch_hash(t: Tables) -> DataFrame:
    return fingerprint.batch_hash(batching.attach_batches(t.items(), _hash_assignment(t)))


@query
def daily_fingerprint(t: Tables) -> DataFrame:
    return fingerprint.daily_fingerprint(_valid(t), {"rows": 5, "cols": 7}, ORDERS_AS_OF, cap=CAP).select(
        "creator_name", "fingerprint"
    )


@query
def content_diff(t: Tables) -> DataFrame:
    old, new = t.items().where("ord % 7 <> 0"), t.items().where("ord % 5 <> 0")
    return fingerprint.content_diff(old, new)


@query
def content_diff_hashes(t: Tables) -> DataFrame:
    old, new = t.items().where("ord % 7 <> 0"), t.items().where("ord % 5 <> 0")
    return fingerprint.content_diff(old, new, with_hashes=True).select(
        "creator_name", "content_changed", "old_hash", "new_hash"
    )


@query
def content_diff_urls(t: Tables) -> DataFrame:
    old, new = t.items().where("ord % 7 <> 0"), t.items().where("ord % 5 <> 0")
    return fingerprint.content_diff_urls(old, new)


@query
def output_names(t: Tables) -> DataFrame:
    """Every name derived from a host: safe forms, keys, their creator part, type and bucket."""
    name = F.col("creator_name")
    hashed = fingerprint.creator_hash(t.pages_items(), None, "md5")
    named = fingerprint.output_keys(hashed, "", "png")
    return named.select(
        "creator_name",
        safe_name(name).alias("safe"),
        "file_name",
        "s3_key",
        hashing.legacy_collage_key(name, PREFIX, state.moment(ORDERS_AS_OF)).alias("legacy_key"),
        keys.creator_of_key(F.col("s3_key")).alias("creator_from_key"),
        keys.content_type(F.col("s3_key")).alias("content_type"),
        hashing.name_bucket(name).alias("bucket"),
        hashing.valid_hash(F.col("content_hash"), "md5").alias("valid_md5"),
        hashing.valid_hash(F.col("content_hash"), "sha256").alias("valid_sha256"),
    )


# -- batching ----------------------------------------------------------------------------------


def _sizes(t: Tables) -> DataFrame:
    return batching.creator_sizes(ingest.batchable_items(t.items()))


@query
def hash_batches(t: Tables) -> DataFrame:
    return batching.hash_batches(_sizes(t), BATCHES).select("creator_name", "image_count", "batch_id")


@query
def sticky_batches(t: Tables) -> DataFrame:
    """Seen creators keep an earlier batch, the others are hashed."""
    before = t.seen_creators().withColumn("batch_id", F.lit(99))
    out = batching.hash_batches(_sizes(t), BATCHES, "md5", before)
    return out.select("creator_name", "image_count", "batch_id")


@query
def next_fit_batches(t: Tables) -> DataFrame:
    return batching.next_fit_batches(_sizes(t), TARGET)


@query
def balanced_batches(t: Tables) -> DataFrame:
    return batching.balanced_batches(_sizes(t), TARGET, shards=1)


@query
def sharded_batches(t: Tables) -> DataFrame:
    return batching.balanced_batches(_sizes(t), TARGET, SHARDS)


@query
def sticky_balanced_batches(t: Tables) -> DataFrame:
    """Seen creators keep batches of an earlier packing, the others are packed around them."""
    number = F.substring_index("creator_name", "#", -1).cast("long")
    before = t.seen_creators().withColumn("batch_id", number % 40)
    return batching.balanced_batches(_sizes(t), TARGET, SHARDS, before)


@query
def saved_assignment(t: Tables) -> DataFrame:
    path = f"{_run_folder(t)}/assignment"
    batching.save_assignment(batching.hash_batches(_sizes(t), BATCHES), path)
    return readers.read_assignment(t.spark, path).select("creator_name", "image_count", "batch_id")


@query
def batch_stats(t: Tables) -> DataFrame:
    return batching.batch_stats(batching.hash_batches(_sizes(t), BATCHES))


@query
def batch_balance(t: Tables) -> DataFrame:
    return batching.batch_balance(batching.next_fit_batches(_sizes(t), TARGET), TARGET)


def _split_assignment(t: Tables) -> DataFrame:
    """Batches dealt by order instead of creator, so that creators are split."""
    return t.items().select("creator_name", (F.col("ord") % 5).alias("batch_id"))


@query
def duplicate_creators(t: Tables) -> DataFrame:
    return batching.duplicate_creators(_split_assignment(t))


@query
def assignment_issues(t: Tables) -> DataFrame:
    """A creator-to-batch table against a batch-to-creator table with gaps, moves and repeats."""
    by_creator = _hash_assignment(t).select("creator_name", "batch_id").where("batch_id <> 5")
    listed = t.raw("customer").select(F.col("c_name").alias("creator_name"), "c_custkey")
    listed = listed.withColumn("batch_id", (hashing.name_bucket(F.col("creator_name")) % BATCHES).cast("int"))
    moved = listed.where("c_custkey % 50 <> 1").withColumn(
        "batch_id", F.when(F.col("c_custkey") % 50 == 2, F.lit(0)).otherwise(F.col("batch_id"))
    )
    again = listed.where("c_custkey % 50 = 3")
    return batching.assignment_issues(by_creator, moved.unionByName(again).drop("c_custkey"))


@query
def attach_batches(t: Tables) -> DataFrame:
    return batching.attach_batches(ingest.batchable_items(t.items()), _hash_assignment(t))


@query
def batch_messages(t: Tables) -> DataFrame:
    """Messages of at most 400 rows: a larger batch is several."""
    rows = batching.attach_batches(ingest.batchable_items(t.items()), _hash_assignment(t))
    return batching.batch_messages(rows, ORDERS_AS_OF, 400)


@query
def batch_files(t: Tables) -> DataFrame:
    """Batch files written and read back: rows per batch folder."""
    rows = batching.attach_batches(ingest.batchable_items(t.items()), _hash_assignment(t))
    path = writers.write_batches(rows, _run_folder(t), ORDERS_AS_OF)
    back = readers.read_items(t.spark, path)
    name = F.regexp_extract("ord.file", "parallel_batch=([0-9]+)", 1)
    return back.groupBy(name.alias("batch_file")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("creator_name").alias("creators")
    )


@query
def suggested_sizes(t: Tables) -> DataFrame:
    """Suggested batch size for the image total of each batch and of all of them."""
    totals = _hash_assignment(t).rollup("batch_id").agg(F.sum("image_count").alias("images"))
    return totals.withColumn("batch_size", batching.suggest_batch_size(F.col("images")))


@query
def reference_messages(t: Tables) -> DataFrame:
    key = F.concat(F.lit("csv-files/"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return t.raw("orders").select(
        "o_orderkey", batching.reference_message(F.lit("in"), key, ORDERS_AS_OF, None, "p/").alias("body")
    )


# -- state -------------------------------------------------------------------------------------


def _current(t: Tables) -> DataFrame:
    return state.current_state(t.state_log(), EVENTS_AS_OF)


def _state_out(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "creator_name",
        F.date_format("processing_date", "yyyy-MM-dd").alias("processing_date"),
        "status",
        "batch_id",
        "content_hash",
        "image_count",
        "processing_duration_ms",
        "collage_s3_key",
        "error_message",
        "ttl",
        "version",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
        *more,
    )


@query
def current_state(t: Tables) -> DataFrame:
    return _state_out(_current(t))


@query
def unexpired_state(t: Tables) -> DataFrame:
    return _state_out(state.compact(t.state_log(), datetime(2024, 2, 10)))


@query
def latest_state(t: Tables) -> DataFrame:
    return _state_out(state.latest_state(_current(t)))


@query
def state_history(t: Tables) -> DataFrame:
    return _state_out(state.history(_current(t), 5), "position")


NOON = datetime(2024, 1, 30, 12)


def _requests(t: Tables) -> DataFrame:
    events = t.state_log().where(F.col("processing_date") == F.lit("2024-01-30").cast("date"))
    requests = events.select("creator_name", F.concat("batch_id", F.lit("-"), "version").alias("batch_id"),
                             "content_hash", "image_count")
    # Every second request is delivered twice.
    return requests.unionByName(requests.where(F.substring("batch_id", -1, 1).cast("int") % 2 == 0))


@query
def conditional_create(t: Tables) -> DataFrame:
    """Opening today's records for every event of the day, against the state at noon."""
    before = t.state_log().where(F.col("created_at") < state.moment(NOON))
    current = state.current_state(before, NOON)
    return _state_out(state.create_records(current, _requests(t), NOON), "accepted")


def _updates(t: Tables) -> DataFrame:
    user = F.col("user_id")
    done = user % 3 == 0
    return t.raw("events").select("user_id").distinct().select(
        F.concat(F.lit("u"), user.cast("string")).alias("creator_name"),
        F.lit("2024-01-30").cast("date").alias("processing_date"),
        F.when(done, "completed").otherwise("failed").alias("status"),
        F.when(done, F.concat(F.lit("k"), user.cast("string"))).otherwise("").alias("collage_s3_key"),
        F.when(done, user * 10).alias("processing_duration_ms"),
        F.when(user % 3 == 1, "boom").alias("error_message"),
    )


def _update_log(t: Tables) -> DataFrame:
    """Two updates per key, in order: first a note that work began, then the outcome."""
    began = _updates(t).select(
        "creator_name",
        "processing_date",
        F.lit("processing").alias("status"),
        F.lit("").alias("collage_s3_key"),
        F.lit(5).cast("long").alias("processing_duration_ms"),
        F.lit("early").alias("error_message"),
        F.lit(0).alias("ord"),
    )
    return _updates(t).withColumn("ord", F.lit(1)).unionByName(began)


@query
def status_update(t: Tables) -> DataFrame:
    return _state_out(state.update_records(_current(t), _update_log(t), EVENTS_AS_OF))


@query
def status_stream(t: Tables) -> DataFrame:
    """The stored log after a stream of updates: outcomes recorded, stuck records failed."""
    run = _run_folder(t)
    writers.append_state(t.state_log(), f"{run}/state")
    updates = _update_log(t)
    updates.write.parquet(f"{run}/updates")
    arriving = t.spark.readStream.schema(updates.schema).parquet(f"{run}/updates")
    triggers.status_stream(
        t.spark, arriving, f"{run}/state", f"{run}/checkpoint", lambda: EVENTS_AS_OF
    ).awaitTermination()
    return _state_out(state.current_state(readers.read_state(t.spark, f"{run}/state")))


@query
def snapshot_state(t: Tables) -> DataFrame:
    """The current records read from a snapshot and the log's tail: two segments are folded, the third one is not."""
    log = StateLog(t.spark, f"{_run_folder(t)}/log")
    part = F.col("version") % 3
    log.append(t.state_log().where(part == 2))
    log.append(t.state_log().where(part == 0))
    log.write_snapshot(EVENTS_AS_OF)
    log.append(t.state_log().where(part == 1))
    return _state_out(log.current(EVENTS_AS_OF))


@query
def creator_lease_stream(t: Tables) -> DataFrame:
    """Opening the day's records by a stateful stream that starts from the records at noon: the log form's outcomes."""
    run = _run_folder(t)
    before = state.current_state(t.state_log().where(F.col("created_at") < state.moment(NOON)), NOON)
    day = F.lit("2024-01-30").cast("date")
    requests = _requests(t)
    none = F.lit(None)
    opening = requests.select(
        F.lit("open").alias("kind"), "creator_name", day.alias("processing_date"), "batch_id", "content_hash", "image_count",
        none.cast("string").alias("status"), none.cast("long").alias("ord"),
    )
    current = before.where(F.col("processing_date") == day)
    opening.unionByName(leases.records(current)).write.parquet(f"{run}/inbox")
    arriving = t.spark.readStream.schema(leases.EVENTS).parquet(f"{run}/inbox")
    leases.lease_stream(arriving, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    out = t.spark.read.schema(leases.OUTCOMES).parquet(f"{run}/out")
    return out.select("creator_name", "outcome", "batch_id", "content_hash", "image_count", "version")


@query
def unmatched_updates(t: Tables) -> DataFrame:
    return state.unmatched_updates(_current(t), _updates(t)).select("creator_name", "status")


@query
def stale_cleanup(t: Tables) -> DataFrame:
    return _state_out(state.expire_stale(_current(t), EVENTS_AS_OF))


@query
def batch_status(t: Tables) -> DataFrame:
    """Every batch, plus one that does not exist."""
    ids = t.raw("events").select(F.concat(F.lit("b"), (F.col("event_id") % 60).cast("string")).alias("batch_id"))
    out = state.batch_status(_current(t), ids)

    def count(status):
        return F.coalesce(F.element_at("status_counts", F.lit(status)), F.lit(0)).alias(status)

    return out.select("batch_id", "total_creators", *map(count, ("completed", "failed", "processing")),
                      "completion_percentage")


@query
def batch_records(t: Tables) -> DataFrame:
    return state.batch_records(_current(t), "b7").select("creator_name", "status", "processing_duration_ms")


@query
def daily_stats(t: Tables) -> DataFrame:
    out = state.daily_stats(_current(t), datetime(2024, 1, 30), 7)
    return out.withColumn("processing_date", F.date_format("processing_date", "yyyy-MM-dd"))


# -- decisions ---------------------------------------------------------------------------------

PROBE_TIME = datetime(2024, 1, 30, 12)


@query
def processed_decision(t: Tables) -> DataFrame:
    before = t.state_log().where(F.col("created_at") <= state.moment(PROBE_TIME))
    return decisions.processed_decision(t.state_probe(), state.current_state(before, PROBE_TIME), PROBE_TIME)


def _known_objects(t: Tables) -> DataFrame:
    """The listing plus the exact collage of every third creator, in sizes around the limit."""
    number = F.substring_index("creator_name", "#", -1).cast("long")
    exact = fingerprint.output_keys(fingerprint.creator_hash(_valid(t), METADATA, cap=CAP), PREFIX)
    made = exact.where(number % 3 == 0).select(
        "s3_key",
        (102_396 + number % 8).alias("size_bytes"),
        F.lit(None).cast("timestamp_ntz").alias("last_modified"),
        F.lit("image/jpeg").alias("content_type"),
    )
    return t.objects().unionByName(made)


@query
def skip_decision(t: Tables) -> DataFrame:
    expected = fingerprint.output_keys(fingerprint.creator_hash(_valid(t), METADATA, cap=CAP), PREFIX)
    return decisions.skip_decision(expected.select("creator_name", "s3_key"), _known_objects(t), PREFIX)


def _creator_state(t: Tables) -> DataFrame:
    """State records of the customers: some with the right hash, others without or in progress."""
    number = F.substring_index("creator_name", "#", -1).cast("long")
    hashes = fingerprint.creator_hash(_valid(t), METADATA, cap=CAP)
    hash_kind = F.when(number % 4 == 0, F.col("content_hash")).when(number % 4 == 1, F.md5("creator_name"))
    return hashes.where(number % 5 != 0).select(
        "creator_name",
        F.lit(ORDERS_AS_OF.date()).alias("processing_date"),
        F.when(number % 3 == 0, "completed").when(number % 3 == 1, "processing").otherwise("failed").alias("status"),
        hash_kind.otherwise("").alias("content_hash"),
        state.moment(ORDERS_AS_OF.replace(year=2001, month=8, day=1)).alias("created_at"),
        F.concat(F.lit("old/"), "creator_name").alias("collage_s3_key"),
    )


@query
def final_decision(t: Tables) -> DataFrame:
    return decisions.plan_work(_valid(t), _creator_state(t), _known_objects(t), CONFIG, ORDERS_AS_OF, PREFIX)


# -- objects -----------------------------------------------------------------------------------


def _customers(t: Tables) -> DataFrame:
    return t.raw("customer").select(F.col("c_name").alias("creator_name"))


@query
def existing_for_creator(t: Tables) -> DataFrame:
    found = objects.existing_for_creator(_customers(t), t.objects(), PREFIX)
    return found.select("creator_name", "s3_key", "size_bytes")


@query
def existing_page(t: Tables) -> DataFrame:
    """The same with the listing page, of five keys each, that a creator's key is on."""
    found = objects.existing_for_creator(_customers(t), t.objects(), PREFIX, page_size=5)
    return found.select("creator_name", "s3_key", "page")


@query
def retention_plan(t: Tables) -> DataFrame:
    found = objects.existing_for_creator(_customers(t), t.objects(), PREFIX)
    return objects.retention_plan(found, 2).select("creator_name", "s3_key", "action")


@query
def object_metadata(t: Tables) -> DataFrame:
    return objects.object_metadata(t.objects()).select("s3_key", "size_bytes", "content_type", "file_name",
                                                       "creator_from_key")


@query
def object_stats(t: Tables) -> DataFrame:
    return objects.object_stats(t.objects(), PREFIX)


@query
def object_integrity(t: Tables) -> DataFrame:
    out = objects.object_integrity(t.objects(), ORDERS_AS_OF)
    texts = F.transform("checks", lambda c: F.concat_ws(":", c["check"], c["passed"].cast("string"), c["message"]))
    return out.select("s3_key", "valid", "age_days", _json_text(texts).alias("checks"))


@query
def lifecycle_tiers(t: Tables) -> DataFrame:
    out = objects.lifecycle_tiers(t.stored_objects(), datetime(1998, 6, 1))
    return out.select("s3_key", "store", "age_days", "rule", "tier", "expired")


@query
def lifecycle_by_rules(t: Tables) -> DataFrame:
    """Tiers under a table of overlapping rules: each store's prefix, and a nation's first digits of the order within it."""
    nation, number = t.raw("nation"), F.col("n_nationkey").cast("string")
    wide = nation.where("n_nationkey < 3").select(
        F.element_at(F.array(F.lit("input"), F.lit("output"), F.lit("temp")), F.col("n_nationkey").cast("int") + 1).alias("store"),
        F.element_at(F.array(F.lit("csv-files/"), F.lit("collages/"), F.lit("")), F.col("n_nationkey").cast("int") + 1).alias("prefix"),
        F.lit(30).alias("age_days"),
        F.lit("STANDARD_IA").alias("tier"),
    )
    narrow = [
        nation.select(
            F.lit("input").alias("store"),
            F.concat(F.lit("csv-files/"), number).alias("prefix"),
            (F.col("n_regionkey") * 100 + 300 * step).cast("int").alias("age_days"),
            F.lit(tier).alias("tier"),
        )
        for step, tier in ((1, "GLACIER"), (4, "DEEP_ARCHIVE"))
    ]
    rules = wide.unionByName(narrow[0]).unionByName(narrow[1])
    out = objects.lifecycle_by_rules(t.stored_objects(), rules, datetime(1998, 6, 1))
    return out.select("s3_key", "store", "age_days", "rule", "tier")


# -- layout and images -------------------------------------------------------------------------


@query
def cell_size(t: Tables) -> DataFrame:
    return layout.cell_size(t.dims())


@query
def cell_size_by_width(t: Tables) -> DataFrame:
    return layout.cell_size(t.dims(), target_width=257)


@query
def cell_size_by_height(t: Tables) -> DataFrame:
    return layout.cell_size(t.dims(), target_height=263)


def _layout_out(out: DataFrame) -> DataFrame:
    return out.select(
        "creator_name", "ord.l_orderkey", "ord.l_linenumber", "ord.l_partkey", "grid_row", "grid_col", "x", "y",
        "cell_w", "cell_h", "canvas_w", "canvas_h",
    )


@query
def grid_layout(t: Tables) -> DataFrame:
    return _layout_out(layout.grid_layout(t.dims()))


@query
def grid_layout_crop(t: Tables) -> DataFrame:
    return _layout_out(layout.grid_layout(t.dims(), fit="crop"))


@query
def combined_layout(t: Tables) -> DataFrame:
    out = layout.combined_layout(layout.valid_images(t.dims()))
    return out.select("source_creator", "source_ord.l_orderkey", "source_ord.l_linenumber", "x", "y", "cell_w",
                      "cell_h")


@F.pandas_udf(T.LongType())
def _cell_checksum(data: pd.Series) -> pd.Series:
    """Channel sums per grid cell, weighted by the cell's number."""

    def total(raw):
        grid = np.frombuffer(raw, np.uint8).reshape(5, CELL_H, 7, CELL_W * 3)
        return int(grid.sum(axis=(1, 3), dtype=np.int64).reshape(-1) @ np.arange(1, 36))

    return data.map(total)


@query
def compose_collage(t: Tables) -> DataFrame:
    """Collages of generated images; the checksum depends on every pixel and its cell."""
    made = compose.compose(t.image_sizes(), target_width=CELL_W, target_height=CELL_H, pixels=t.image())
    return made.select("creator_name", "width", "height", "placed", _cell_checksum("image.data").alias("checksum"))


@query
def image_duplicates(t: Tables) -> DataFrame:
    """Equal contents inside a batch; document texts stand in for image bytes, languages for batches."""
    images = t.raw("documents").select(
        F.col("lang").alias("batch_id"), F.col("doc_id").alias("ord"), F.encode("text", "UTF-8").alias("data")
    )
    return compose.image_duplicates(images)


def _offline_fetcher(url: str, timeout: int) -> tuple[str, bytes]:
    """Stands in for the network: the URL's number decides what happens; what is no URL is refused."""
    if not url.startswith("https://"):
        raise ValueError("unknown url type")
    number = int(url.rsplit("/", 1)[1].split(".")[0])
    if number % 10 == 3:
        raise OSError("unreachable")
    return ("text/html" if number % 10 == 7 else "image/png"), b"x" * (number % 100)


@query
def fetch_counts(t: Tables) -> DataFrame:
    """All rows, blank URLs and error markers among them: blanks are not fetched, markers fail."""
    fetched = compose.fetch(t.items(), CONFIG, _offline_fetcher, pause=lambda s: None)
    return compose.fetch_counts(fetched).drop("fetch_ms")


# -- messages, reports, streams ----------------------------------------------------------------


def _parsed(t: Tables) -> DataFrame:
    return messages.parse_messages(t.messages(), ORDERS_AS_OF)


@query
def message_routing(t: Tables) -> DataFrame:
    return _parsed(t).select(
        "message_id", "processing_type", "s3_bucket", "s3_key", "output_prefix", "batch_id", "reason"
    )


@query
def merged_config(t: Tables) -> DataFrame:
    return _parsed(t).where("readable").select("message_id", "config.*")


@query
def config_validation(t: Tables) -> DataFrame:
    return _parsed(t).select("message_id", _json_text(F.col("config_errors")).alias("errors"))


@query
def message_items(t: Tables) -> DataFrame:
    rows = messages.message_items(messages.accepted(_parsed(t), "csv_data"), ("message_id", "batch_id"))
    return ingest.valid_items(rows)


@query
def dead_letters(t: Tables) -> DataFrame:
    return messages.rejected(_parsed(t)).groupBy("reason", "attempt").agg(F.count(F.lit(1)).alias("messages"))


@query
def dead_letter_patterns(t: Tables) -> DataFrame:
    return report.dead_letter_patterns(messages.rejected(_parsed(t)))


@query
def reprocess_messages(t: Tables) -> DataFrame:
    again = messages.reprocess(messages.retryable(messages.rejected(_parsed(t))), ORDERS_AS_OF, 120)

    def part(path):
        return F.get_json_object("new_body", f"$.{path}")

    return again.select(
        "body",
        part("processing_type").alias("processing_type"),
        part("source").alias("source"),
        part("timestamp").alias("stamp"),
        part("processing_config.timeout").alias("timeout"),
        part("processing_config.max_retries").alias("max_retries"),
        part("processing_config.max_workers").alias("max_workers"),
        part("processing_config.quality").alias("quality"),
    )


@query
def run_summary(t: Tables) -> DataFrame:
    return report.run_summary(t.results(), by=("day",))


@query
def run_summary_total(t: Tables) -> DataFrame:
    return report.run_summary(t.results(), _valid(t))


@query
def stored_summary(t: Tables) -> DataFrame:
    """The daily run summary as the JSON sink stores it."""
    path = writers.write_summary(report.run_summary(t.results(), by=("day",)), _run_folder(t), ORDERS_AS_OF, "manual")
    names = "day STRING, total_creators LONG, created LONG, skipped LONG, failed LONG, listed_images LONG"
    return t.spark.read.schema(names).json(path)


@query
def timing_summary(t: Tables) -> DataFrame:
    return report.timing_summary(t.results(), by=("day",))


@query
def stream_messages(t: Tables) -> DataFrame:
    """The message trigger over all messages, run to completion: rows per reason and type."""
    run = _run_folder(t)
    t.messages().select("body").write.text(f"{run}/inbox")
    triggers.message_stream(
        t.spark, f"{run}/inbox", f"{run}/out", f"{run}/checkpoint", as_of=lambda: ORDERS_AS_OF
    ).awaitTermination()
    routed = t.spark.read.parquet(f"{run}/out/routed")
    return routed.groupBy("processing_type", "reason", "config.rows").agg(F.count(F.lit(1)).alias("messages"))


@query
def stream_message_items(t: Tables) -> DataFrame:
    """Valid item rows that the message trigger unpacks."""
    run = _run_folder(t)
    t.messages().select("body").write.text(f"{run}/inbox")
    triggers.message_stream(
        t.spark, f"{run}/inbox", f"{run}/out", f"{run}/checkpoint", as_of=lambda: ORDERS_AS_OF
    ).awaitTermination()
    return t.spark.read.parquet(f"{run}/out/items").select("creator_name", "cover_url", "updated_at")


@query
def redelivered_messages(t: Tables) -> DataFrame:
    """An inbox that fills in four waves, the stream restarted for each: per sender what was accepted and what is dead.

    First every message twice; then each third again, within the watermark; then new ones that move the watermark by ten hours; then
    late ones, some without a time, and first ones again that the watermark has passed.
    """
    run = _run_folder(t)
    key = F.col("o_orderkey")
    start = F.lit(ORDERS_AS_OF).cast("timestamp")

    def wave(rows: DataFrame, kind: str, hours: int) -> DataFrame:
        at = start + F.make_dt_interval(hours=F.lit(hours), secs=(key % 600).cast("decimal(18,6)"))
        return rows.select(
            F.concat(F.lit("order-"), key.cast("string")).alias("sender"), F.lit(kind).alias("body"), at.alias("sent_at")
        )

    orders = t.raw("orders").select("o_orderkey")
    first = wave(orders, "first", 0)
    late = wave(orders.where("o_orderkey % 7 = 0"), "late", 1)
    undated = F.when(F.col("sender").endswith("0"), F.lit(None)).otherwise(F.col("sent_at")).cast("timestamp")
    waves = [
        first.unionByName(first),
        first.where(F.pmod(F.substring("sender", 7, 20).cast("long"), F.lit(3)) == 0),
        wave(orders.where("o_orderkey % 5 = 0"), "next", 10),
        late.withColumn("sent_at", undated).unionByName(wave(orders.where("o_orderkey % 11 = 0"), "first", 10)),
    ]
    for number, rows in enumerate(waves):
        rows.write.parquet(f"{run}/inbox/wave={number}")
        redelivery.accept_stream(t.spark, f"{run}/inbox", f"{run}/out", f"{run}/checkpoint").awaitTermination()
    accepted = t.spark.read.parquet(f"{run}/out")
    dead = redelivery.late_letters(redelivery.received(t.spark, f"{run}/inbox"), accepted)
    taken = accepted.groupBy("sender", "body").agg(F.count(F.lit(1)).alias("messages"))
    return taken.withColumn("reason", F.lit(None).cast("string")).unionByName(
        dead.select("sender", "body", F.col("deliveries").alias("messages"), "reason")
    )


@query
def stream_references(t: Tables) -> DataFrame:
    """Messages that name stored files of three headers, a file that is no CSV, a folder and files that are not there.

    Valid item rows, and the rejected messages with their reason and key.
    """
    run = _run_folder(t)
    store = f"{run}/store"
    stored = _stored_layouts(t, t.items(), store)
    t.raw("customer").select("c_name").write.text(f"{store}/names")
    names = t.spark.read.format("binaryFile").load(f"{store}/names").where("length > 0").select("path")
    keys = stored.unionByName(names).select(F.substring_index("path", f"{store}/", -1).alias("s3_key"))
    gone = F.concat(F.lit("gone/"), F.col("c_custkey").cast("string"), F.lit(".csv"))
    keys = keys.unionByName(t.raw("customer").where("c_custkey % 10 = 0").select(gone.alias("s3_key")))
    keys = keys.unionByName(t.raw("region").where("r_regionkey = 0").select(F.lit("0").alias("s3_key")))
    body = batching.reference_message(F.lit("in"), F.col("s3_key"), ORDERS_AS_OF)
    writers.write_messages(keys.select(body.alias("body")), f"{run}/inbox")
    triggers.message_stream(
        t.spark, f"{run}/inbox", f"{run}/out", f"{run}/checkpoint", store, lambda: ORDERS_AS_OF
    ).awaitTermination()
    items = t.spark.read.parquet(f"{run}/out/items").select(F.lit("item").alias("kind"), "creator_name", "cover_url")
    dead = t.spark.read.parquet(f"{run}/out/dead")
    key = F.get_json_object("body", "$.s3_key")
    return items.unionByName(
        dead.select(F.lit("dead").alias("kind"), F.col("reason").alias("creator_name"), key.alias("cover_url"))
    )


@query
def stream_files(t: Tables) -> DataFrame:
    """The file trigger over all items as CSV, run to completion: valid URLs per creator."""
    run = _run_folder(t)
    writers.write_csv(t.items().select(*writers.ITEM_COLUMNS), f"{run}/landing/day")

    def handle(rows: DataFrame, epoch: int) -> None:
        counts = rows.groupBy("creator_name", "output_prefix").agg(F.count(F.lit(1)).alias("urls"))
        counts.write.mode("overwrite").parquet(f"{run}/out/epoch={epoch}")

    triggers.ingest_stream(
        t.spark, f"{run}/landing", f"{run}/checkpoint", handle, lambda: ORDERS_AS_OF
    ).awaitTermination()
    out = t.spark.read.parquet(f"{run}/out")
    return out.groupBy("creator_name").agg(F.sum("urls").alias("urls"))
