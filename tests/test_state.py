from datetime import datetime, timedelta

import pytest

from mediabatch import schemas
from mediabatch.config import ProcessingConfig
from mediabatch.operators import decisions, fingerprint, objects, state
from mediabatch.sources import readers, writers

AS_OF = datetime(2024, 1, 31, 12)
TODAY = AS_OF.date()


def record(creator, day=TODAY, status="completed", created=AS_OF, version=0, **more):
    base = {
        "creator_name": creator, "processing_date": day, "status": status, "batch_id": "b", "content_hash": "h",
        "image_count": 3, "processing_config": "{}", "created_at": created, "updated_at": created,
        "ttl": state.epoch_seconds(created + timedelta(days=30)), "lambda_request_id": "r",
        "processing_duration_ms": 10, "collage_s3_key": "k", "error_message": None, "version": version,
    }
    return {**base, **more}


def table(spark, *records):
    return spark.createDataFrame(list(records), schemas.STATE)


def test_current_view(spark):
    log = table(spark, record("a", version=1, status="failed"), record("a", version=2),
                record("a", version=0, status="processing"),
                record("b", TODAY - timedelta(days=40), created=AS_OF - timedelta(days=40)))
    assert {(r.creator_name, r.status) for r in state.current_state(log).collect()} == {
        ("a", "completed"), ("b", "completed")}
    assert [r.creator_name for r in state.current_state(log, AS_OF).collect()] == ["a"]


def test_history(spark):
    log = table(spark, *[record("a", TODAY - timedelta(days=i)) for i in range(5)])
    got = state.history(log, 3, "a").orderBy("position").collect()
    assert [r.processing_date for r in got] == [TODAY - timedelta(days=i) for i in range(3)]
    assert state.latest_state(log).first().processing_date == TODAY


@pytest.mark.parametrize(
    "old, given, processed, reason, changed, stale",
    [
        (None, "h", False, "No processing records found", False, False),
        ({}, "h", True, "Same content already processed successfully", False, False),
        ({}, "other", False, "Content has changed since last processing", True, False),
        ({"status": "processing"}, "other", False, "Content has changed since last processing", True, False),
        ({}, "", True, "Already processed successfully today", False, False),
        ({"content_hash": ""}, "x", True, "Already processed successfully today", False, False),
        ({"day": TODAY - timedelta(days=1)}, "", False, "Previous processing failed or incomplete", False, False),
        ({"status": "processing", "created": AS_OF - timedelta(minutes=30)}, "h", True, "Currently being processed",
         False, False),
        ({"status": "processing", "created": AS_OF - timedelta(minutes=31)}, "h", False,
         "Previous processing appears stale", False, True),
        ({"status": "processing", "created_at": None}, "h", False, "Error checking status: no start time", False,
         False),
        ({"status": "failed"}, "h", False, "Previous processing failed or incomplete", False, False),
    ],
)
def test_processed_ladder(spark, old, given, processed, reason, changed, stale):
    known = table(spark, *([] if old is None else [record("a", **old)]))
    probe = spark.createDataFrame([("a", given)], "creator_name string, content_hash string")
    row = decisions.processed_decision(probe, known, AS_OF).first()
    assert (row.processed, row.reason, row.content_changed, row.stale) == (processed, reason, changed, stale)


@pytest.mark.parametrize(
    "stored, options, skip, reason",
    [
        ([("exact", 102_400)], {}, True, "Identical collage already exists"),
        ([("exact", 102_399)], {}, False, "Existing collage too small (102399 bytes)"),
        ([("out/collages/a_collage_zzz.jpg", 5)], {}, False, "Creator has different content, will create new collage"),
        ([("out/collages/ab_collage_zzz.jpg", 5)], {}, False, "No existing collages found"),
        ([("exact", 102_400)], {"force": True}, False, "Force reprocess enabled"),
        ([("exact", 102_400)], {"deduplicate": False}, False, "Deduplication disabled"),
    ],
)
def test_skip_ladder(spark, stored, options, skip, reason):
    key = "out/collages/a_collage_123.jpg"
    listing = spark.createDataFrame([(key if k == "exact" else k, n) for k, n in stored],
                                    "s3_key string, size_bytes long")
    expected = spark.createDataFrame([("A.", key)], "creator_name string, s3_key string")
    row = decisions.skip_decision(expected, listing, "out", **options).first()
    assert (row.should_skip, row.skip_reason) == (skip, reason)


def test_plan_combines_both(spark):
    items = spark.createDataFrame([(c, f"u{i}", i) for i, c in enumerate("aabc")],
                                  "creator_name string, cover_url string, ord long")
    config = ProcessingConfig(max_images_per_creator=2)
    named = fingerprint.output_keys(fingerprint.creator_hash(items, config.hash_metadata(), cap=2), "p")
    by = {r.creator_name: r for r in named.collect()}
    known = table(spark, record("a", content_hash=by["a"].content_hash, collage_s3_key="old"))
    listing = spark.createDataFrame([(by["b"].s3_key, 200_000)], "s3_key string, size_bytes long")

    def plan(**options):
        out = decisions.plan_work(items, known, listing, config, AS_OF, "p", **options)
        return {r.creator_name: (r.action, r.s3_key) for r in out.collect()}

    assert plan() == {"a": ("skip", "old"), "b": ("skip", by["b"].s3_key), "c": ("process", by["c"].s3_key)}
    assert {a for a, _ in plan(force=True).values()} == {"process"}
    assert {a for a, _ in plan(deduplicate=False).values()} == {"process"}


def test_conditional_create(spark):
    current = table(spark, record("busy", status="processing"), record("done", version=4),
                    record("yesterday", TODAY - timedelta(days=1), status="processing"))
    requests = spark.createDataFrame(
        [("busy", "b1"), ("done", "b1"), ("yesterday", "b1"), ("new", "b2"), ("new", "b1")],
        "creator_name string, batch_id string",
    ).selectExpr("*", "'h' AS content_hash", "3 AS image_count")
    got = {(r.creator_name, r.batch_id): r for r in state.create_records(current, requests, AS_OF).collect()}
    assert {k for k, r in got.items() if r.accepted} == {("done", "b1"), ("yesterday", "b1"), ("new", "b1")}
    assert got["done", "b1"].version == 5 and got["new", "b1"].version == 0
    assert got["new", "b1"].ttl == state.epoch_seconds(AS_OF) + 30 * 86400


def test_conditional_update(spark):
    current = table(spark, record("a"), record("b", error_message="old"))
    updates = spark.createDataFrame(
        [("a", TODAY, "failed", "", None, "boom"), ("b", TODAY, "completed", "new", 7, ""), ("x", TODAY, "failed", "",
          None, None)],
        "creator_name string, processing_date date, status string, collage_s3_key string,"
        " processing_duration_ms long, error_message string",
    )
    got = {r.creator_name: r for r in state.update_records(current, updates, AS_OF).collect()}
    a, b = got["a"], got["b"]
    assert (a.status, a.collage_s3_key, a.processing_duration_ms, a.error_message) == ("failed", "k", 10, "boom")
    assert (b.status, b.collage_s3_key, b.processing_duration_ms, b.error_message) == ("completed", "new", 7, "old")
    assert a.version == 1 and set(got) == {"a", "b"}
    assert [r.creator_name for r in state.unmatched_updates(current, updates).collect()] == ["x"]


def test_stale_records_fail(spark):
    current = table(spark, record("a", status="processing", created=AS_OF - timedelta(minutes=31)),
                    record("b", status="processing", created=AS_OF - timedelta(minutes=30)),
                    record("c", created=AS_OF - timedelta(minutes=99)))
    got = state.expire_stale(current, AS_OF).collect()
    assert [(r.creator_name, r.status, r.error_message) for r in got] == [
        ("a", "failed", "Processing timed out after 30 minutes")]


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    writers.append_state(table(spark, record("a", status="processing")), path)
    current = state.current_state(readers.read_state(spark, path), AS_OF)
    done = current.select("creator_name", "processing_date").selectExpr("*", "'completed' AS status")
    writers.append_state(state.update_records(current, done, AS_OF + timedelta(minutes=1)), path)
    rows = state.current_state(readers.read_state(spark, path), AS_OF).collect()
    assert [(r.creator_name, r.status, r.version) for r in rows] == [("a", "completed", 1)]
    compacted = state.compact(readers.read_state(spark, path), AS_OF)
    assert compacted.count() == 1


def test_batch_status(spark):
    current = table(spark, record("a"), record("b", status="failed"), record("c", status=None))
    ids = spark.createDataFrame([("b",), ("none",)], "batch_id string")
    got = {r.batch_id: r for r in state.batch_status(current, ids).collect()}
    assert got["b"].status_counts == {"completed": 1, "failed": 1, "unknown": 1}
    assert got["b"].completion_percentage == pytest.approx(100 / 3)
    assert (got["none"].total_creators, got["none"].status_counts, got["none"].completion_percentage) == (0, {}, 0.0)


def test_statistics_cover_both_ends(spark):
    current = table(spark, *[record(f"c{i}", TODAY - timedelta(days=i), image_count=i) for i in range(10)])
    got = {r.processing_date: r for r in state.daily_stats(current, AS_OF, 7).collect()}
    assert len(got) == 9 and got[None].creators == 8 and got[None].images == 28
    assert got[None].avg_images == 3.5


@pytest.mark.parametrize("value, expected", [(0.125, 0.12), (2.675, 2.67), (1.005, 1.0), (None, None)])
def test_report_rounding(spark, value, expected):
    from mediabatch.functions.numbers import round2

    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round2("x")).first()[0] == expected


# -- objects -----------------------------------------------------------------------------------


def listing(spark, rows):
    return spark.createDataFrame(rows, schemas.OBJECTS)


@pytest.mark.parametrize("size, ok", [(51_199, False), (51_200, True), (52_428_800, True), (52_428_801, False)])
def test_integrity_bounds(spark, size, ok):
    row = objects.object_integrity(listing(spark, [("k", size, AS_OF, "image/jpg")]), AS_OF).first()
    assert row.valid == ok and len(row.checks) == 2


def test_integrity_age_only_warns(spark):
    rows = [("k", 60_000, AS_OF - timedelta(days=31), "image/jpeg"), ("t", 60_000, AS_OF, "text/csv")]
    got = {r.s3_key: r for r in objects.object_integrity(listing(spark, rows), AS_OF).collect()}
    assert got["k"].valid and got["k"].checks[2].message == "Collage is 31 days old" and got["k"].checks[2].warning
    assert not got["t"].valid and got["t"].checks[1].message == "Invalid content type: text/csv"


def test_creator_names_with_the_separator(spark, rows_of):
    keys = ["collages/a_collage_b_collage_1.jpg", "collages/a_collage_2.jpg", "collages/a_collage_collage_3.jpg",
            "collages/ax_collage_4.jpg", "other/collages/a_collage_5.jpg"]
    df = listing(spark, [(k, 1, AS_OF, "image/jpeg") for k in keys])
    creators = spark.createDataFrame([("A",), ("a_collage_b",), ("a_collage",)], "creator_name string")
    got = rows_of(objects.existing_for_creator(creators, df), "creator_name", "s3_key")
    expected = [(c, k) for c in ("A", "a_collage_b", "a_collage") for k in keys
                if k.startswith(f"collages/{c.lower()}_collage_")]
    assert got == sorted(expected, key=repr)


def test_creators_without_letters_share_their_collages(spark, rows_of):
    keys = ["collages/_collage_1.jpg", "collages/_collage_2.jpg", "collages/a_collage_3.jpg"]
    df = listing(spark, [(k, 1, AS_OF - timedelta(days=i), "image/jpeg") for i, k in enumerate(keys)])
    creators = spark.createDataFrame([("!!!",), ("\U0001f389",), ("?",), ("a",)], "creator_name string")
    found = objects.existing_for_creator(creators, df)
    assert rows_of(found, "creator_name", "s3_key") == [("!!!", keys[0]), ("!!!", keys[1]), ("a", keys[2])]
    plan = {r.s3_key: r.action for r in objects.retention_plan(found, 1).collect()}
    assert plan == {keys[0]: "keep", keys[1]: "delete", keys[2]: "keep"}
    listed = {r.creator_name: (r.safe, r.listed_as) for r in objects.members(creators).collect()}
    assert listed == {"!!!": ("", "!!!"), "\U0001f389": ("", "!!!"), "?": ("", "!!!"), "a": ("a", "a")}


def test_retention(spark):
    rows = [(f"collages/a_collage_{i}.jpg", 1, AS_OF - timedelta(days=i), "image/jpeg") for i in range(4)]
    creators = spark.createDataFrame([("a",)], "creator_name string")
    plan = objects.retention_plan(objects.existing_for_creator(creators, listing(spark, rows)), 2)
    got = {r.s3_key: r.action for r in plan.collect()}
    assert got == {rows[i][0]: "keep" if i < 2 else "delete" for i in range(4)}


def test_object_stats_of_nothing(spark):
    row = objects.object_stats(listing(spark, [])).first()
    assert tuple(row) == (0, 0, 0.0, 0.0, 0, 0, 0, 0.0)


def test_object_stats(spark):
    mb = 1024 * 1024
    rows = [("collages/a_collage_1.jpg", mb - 1), ("collages/a_collage_2.jpg", mb), ("collages/b_collage_1.jpg", 10 * mb),
            ("collages/odd.jpg", 1), ("elsewhere", 5)]
    row = objects.object_stats(listing(spark, [(k, n, AS_OF, "image/jpeg") for k, n in rows])).first()
    assert (row.total_collages, row.unique_creators, row.small, row.medium, row.large) == (4, 2, 2, 1, 1)
    assert (row.total_size_mb, row.average_size_mb, row.collages_per_creator) == (12.0, 3.0, 2.0)


def test_lifecycle(spark):
    cases = [("input", "csv-files/a", 29, "STANDARD", False), ("input", "csv-files/a", 30, "STANDARD_IA", False),
             ("input", "csv-files/a", 400, "DEEP_ARCHIVE", False), ("input", "archived/failed/a", 90, "STANDARD", True),
             ("output", "collages/a", 365, "GLACIER", False), ("output", "csv-files/a", 400, "STANDARD", False),
             ("temp", "large-files/a", 3, "STANDARD", True), ("temp", "debug/a", 29, "STANDARD", False)]
    df = spark.createDataFrame([(s, k, AS_OF - timedelta(days=d), i) for i, (s, k, d, *_) in enumerate(cases)],
                               "store string, s3_key string, last_modified timestamp, i int")
    got = objects.lifecycle_tiers(df, AS_OF).orderBy("i").collect()
    assert [(r.tier, r.expired) for r in got] == [(t, e) for *_, t, e in cases]


def test_listing(spark, tmp_path):
    for name, size in (("collages/a.jpg", 3), ("collages/b/c.png", 5), ("x.csv", 1)):
        path = tmp_path / "store" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    root = str(tmp_path / "store")
    got = {r.s3_key: (r.size_bytes, r.content_type) for r in readers.list_objects(spark, root, "collages/").collect()}
    assert got == {"collages/a.jpg": (3, "image/jpeg"), "collages/b/c.png": (5, "image/png")}
    plan = readers.list_objects(spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert "content#" not in plan.split("Relation")[0]


def test_repeated_request_is_accepted_once(spark):
    current = spark.createDataFrame([], schemas.STATE)
    rows = [("a", "b1", "h", 1), ("a", "b1", "h", 1), ("a", "b1", None, 1), ("a", "b0", None, 2), ("a", "b0", None, 2)]
    requests = spark.createDataFrame(rows, "creator_name string, batch_id string, content_hash string, image_count long")
    out = state.create_records(current, requests, datetime(2024, 1, 2)).collect()
    assert len(out) == 5 and [r.batch_id for r in out if r.accepted] == ["b0"]


def test_log_reads_prune_days(spark, tmp_path):
    path = str(tmp_path / "log")
    days = spark.range(60).selectExpr(
        "CONCAT('c', id) creator_name", "DATE'2024-01-01' + CAST(id AS INT) processing_date", "'x' status", "id version"
    )
    days.write.partitionBy("processing_date").parquet(path)
    log = spark.read.schema(schemas.STATE).parquet(path)
    for rows, n in ((state.recent(log, datetime(2024, 2, 20)), 41), (state.of_day(log, datetime(2024, 2, 20)), 1)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(processing_date" in plan
        assert rows.count() == n


def test_updates_without_an_order_end_where_a_record_ends(spark):
    current = table(spark, *[record(c, status="processing") for c in "abc"])
    rows = [("a", "completed"), ("a", "processing"), ("b", "processing"), ("b", "failed"), ("c", "odd"), ("c", "processing")]
    updates = spark.createDataFrame([(c, TODAY, s) for c, s in rows], "creator_name string, processing_date date, status string")
    got = {r.creator_name: r.status for r in state.update_records(current, updates, AS_OF).collect()}
    assert got == {"a": "completed", "b": "failed", "c": "processing"}
