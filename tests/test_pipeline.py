import json
import os
import sys
from datetime import datetime

import numpy as np
import pytest
from pyspark import cloudpickle

from mediabatch import schemas
from mediabatch.config import ProcessingConfig
from mediabatch.functions.pixels import png_bytes
from mediabatch.operators import ingest, messages, report, state
from mediabatch.plans import extract, run
from mediabatch.sources import readers, writers
from mediabatch.streaming import triggers

# The fetcher below runs in Python tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

AS_OF = datetime(2024, 1, 31, 12)
NO_OBJECTS = schemas.OBJECTS


def items(spark, rows):
    return spark.createDataFrame(
        [(c, u, "t", i) for i, (c, u) in enumerate(rows)],
        "creator_name string, cover_url string, updated_at string, ord long",
    )


# -- messages ----------------------------------------------------------------------------------


def parse(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return messages.parse_messages(spark.createDataFrame([(t,) for t in texts], "body string"), AS_OF)


def data_message(**more):
    return {"processing_type": "csv_data", "csv_data": "creator_name,cover_url,updated_at\na,u,t", **more}


@pytest.mark.parametrize(
    "body, reason",
    [
        (data_message(), None),
        ({"processing_type": "csv_s3", "s3_key": "k.csv"}, None),
        ({"processing_type": "csv_s3"}, "missing payload"),
        ({"processing_type": "csv_data"}, "missing payload"),
        ({"processing_type": "zip"}, "unsupported type"),
        ({}, "unsupported type"),
        ("{bad", "malformed"),
        (data_message(processing_config={"speed": 1}), "unknown configuration key"),
        (data_message(processing_config={"rows": 0}), "invalid configuration"),
    ],
)
def test_routing(spark, body, reason):
    assert parse(spark, body).first().reason == reason


def test_config_merge(spark):
    row = parse(spark, data_message(processing_config={"rows": 3, "max_images_per_creator": None})).first()
    assert row.config.asDict() == {**ProcessingConfig().as_dict(), "rows": 3, "max_images_per_creator": None}
    assert parse(spark, data_message()).first().config.max_images_per_creator == 35


def test_config_errors(spark):
    row = parse(spark, data_message(processing_config={"rows": 0, "quality": 101, "max_workers": 21,
                                                       "timeout": 301})).first()
    assert row.config_errors == [
        "rows must be positive", "quality must be between 1 and 100", "max_workers should not exceed 20",
        "timeout should not exceed 300 seconds"]
    low = parse(spark, data_message(processing_config={"cols": -1, "quality": 0, "max_workers": 0, "timeout": 0}))
    assert len(low.first().config_errors) == 4
    assert ProcessingConfig(max_images_per_creator=0).cap is None


def test_message_defaults(spark):
    a = parse(spark, data_message()).first()
    b = parse(spark, {"processing_type": "csv_s3", "s3_key": "in/x.csv", "output_prefix": ""}).first()
    assert (a.batch_id, a.output_prefix) == ("sqs_data_20240131_120000", "sqs-data/")
    assert (b.batch_id, b.output_prefix) == ("s3_ref_in/x_20240131_120000", "")


def test_embedded_csv(spark, rows_of):
    texts = ["cover_url,creator_name\nu1,a\r\n\nu2\n", 'creator_name,cover_url,updated_at\n"x\ny","u,3",t\n,u4,\n',
             "cover_url\nu5\n", "creator_name,cover_url,updated_at"]
    df = parse(spark, *[data_message(csv_data=t) for t in texts])
    got = rows_of(messages.message_items(df, ()), "creator_name", "cover_url", "updated_at", "line")
    assert got == sorted(
        [("a", "u1", "", 1), (None, "u2", "", 2), ("x\ny", "u,3", "t", 1), ("", "u4", "", 2),
         ("unknown", "u5", "", 1)], key=repr)


def test_second_chance(spark):
    body = {"processing_type": "csv_data", "processing_config": {"rows": 9, "timeout": 1}, "n": [1, {"a": None}]}
    dead = messages.rejected(parse(spark, body, "{bad"))
    got = messages.reprocess(messages.retryable(dead), AS_OF).collect()
    assert [json.loads(r.new_body) for r in got] == [
        {**body, "processing_config": {"rows": 9, "timeout": 60, "max_retries": 5, "max_workers": 4},
         "timestamp": "2024-01-31T12:00:00", "source": "dlq_reprocess", "attempt": 1}]


def test_deliveries_are_counted(spark):
    dead = messages.rejected(parse(spark, *[{"processing_type": "zip", "attempt": n} for n in range(4)]))
    assert sorted(r.attempt for r in messages.retryable(dead).collect()) == [1, 2]


def test_dead_letter_patterns(spark, rows_of):
    df = spark.createDataFrame([("{bad",), ("{}",), ('{"processing_type":"zip"}',), ("{bad",)], "body string")
    assert rows_of(report.dead_letter_patterns(df)) == [("parse_error", 2), ("unknown", 1), ("zip", 1)]


# -- extract and batch -------------------------------------------------------------------------


def test_extract_to_batches(spark):
    links = spark.createDataFrame(
        [("a", '["1","2"]', datetime(2024, 1, 30)), ("b", '["3"]', datetime(2024, 1, 30)),
         ("c", '["4"]', datetime(2023, 1, 1)), ("d", None, datetime(2024, 1, 30))],
        "creator_name string, cover_urls string, updated_at timestamp",
    )
    seen = items(spark, [("b", "x")])
    rows = extract.extract_items(links, [seen], "last_7_days", None, AS_OF).selectExpr("*", "cover_url AS ord")
    assert {(r.creator_name, r.cover_url) for r in rows.collect()} == {("a", "1"), ("a", "2"), ("d", "")}
    for deduplicate in (True, False):
        got = extract.batch_items(rows, 10, deduplicate).collect()
        assert {(r.creator_name, r.batch_id) for r in got} == {("a", 0)}


# -- whole runs --------------------------------------------------------------------------------


def picture(url, timeout):
    """A one-colour image per URL; some are unreachable, some undecodable."""
    name = url.rsplit("/", 1)[1]
    if name.startswith("down"):
        raise OSError("down")
    if name.startswith("junk"):
        return "image/png", b"junk"
    return "image/png", png_bytes(np.full((60, 60, 3), int(name), np.uint8))


def test_run_decides_builds_and_records(spark, tmp_path):
    rows = items(spark, [("a", "h/10"), ("a", "h/20"), ("a", "ERROR: x"), ("a", "h/30"), ("b", "h/down"),
                         ("c", "h/junk"), ("c", "h/40")])
    config = ProcessingConfig(rows=1, cols=2, max_images_per_creator=2, max_retries=1)
    path = str(tmp_path / "state")
    none = spark.createDataFrame([], NO_OBJECTS)

    def go(name, objects=none, **options):
        return run.run_batch(rows, path, objects, AS_OF, str(tmp_path / name), config, "p/", "b1", fetcher=picture,
                             **options)

    first = {r.creator_name: r for r in go("one", with_png=True).collect()}
    assert {c: r.outcome for c, r in first.items()} == {"a": "created", "b": "failed", "c": "created"}
    assert (first["a"].image_count, first["a"].placed, first["c"].image_count, first["c"].placed) == (2, 2, 2, 1)
    current = {r.creator_name: r for r in state.current_state(readers.read_state(spark, path), AS_OF).collect()}
    assert {c: r.status for c, r in current.items()} == {"a": "completed", "b": "failed", "c": "completed"}
    assert current["a"].collage_s3_key == first["a"].s3_key and current["b"].error_message == "Collage creation failed"

    collages = spark.read.parquet(str(tmp_path / "one" / "collages"))
    a = collages.where("creator_name = 'a'").first()
    canvas = np.frombuffer(bytes(a.image.data), np.uint8).reshape(200, 400, 3)
    assert (canvas[:, :200] == 10).all() and (canvas[:, 200:] == 20).all()
    writers.write_collage_files(collages, str(tmp_path / "out"))
    assert os.path.getsize(tmp_path / "out" / first["a"].s3_key) > 0
    listed = readers.list_objects(spark, str(tmp_path / "out"))
    assert {r.s3_key for r in listed.collect()} == {first["a"].s3_key, first["c"].s3_key}

    second = {r.creator_name: r for r in go("two").collect()}
    assert {c: r.outcome for c, r in second.items()} == {"a": "skipped", "b": "failed", "c": "skipped"}
    assert second["a"].s3_key == first["a"].s3_key
    forced = {r.creator_name: r.outcome for r in go("three", force=True).collect()}
    assert forced == {"a": "created", "b": "failed", "c": "created"}

    summary = run.summarise(spark.read.parquet(str(tmp_path / "two" / "results")), rows).first()
    assert (summary.total_creators, summary.created, summary.skipped, summary.failed) == (3, 0, 2, 1)
    assert (summary.collages_listed, summary.total_urls) == (2, 6)
    written = writers.write_summary(spark.createDataFrame([summary]), str(tmp_path / "out"), AS_OF, "s3-trigger")
    assert written.endswith("results/processing-summaries/2024/01/31/s3-trigger")
    assert spark.read.json(written).first().failed == 1


def test_run_without_deduplication(spark, tmp_path):
    rows = items(spark, [("A b", "h/10")])
    out = run.run_batch(rows, str(tmp_path / "state"), spark.createDataFrame([], NO_OBJECTS), AS_OF,
                        str(tmp_path / "w"), ProcessingConfig(), "p/", deduplicate=False, fetcher=picture)
    assert out.first().s3_key == "p/collages/A_b_collage_20240131_120000.jpg"
    assert not os.path.exists(tmp_path / "state")


def test_combined_run(spark, tmp_path):
    rows = items(spark, [("b", "h/1"), ("a", "h/2"), ("b", "h/3")])
    out = run.run_combined(rows, AS_OF, str(tmp_path / "w"), ProcessingConfig(rows=1, cols=3), "p/", picture).collect()
    assert [(r.creator_name, r.image_count, r.placed) for r in out] == [("combined", 3, 3)]
    collage = spark.read.parquet(str(tmp_path / "w" / "collages")).first().image
    canvas = np.frombuffer(bytes(collage.data), np.uint8).reshape(200, 600, 3)
    assert [int(canvas[5, x, 0]) for x in (5, 205, 405)] == [1, 3, 2]
    failed = run.run_combined(items(spark, [("b", "h/down")]), AS_OF, str(tmp_path / "v"),
                              ProcessingConfig(max_retries=1), "p/", picture)
    assert failed.count() == 0


def test_timing_summary(spark):
    df = spark.createDataFrame(
        [("a", "created", 10, 5, 1), ("b", "created", 20, None, 1), ("c", "failed", 99, 99, 99)],
        "creator_name string, outcome string, download_ms long, placement_ms long, save_ms long",
    )
    row = report.timing_summary(df).first()
    assert (row.collages, row.total_download_ms, row.total_placement_ms, row.total_ms, row.avg_ms) == (2, 30, 5, 37, 18.5)


# -- streams -----------------------------------------------------------------------------------


def test_file_trigger(spark, tmp_path):
    landing = tmp_path / "landing" / "2024"
    landing.mkdir(parents=True)
    (landing / "a.csv").write_text("creator_name,cover_url,updated_at\na,u1,t\na,ERROR: x,t\n")
    (landing / "b.CSV").write_text("cover_url,creator_name\nu2,b\n")
    (landing / "c.txt").write_text("creator_name,cover_url,updated_at\nz,u9,t\n")
    (landing / "empty.csv").write_text("")
    seen = []

    def handle(rows, epoch):
        seen.extend((r.creator_name, r.cover_url, r.output_prefix, r.batch_id) for r in rows.collect())

    def start():
        triggers.ingest_stream(
            spark, str(tmp_path / "landing"), str(tmp_path / "cp"), handle, lambda: AS_OF
        ).awaitTermination()

    start()
    assert sorted(seen) == [
        ("a", "u1", "s3-trigger/2024/a/", "s3_2024/a_20240131_120000"),
        ("b", "u2", "s3-trigger/2024/b.CSV/", "s3_2024/b.CSV_20240131_120000"),
    ]
    (landing / "d.csv").write_text("creator_name,cover_url,updated_at\nd,u3,t\n")
    start()
    assert len(seen) == 3 and seen[-1][0] == "d"


def test_message_trigger(spark, tmp_path, rows_of):
    root = tmp_path / "store"
    root.mkdir()
    (root / "x.csv").write_text("cover_url,creator_name\nu7,x\nERROR: y,x\n")
    (root / "folder").mkdir()
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    bodies = [data_message(), {"processing_type": "csv_s3", "s3_key": "x.csv"},
              {"processing_type": "csv_s3", "s3_key": "gone.csv"}, {"processing_type": "zip"},
              {"processing_type": "csv_s3", "s3_key": "folder"},
              data_message(csv_data='creator_name,cover_url\n"q",u8\n', processing_config={"rows": 2})]
    (inbox / "1.txt").write_text("".join(json.dumps(b) + "\n" for b in bodies) + "{bad\n")
    out = str(tmp_path / "out")
    triggers.message_stream(
        spark, str(inbox), out, str(tmp_path / "cp"), str(root), lambda: AS_OF
    ).awaitTermination()
    got = spark.read.parquet(f"{out}/items")
    assert rows_of(got, "creator_name", "cover_url", "config.rows") == [("a", "u", 5), ("q", "u8", 2), ("x", "u7", 5)]
    dead = rows_of(spark.read.parquet(f"{out}/dead"), "reason", "attempt")
    assert dead == [("malformed", 1), ("missing file", 1), ("missing file", 1), ("unsupported type", 1)]
    assert rows_of(spark.read.parquet(f"{out}/routed"), "reason").count((None,)) == 3
    # The stream gives what the batch operators give.
    batch = messages.message_items(messages.accepted(parse(spark, *bodies), "csv_data"), ())
    assert ingest.valid_items(batch).count() == 2


def test_message_sink_feeds_the_stream(spark, tmp_path):
    from mediabatch.operators import batching

    rows = items(spark, [("a", "u1"), ("a", "u2"), ("b", "u3")]).selectExpr("*", "0 AS batch_id")
    writers.write_messages(batching.batch_messages(rows, AS_OF), str(tmp_path / "inbox"))
    triggers.message_stream(
        spark, str(tmp_path / "inbox"), str(tmp_path / "out"), str(tmp_path / "cp"), as_of=lambda: AS_OF
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "items"))
    assert sorted(r.cover_url for r in got.collect()) == ["u1", "u2", "u3"]


def test_a_replayed_epoch_changes_nothing(spark, tmp_path, rows_of):
    """A query that lost its checkpoint delivers everything again, under the same epochs."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "1.txt").write_text(json.dumps(data_message()) + "\n{bad\n")
    out = str(tmp_path / "out")
    seen = []
    for n in range(2):
        triggers.message_stream(
            spark, str(inbox), out, str(tmp_path / f"cp{n}"), as_of=lambda: AS_OF,
            handle=lambda rows, epoch: seen.append(rows.count()),
        ).awaitTermination()
    assert seen == [1, 1]
    assert spark.read.parquet(f"{out}/items").count() == spark.read.parquet(f"{out}/dead").count() == 1


def test_messages_run_to_collages_once(spark, tmp_path):
    """The message trigger drives a whole run; a creator delivered again is skipped."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    path = str(tmp_path / "state")
    none = spark.createDataFrame([], NO_OBJECTS)
    outcomes = []

    def handle(rows, epoch):
        done = run.run_messages(rows, path, none, AS_OF, str(tmp_path / f"run{epoch}"), fetcher=picture)
        outcomes.append({(r.creator_name, r.output_prefix): r.outcome for r in done.collect()})
        for r in done.where("outcome = 'created'").collect():
            assert r.s3_key.startswith(f"{r.output_prefix}collages/")
            assert r.placed == {"p/": 1, "q/": 2}[r.output_prefix]

    for n in range(2):
        text = "creator_name,cover_url,updated_at\n{0},h/9,t\n{0},h/8,t"
        first = data_message(csv_data=text.format("a"), processing_config={"rows": 1, "cols": 1}, output_prefix="p/")
        second = data_message(csv_data=text.format("b"), processing_config={"rows": 1, "cols": 2}, output_prefix="q/")
        (inbox / f"{n}.txt").write_text(json.dumps(first) + "\n" + json.dumps(second) + "\n")
        triggers.message_stream(
            spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "cp"), as_of=lambda: AS_OF, handle=handle
        ).awaitTermination()
    assert outcomes == [{("a", "p/"): "created", ("b", "q/"): "created"}, {("a", "p/"): "skipped", ("b", "q/"): "skipped"}]


def test_dead_letters_return_until_their_deliveries_are_used(spark, tmp_path):
    inbox, out = str(tmp_path / "inbox"), str(tmp_path / "out")
    os.mkdir(inbox)
    with open(f"{inbox}/0.txt", "w") as f:
        f.write(json.dumps({"processing_type": "zip"}) + "\n{bad\n")
    counts = []
    for epoch in range(4):
        triggers.message_stream(
            spark, inbox, out, str(tmp_path / "cp"), as_of=lambda: AS_OF, max_files=100
        ).awaitTermination()
        dead = spark.read.parquet(f"{out}/dead").where(f"epoch = {epoch}")
        counts.append(sorted((r.reason, r.attempt) for r in dead.collect()))
        triggers.retry_dead_letters(spark, out, inbox, AS_OF, epoch)
    assert counts == [[("malformed", 1), ("unsupported type", 1)], [("unsupported type", 2)], [("unsupported type", 3)], []]


def test_status_stream(spark, tmp_path):
    from datetime import timedelta

    path = str(tmp_path / "state")
    requests = spark.createDataFrame([(c, "b") for c in ("a", "b", "c")], "creator_name string, batch_id string")
    requests = requests.selectExpr("*", "'h' AS content_hash", "1 AS image_count")
    empty = spark.createDataFrame([], schemas.STATE)
    writers.append_state(state.create_records(empty, requests, AS_OF).drop("accepted"), path)
    done = spark.createDataFrame([("a", AS_OF.date(), "completed", "k"), ("x", AS_OF.date(), "failed", "")],
                                 "creator_name string, processing_date date, status string, collage_s3_key string")
    done.write.parquet(str(tmp_path / "updates"))
    updates = spark.readStream.schema(done.schema).parquet(str(tmp_path / "updates"))
    for n in range(2):  # the second query has lost its checkpoint: everything is replayed
        triggers.status_stream(
            spark, updates, path, str(tmp_path / f"cp{n}"), lambda: AS_OF + timedelta(minutes=31 if n else 1)
        ).awaitTermination()
        rows = state.current_state(readers.read_state(spark, path), AS_OF).collect()
        got = {r.creator_name: (r.status, r.collage_s3_key) for r in rows}
        rest = "failed" if n else "processing"
        assert got == {"a": ("completed", "k"), "b": (rest, ""), "c": (rest, "")}
