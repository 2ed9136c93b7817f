import json
import random
from datetime import datetime

import pytest
from helpers import greedy, name_number, next_fit
from pyspark.sql import functions as F

from mediabatch.operators import batching, ingest
from mediabatch.sources import readers, writers

AS_OF = datetime(2024, 1, 2, 3, 4, 5)


def sizes_of(spark, sizes):
    return spark.createDataFrame(
        [(n, c, i) for i, (n, c) in enumerate(sizes)], "creator_name string, image_count long, first_ord long"
    )


def chosen(df):
    return {r.creator_name: r.batch_id for r in df.collect()}


def random_sizes(seed, n, counts):
    rng = random.Random(seed)
    return [(f"c{i}", rng.choice(counts)) for i in range(n)]


def test_worked_example(spark):
    sizes = [("ann", 25), ("bob", 9), ("cy", 8), ("dee", 8), ("eve", 6), ("fay", 4), ("gil", 3), ("hal", 1)]
    got = chosen(batching.balanced_batches(sizes_of(spark, sizes), 10, 1))
    groups = {}
    for name, batch in got.items():
        groups.setdefault(batch, set()).add(name)
    assert groups == {0: {"ann"}, 1: {"bob", "gil"}, 2: {"cy", "dee"}, 3: {"eve", "fay", "hal"}}


@pytest.mark.parametrize("seed", range(4))
def test_balanced_equals_the_sequential_packing(spark, seed):
    target = [10, 33, 100, 7][seed]
    sizes = random_sizes(seed, 400, [1, 1, 2, 3, 5, 9, 12, 40, target, 2 * target, 2 * target + 1])
    assert chosen(batching.balanced_batches(sizes_of(spark, sizes), target, 1)) == greedy(sizes, target)


@pytest.mark.parametrize("shards", [1, 3])
def test_balanced_properties(spark, shards):
    sizes = random_sizes(9, 500, [1, 2, 3, 30, 80, 250])
    got = chosen(batching.balanced_batches(sizes_of(spark, sizes), 50, shards=shards))
    assert got.keys() == dict(sizes).keys()
    totals, members = {}, {}
    for name, n in sizes:
        totals[got[name]] = totals.get(got[name], 0) + n
        members[got[name]] = members.get(got[name], 0) + 1
    assert sum(totals.values()) == sum(n for _, n in sizes)
    assert all(totals[b] <= 100 for b, m in members.items() if m > 1)


def test_balanced_keeps_earlier_batches(spark):
    sizes = [("a", 5), ("b", 4), ("c", 3), ("d", 2)]
    before = spark.createDataFrame([("c", 0), ("d", 0)], "creator_name string, batch_id long")
    got = chosen(batching.balanced_batches(sizes_of(spark, sizes), 10, 1, previous=before))
    assert got["c"] == got["a"] == got["d"] == 0


@pytest.mark.parametrize("seed", range(4))
def test_next_fit_equals_the_sequential_packing(spark, seed):
    target = [10, 33, 100, 7][seed]
    sizes = random_sizes(seed + 50, 600, [1, 1, 1, 2, 3, 5, 9, 12, 40])
    assert chosen(batching.next_fit_batches(sizes_of(spark, sizes), target)) == next_fit(sizes, target)


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(5000, numPartitions=7).select(F.hash("id").alias("v"), "id")
    got = batching.global_rank(df, [F.desc("v"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(5000))
    assert [(-r.v, r.id) for r in got] == sorted((-r.v, r.id) for r in got)


def test_struct_positions_pack_too(spark, tmp_path):
    for name in ("b", "a"):
        lines = "".join(f"{name}{i},u,t\n" * (i % 3 + 1) for i in range(30))
        (tmp_path / f"{name}.csv").write_text("creator_name,cover_url,updated_at\n" + lines)
    items = readers.read_items(spark, str(tmp_path))
    sizes = [(f"{name}{i}", i % 3 + 1) for name in ("a", "b") for i in range(30)]
    assert chosen(batching.balanced_batches(batching.creator_sizes(items), 6, 1)) == greedy(sizes, 6)
    assert chosen(batching.next_fit_batches(batching.creator_sizes(items), 6)) == next_fit(sizes, 6)


def test_hash_batches(spark):
    got = chosen(batching.hash_batches(sizes_of(spark, [(" Ann ", 1), ("ann", 2), ("bob", 3)]), 7))
    assert got == {n: name_number(n) % 7 for n in got} and got[" Ann "] == got["ann"]


def test_statistics(spark):
    df = spark.createDataFrame([("a", 10, 0), ("b", 20, 0), ("c", 90, 1), ("a", 10, 1)],
                               "creator_name string, image_count long, batch_id int")
    row = batching.batch_balance(df, 100).first()
    assert (row.batches, row.min_size, row.max_size, row.avg_size) == (2, 30, 100, 65.0)
    assert row.balance_score == 70 / 65 and row.high_variance and row.estimated_seconds == 100 / 13
    assert [r.creator_name for r in batching.duplicate_creators(df).collect()] == ["a"]
    assert {r.creator_name for r in batching.creators_of_batch(df, 0).collect()} == {"a", "b"}
    assert batching.batch_of_creator(df, "c").first().batch_id == 1


def test_assignment_issues(spark, rows_of):
    by_creator = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "creator_name string, batch_id int")
    by_batch = spark.createDataFrame([("a", 0), ("b", 9), ("c", 2), ("c", 2), ("e", 5)],
                                     "creator_name string, batch_id int")
    got = rows_of(batching.assignment_issues(by_creator, by_batch), "creator_name", "issue")
    assert got == [("b", "batches differ"), ("c", "listed more than once"), ("d", "assigned but not listed"),
                   ("e", "listed without assignment")]


@pytest.mark.parametrize("n, size", [(1, 50), (1000, 50), (1001, 100), (10000, 100), (100000, 200), (100001, 300)])
def test_suggested_size(spark, n, size):
    assert spark.range(1).select(batching.suggest_batch_size(F.lit(n))).first()[0] == size


def batch_rows(spark):
    rows = [("a,b", 'u"1', "t", 0, 0), ("a,b", "u2", "", 1, 0), ("c", "u3", "t", 2, 1), ("c", "u4", "t", 3, 1),
            ("c", "u5", "t", 4, 1)]
    return spark.createDataFrame(
        rows, "creator_name string, cover_url string, updated_at string, ord long, batch_id int"
    )


@pytest.mark.parametrize("shards", [1, 4])
def test_earlier_batches_survive(spark, shards):
    sizes = random_sizes(5, 200, [1, 2, 3, 30, 80, 250])
    first = batching.balanced_batches(sizes_of(spark, sizes[:120]), 50, shards)
    got = chosen(first)
    again = chosen(batching.balanced_batches(sizes_of(spark, sizes), 50, shards, previous=first))
    assert again.keys() == dict(sizes).keys() and got.items() <= again.items()
    assert chosen(batching.balanced_batches(sizes_of(spark, sizes[:120]), 50, shards, previous=first)) == got


def test_messages_carry_their_rows(spark):
    got = {(r.batch_id, r.part): json.loads(r.body) for r in
           batching.batch_messages(batch_rows(spark), AS_OF, 2).collect()}
    assert got.keys() == {(0, 0), (1, 0), (1, 1)}
    assert {m["processing_type"] for m in got.values()} == {"csv_data"}
    assert got[0, 0]["csv_data"] == 'creator_name,cover_url,updated_at\n"a,b","u""1",t\n"a,b",u2,'
    assert got[0, 0]["output_prefix"] == "parallel_sqs_20240102_030405/"
    assert got[0, 0]["processing_config"] == {"rows": 5, "cols": 7, "quality": 95, "max_workers": 8, "timeout": 30,
                                              "max_retries": 3}
    assert got[1, 1]["csv_data"] == "creator_name,cover_url,updated_at\nc,u5,t"


def test_message_defaults(spark):
    row = spark.range(1).select(
        batching.reference_message(F.lit("b"), F.lit('k"é'), AS_OF).alias("r"),
        batching.data_message(F.lit("x\ny"), AS_OF, {"rows": 1}, "p/").alias("d"),
    ).first()
    ref, data = json.loads(row.r), json.loads(row.d)
    assert ref["s3_key"] == 'k"é' and ref["processing_config"]["max_images_per_creator"] == 35
    assert ref["source"] == "local_upload" and ref["timestamp"] == "2024-01-02 03:04:05"
    assert data == {"processing_type": "csv_data", "csv_data": "x\ny", "processing_config": {"rows": 1},
                    "output_prefix": "p/", "timestamp": "2024-01-02 03:04:05", "source": "direct_data"}


def test_batch_files(spark, tmp_path):
    path = writers.write_batches(batch_rows(spark), str(tmp_path), AS_OF)
    assert path.endswith("20240102_030405")
    back = readers.read_items(spark, f"{path}/parallel_batch=01").orderBy("ord").collect()
    assert [tuple(r)[:3] for r in back] == [("a,b", 'u"1', "t"), ("a,b", "u2", "")]
    assert readers.read_items(spark, f"{path}/parallel_batch=02").count() == 3


def test_assignment_table(spark, tmp_path):
    df = sizes_of(spark, [("a", 1), ("b", 2)])
    path = str(tmp_path / "assignment")
    batching.save_assignment(batching.hash_batches(df, 5), path)
    kept = batching.keep_previous(batching.hash_batches(df, 3), readers.read_assignment(spark, path))
    assert chosen(kept) == {n: name_number(n) % 5 for n in ("a", "b")}
    attached = batching.attach_batches(ingest.batchable_items(batch_rows(spark).drop("batch_id")), kept)
    assert attached.count() == 0
