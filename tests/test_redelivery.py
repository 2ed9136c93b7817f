from datetime import datetime, timedelta

from mediabatch.operators import objects
from mediabatch.streaming import redelivery

START = datetime(2026, 1, 1)


def send(spark, inbox, number, rows):
    made = [(sender, body, None if minutes is None else START + timedelta(minutes=minutes)) for sender, body, minutes in rows]
    spark.createDataFrame(made, redelivery.INBOX).write.parquet(f"{inbox}/wave={number}")


def run(spark, tmp_path):
    out = str(tmp_path / "out")
    redelivery.accept_stream(spark, str(tmp_path / "inbox"), out, str(tmp_path / "checkpoint")).awaitTermination()
    return spark.read.parquet(out)


def test_each_message_once_and_none_lost(spark, tmp_path, rows_of):
    inbox = str(tmp_path / "inbox")
    send(spark, inbox, 0, [("a", "x", 0), ("a", "x", 0), ("b", "x", 1), (None, "x", 1), ("a", None, 2), ("a", "undated", None)])
    run(spark, tmp_path)
    send(spark, inbox, 1, [("a", "x", 30), ("a", "y", 600)])
    run(spark, tmp_path)
    send(spark, inbox, 2, [("a", "late", 5), ("a", "late", 6), ("b", "x", 5), ("b", "x", 601)])
    accepted = run(spark, tmp_path)
    got = rows_of(accepted, "sender", "body")
    assert got == sorted([("a", "x"), ("b", "x"), (None, "x"), ("a", None), ("a", "y"), ("b", "x")], key=repr)
    dead = redelivery.late_letters(redelivery.received(spark, inbox), accepted)
    assert rows_of(dead, "body", "deliveries", "reason") == [("late", 2, "late"), ("undated", 1, "no time of sending")]
    none = redelivery.late_letters(redelivery.received(spark, inbox), accepted, START)
    assert rows_of(none, "body") == [("undated",)]
    assert rows_of(run(spark, tmp_path), "sender", "body") == got  # another start has nothing to do


def test_identity_tells_nulls_and_borders_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None), ("", "abc"), (None, None)]
    df = spark.createDataFrame(rows, "sender string, body string")
    ids = df.select(redelivery.identity(df["sender"], df["body"]).alias("i"))
    assert ids.distinct().count() == len(rows)


def test_the_longest_prefix_decides(spark, rows_of):
    rules = [
        ("s", "", 10, "COLD"), ("s", "a/", 20, "COOL"), ("s", "a/", 40, "ICE"), ("s", "a/b", 30, "DEEP"), ("t", "a/", 0, "T"),
        ("s", None, 0, "NONE"), (None, "a/", 0, "NONE"), ("s", "a/b", None, "NONE"),
    ]
    as_of = datetime(2026, 3, 1)
    rows = [("s", "a/x", 25), ("s", "a/x2", 50), ("s", "a/bc", 25), ("s", "a/b", 35), ("s", "z", 15), ("s", "y", 5), ("u", "a/x", 99), ("t", "", 9)]
    objects_df = spark.createDataFrame([(a, b, as_of - timedelta(days=n)) for a, b, n in rows], "store string, s3_key string, last_modified timestamp")
    table = spark.createDataFrame(rules, "store string, prefix string, age_days int, tier string")
    got = {(r.store, r.s3_key): (r.rule, r.tier) for r in objects.lifecycle_by_rules(objects_df, table, as_of).collect()}
    assert got == {
        ("s", "a/x"): ("a/", "COOL"), ("s", "a/x2"): ("a/", "ICE"), ("s", "a/bc"): ("a/b", "STANDARD"), ("s", "a/b"): ("a/b", "DEEP"),
        ("s", "z"): ("", "COLD"), ("s", "y"): ("", "STANDARD"), ("u", "a/x"): (None, "STANDARD"), ("t", ""): (None, "STANDARD"),
    }
    assert objects.lifecycle_by_rules(objects_df, table.limit(0), as_of).where("tier = 'STANDARD'").count() == len(rows)
    plan = objects.lifecycle_by_rules(objects_df, table, as_of)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    twice = objects_df.unionByName(objects_df)
    assert objects.lifecycle_by_rules(twice, table, as_of).count() == 2 * len(rows)
