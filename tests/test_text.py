import json

from helpers import name_number, safe
from pyspark.sql import functions as F

from mediabatch.functions import hashing, keys, text

NAMES = [
    "Bob", " Bob ", "\u3000Zoë\x1c", "aal.i.jah", "aalijah", "Ana Maria-Lu_x", "a/b", "日本 語!", "x\"y\\z",
    "\U0001f600 smile", "\x7f\x1f\n\t", "", "   ", "Ⅷ½", "_collage_",
]


def frame(spark):
    return spark.createDataFrame([(n,) for n in NAMES], "n string")


def test_strip_matches_python(spark):
    got = frame(spark).select("n", text.strip(F.col("n"))).collect()
    assert all(r[1] == r[0].strip() for r in got)


def test_whitespace_is_complete():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_json_quote_matches_python(spark):
    got = frame(spark).select("n", text.json_quote(F.col("n"))).collect()
    assert all(r[1] == json.dumps(r[0]) for r in got)


def test_safe_names(spark):
    got = frame(spark).select("n", text.safe_name(F.col("n")), text.legacy_safe_name(F.col("n"))).collect()
    assert all(r[1] == safe(r[0]).lower() and r[2] == safe(r[0]) for r in got)
    by_name = {r[0]: r[1] for r in got}
    assert by_name["aal.i.jah"] == by_name["aalijah"]


def test_name_bucket(spark):
    for algo in ("sha256", "md5", "sha1"):
        got = frame(spark).select("n", hashing.name_bucket(F.col("n"), algo)).collect()
        assert all(r[1] == name_number(r[0], algo) for r in got)


def test_unknown_algorithm():
    import pytest

    with pytest.raises(ValueError):
        hashing.check_algorithm("crc32")


def test_valid_hash(spark):
    cases = [("a" * 64, True), ("A" * 64, True), ("g" * 64, False), ("a" * 63, False), ("", False), (None, False),
             ("+" + "1" * 63, False)]
    df = spark.createDataFrame(cases, "h string, ok boolean")
    assert all(r[0] == r[1] for r in df.select("ok", hashing.valid_hash(F.col("h"))).collect())


def test_collage_keys(spark):
    df = spark.createDataFrame([("Bob X", "0123456789abcdef")], "n string, h string")
    row = df.select(
        hashing.collage_key(F.col("n"), F.col("h"), "p/"),
        hashing.collage_key(F.col("n"), F.col("h")),
        hashing.legacy_collage_key(F.col("n"), "p/", F.lit("2024-01-02 03:04:05").cast("timestamp")),
    ).first()
    assert list(row) == [
        "p/collages/bob_x_collage_0123456789ab.jpg",
        "collages/bob_x_collage_0123456789ab.jpg",
        "p/collages/Bob_X_collage_20240102_030405.jpg",
    ]


def test_prefix_candidates(spark):
    cases = ["a_collage_b_collage_h.jpg", "a_collage_collage_x", "plain.jpg", "_collage_x", "a_collage_"]
    df = spark.createDataFrame([(c,) for c in cases], "k string")
    for key, got in df.select("k", keys.prefix_candidates(F.col("k"))).collect():
        starts = [key[:i] for i in range(len(key)) if key.startswith("_collage_", i)]
        assert sorted(got) == sorted(starts)


def test_key_parts(spark):
    df = spark.createDataFrame([("p/x_collage_1.JPG",), ("p/none.bin",)], "k string")
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp")
    names = spark.createDataFrame([(0,), (122,)], "b int").select(keys.batch_file(F.col("b"), stamp)).collect()
    assert [r[0] for r in names] == [f"20240102_030405/parallel_batch_{n}.csv" for n in ("01", "123")]
    got = df.select(keys.creator_of_key(F.col("k")), keys.content_type(F.col("k")),
                    keys.trigger_prefix(F.lit("in/a.csv.csv"))).collect()
    assert [tuple(r) for r in got] == [
        ("x", "image/jpeg", "s3-trigger/in/a/"),
        (None, "application/octet-stream", "s3-trigger/in/a/"),
    ]
