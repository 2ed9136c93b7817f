import random

import pytest
from helpers import creator_hash, digest, set_hash
from pyspark.sql import functions as F

from mediabatch.functions.text import canonical_json
from mediabatch.operators import fingerprint

METADATA = {"rows": 5, "cols": 7, "quality": 95, "max_images": None}


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    forms = ["http://a/%d", "é%d", "  q%d ", "\\%d\n", "  "]
    rows = []
    for i in range(500):
        name = rng.choice([" Bob", "bob", "Zoë", 'x"y', "blank", "hot", "hot", "hot"])
        form = "  " if name == "blank" else rng.choice(forms)
        url = form.replace("%d", str(rng.randint(0, 30)))
        rows.append((name, url, "t", i))
    df = spark.createDataFrame(rows, "creator_name string, cover_url string, updated_at string, ord long").cache()
    urls = {}
    for name, url, _, _ in rows:
        urls.setdefault(name, []).append(url)
    return df, urls


@pytest.mark.parametrize("algo", ["sha256", "md5"])
def test_creator_hash(data, algo):
    df, urls = data
    got = {r.creator_name: r.content_hash for r in
           fingerprint.creator_hash(df, METADATA, algo).collect()}
    assert got == {c: creator_hash(c, u, METADATA, algo) for c, u in urls.items()}


def test_creator_hash_capped(data):
    df, urls = data
    got = {r.creator_name: (r.content_hash, r.total_urls) for r in fingerprint.creator_hash(df, cap=12).collect()}
    assert got == {c: (creator_hash(c, u[:12]), min(len(u), 12)) for c, u in urls.items()}


def test_set_hash(data):
    df, urls = data
    got = {r.creator_name: r.set_hash for r in fingerprint.url_set_hash(df).collect()}
    assert got == {c: set_hash(u) for c, u in urls.items()}


def test_batch_hash(data):
    df, urls = data
    rows = df.withColumn("batch_id", (F.length("creator_name") % 2).cast("int"))
    got = {r.batch_id: r.batch_hash for r in fingerprint.batch_hash(rows).collect()}
    for batch, value in got.items():
        mine = {c: u for c, u in urls.items() if len(c) % 2 == batch}
        assert value == digest(
            {
                "creator_count": len(mine),
                "total_urls": sum(map(len, mine.values())),
                "creator_hashes": {c: creator_hash(c, u) for c, u in mine.items()},
            }
        )


def test_daily_fingerprint(data):
    from datetime import datetime

    df, urls = data
    got = {r.creator_name: r.fingerprint for r in
           fingerprint.daily_fingerprint(df, {"rows": 5}, datetime(2024, 1, 2, 9)).collect()}
    for name, value in got.items():
        clean = sorted(u.strip() for u in urls[name] if u.strip())
        assert value == digest({"creator_name": name.strip().lower(), "image_urls": clean,
                                "processing_config": {"rows": 5}, "timestamp": "2024-01-02"})


def test_duplicates_count_in_the_list_hash_only(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "a", 2), ("y", "a", 1)],
                               "creator_name string, cover_url string, ord long")
    x, y = df.where("creator_name = 'x'"), df.where("creator_name = 'y'").withColumn("creator_name", F.lit("x"))
    a, b = (fingerprint.creator_hash(d).first().content_hash for d in (x, y))
    assert a != b
    a, b = (fingerprint.url_set_hash(d).first().set_hash for d in (x, y))
    assert a == b
    row = fingerprint.content_diff(x, y, with_hashes=True).first()
    assert row.content_changed and row.change_summary == "No changes" and row.old_hash != row.new_hash


def test_content_diff(data):
    df, _ = data
    old, new = df.where("ord % 7 <> 0"), df.where("ord % 5 <> 0 and creator_name <> 'hot'")
    sides = [{}, {}]
    for side, frame in zip(sides, (old, new)):
        for r in frame.collect():
            side.setdefault(r.creator_name, []).append(r.cover_url)
    for r in fingerprint.content_diff(old, new, with_hashes=True).collect():
        o, n = (side.get(r.creator_name, []) for side in sides)
        so, sn = ({u.strip() for u in x if u.strip()} for x in (o, n))
        assert (r.old_count, r.new_count) == (len(so), len(sn))
        assert (r.added_count, r.removed_count, r.common_count) == (len(sn - so), len(so - sn), len(so & sn))
        assert (r.old_hash, r.new_hash) == (creator_hash(r.creator_name, o), creator_hash(r.creator_name, n))
        assert r.content_changed == (r.old_hash != r.new_hash)


def test_counts_and_lists(data):
    df, urls = data
    total = fingerprint.creator_counts(df, with_total=True).where("is_total = 1").first().image_count
    assert total == sum(map(len, urls.values()))
    got = {r.creator_name: r.urls for r in fingerprint.creator_urls(df, 7).collect()}
    assert got == {c: u[:7] for c, u in urls.items()}
    with pytest.raises(ValueError):
        fingerprint.creator_urls(df, 0)
    order = [r.creator_name for r in fingerprint.creators_by_size(df).collect()]
    assert order == [c for c, _ in sorted(urls.items(), key=lambda x: -len(x[1]))]


def test_metadata_text():
    assert canonical_json({"b": None, "a": 1}) == '{"a":1,"b":null}'


def test_uncapped_hash_reads_its_input_once(spark, tmp_path):
    rows = [("hot" if i % 3 == 0 else f"c{i}", f"u{i}", "t", i) for i in range(3_000)]
    path = str(tmp_path / "items")
    spark.createDataFrame(rows, "creator_name string, cover_url string, updated_at string, ord long").write.parquet(path)
    out = fingerprint.creator_hash(spark.read.parquet(path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    got = {r.creator_name: r.content_hash for r in out.collect()}
    assert len(got) == 2001 and got["hot"] == creator_hash("hot", [f"u{i}" for i in range(0, 3_000, 3)], None)
