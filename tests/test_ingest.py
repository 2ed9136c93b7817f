import csv
import json
from datetime import date, datetime
from pathlib import Path

import pytest

from mediabatch.operators import ingest
from mediabatch.sources import csv_records, readers, writers


def items(spark, rows):
    return spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)], "creator_name string, cover_url string, updated_at string, ord long"
    )


def test_validity(spark, rows_of):
    df = items(spark, [(" Bob ", "u", ""), ("", " v ", ""), ("a", "  ", ""), ("a", "ERROR: x", ""),
                       ("a", " ERROR: x", ""), ("a", None, ""), (None, "u", "")])
    assert rows_of(ingest.valid_items(df), "creator_name", "cover_url") == [("", "v"), ("Bob", "u")]
    bad = rows_of(ingest.invalid_items(df), "reason")
    assert bad == [("blank url",), ("error url",), ("error url",), ("missing cell",), ("missing cell",)]


def test_missing_creator_column(spark):
    df = spark.createDataFrame([("u",)], "cover_url string")
    assert ingest.valid_items(df).first().creator_name == "unknown"


def test_batching_counts_error_rows(spark):
    df = items(spark, [(" a", "ERROR: x", ""), (" a", " ", ""), (" a", "u", "")])
    assert [r.creator_name for r in ingest.batchable_items(df).collect()] == [" a", " a"]


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, (None, None)),
        ("last_7_days", ("2024-01-24", "2024-01-31")),
        ("last_45_days", ("2023-12-17", "2024-01-31")),
        (("2024-01-01", "2024-01-02"), ("2024-01-01", "2024-01-02")),
        ("last_x_days", (None, None)),
        ("yesterday", (None, None)),
    ],
)
def test_date_filter(value, expected):
    assert ingest.parse_date_filter(value, date(2024, 1, 31)) == expected


def test_date_only_upper_bound_is_midnight(spark):
    df = spark.createDataFrame(
        [("a", "[]", datetime(2024, 1, 2)), ("a", "[]", datetime(2024, 1, 2, 9)), ("a", "[]", datetime(2024, 1, 1))],
        "creator_name string, cover_urls string, updated_at timestamp",
    )
    got = ingest.filter_links(df, ("2024-01-01", "2024-01-02")).collect()
    assert [r.updated_at for r in got] == [datetime(2024, 1, 2), datetime(2024, 1, 1)]
    assert ingest.filter_links(df, ("2024-01-01", None)).count() == 3


def python_urls(raw):
    if not raw:
        return [""]
    try:
        value = json.loads(raw)
    except ValueError as e:
        return [f"ERROR: {e}"]
    return [str(u) for u in value if u] if isinstance(value, list) else [str(value)]


def test_link_texts_decode_like_python(spark):
    texts = [None, "", "[]", '["a","",null]', '"u"', "null", "{bad", "true", "1.50", '{"a": [1]}', '["a"] x',
             '["a"]["b"]', '[1,"a",0,"0",false,[2]]', '["x", "y"]', '["\\u00e9\\/"]', '["é"]', " ", "NaN",
             '["a\\", \\"b"]', '["a" , "b"]']
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "creator_name string, cover_urls string")
    df = df.selectExpr("*", "timestamp'2024-01-02 03:04:05' AS updated_at")
    got = {}
    for r in ingest.explode_links(df).collect():
        assert r.updated_at == "2024-01-02 03:04:05"
        got.setdefault(int(r.creator_name), []).append(r.cover_url)
    for i, t in enumerate(texts):
        assert got.get(i, []) == python_urls(t), t


def test_remove_seen_keeps_own_duplicates(spark, rows_of):
    df = items(spark, [("a", "1", ""), ("b", "2", ""), ("b", "2", ""), ("B", "3", "")])
    seen = items(spark, [("a", "9", "")])
    assert rows_of(ingest.remove_seen(df, seen, seen), "creator_name") == [("B",), ("b",), ("b",)]
    assert ingest.remove_seen(df).count() == 4


def test_missing_earlier_files_are_passed_over(spark, tmp_path, rows_of):
    from mediabatch.plans.extract import remove_seen_files

    (tmp_path / "a.csv").write_text("creator_name,cover_url,updated_at\na,u,t\n")
    (tmp_path / "b.csv").write_text("cover_url,creator_name\nu,b\n")
    df = items(spark, [("a", "1", ""), ("b", "2", ""), ("c", "3", "")])
    paths = [str(tmp_path / name) for name in ("a.csv", "gone.csv", "b.csv")]
    assert rows_of(remove_seen_files(df, paths), "creator_name") == [("c",)]
    assert remove_seen_files(df, paths[1:2]).count() == 3


@pytest.mark.parametrize("cap, kept", [(2, 2), (0, 3), (None, 3)])
def test_cap(spark, cap, kept):
    df = items(spark, [("a", "1", ""), ("a", "2", ""), ("a", "3", "")])
    got = [r.cover_url for r in ingest.cap_per_creator(df, cap).orderBy("ord").collect()]
    assert got == ["1", "2", "3"][:kept]


def test_cap_limits_before_the_shuffle(spark):
    df = items(spark, [("a", "1", "")])
    plan = ingest.cap_per_creator(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_csv_scan_by_header_name(spark, tmp_path, rows_of):
    path = tmp_path / "in" / "a.CSV"
    path.parent.mkdir()
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["extra", "cover_url", "creator_name", "updated_at"])
        out.writerow(["x", "http://a,b", "Zoë \"q\"", "2024"])
        out.writerow(["x", "", "b", ""])
        out.writerow(["x", "u", "", "t"])
        out.writerow(["x", "u"])
        out.writerow(["x", "u", "short"])
    (tmp_path / "in" / "note.txt").write_text("ignored")
    df = readers.read_items(spark, str(tmp_path / "in"))
    got = [tuple(r)[:3] for r in df.orderBy("ord").collect()]
    assert got == [
        ("Zoë \"q\"", "http://a,b", "2024"),
        ("b", "", ""),
        ("", "u", "t"),
        (None, "u", None),
        ("short", "u", None),
    ]
    assert rows_of(ingest.invalid_items(df), "reason") == [("blank url",), ("missing cell",)]


def test_csv_scan_without_creator(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cover_url\nu\n")
    row = readers.read_items(spark, str(tmp_path)).first()
    assert (row.creator_name, row.cover_url, row.updated_at) == ("unknown", "u", "")


def test_file_order_over_splits(spark, tmp_path):
    for name in ("a", "b"):
        lines = "".join(f"c,{name}{i:05d},t\n" for i in range(3000))
        (tmp_path / f"{name}.csv").write_text("creator_name,cover_url,updated_at\n" + lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = readers.read_items(spark, str(tmp_path), multiline=False)
        assert df.rdd.getNumPartitions() > 4
        got = [r.cover_url for r in df.orderBy("ord").select("cover_url").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(got) and len(got) == 6000


def test_item_sink(spark, tmp_path, rows_of):
    df = items(spark, [("a,b", " u\"v ", ""), ("", "x", "t")])
    path = writers.write_items(df, str(tmp_path), datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("cover_urls_20240102_030405")
    back = readers.read_items(spark, path)
    assert rows_of(back.drop("ord")) == rows_of(df.drop("ord"))
    assert writers.write_items(df.limit(0), str(tmp_path), datetime(2024, 1, 2)) == ""


def test_landing_layout(spark, tmp_path):
    df = items(spark, [("a", "u", "")]).drop("ord")
    writers.write_landing(df, str(tmp_path / "in"), "s3-trigger", datetime(2024, 1, 2))
    assert (tmp_path / "in" / "dt=2024-01-02" / "trigger=s3-trigger").is_dir()


def test_link_filters_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("a", "[]", datetime(2024, 1, 2), "x")],
                               "creator_name string, cover_urls string, updated_at timestamp, other string")
    df.write.parquet(str(tmp_path / "links"))
    links = spark.read.parquet(str(tmp_path / "links"))
    for date_filter, names, pushed in (
        (("2024-01-01", "2024-01-03"), None, "GreaterThanOrEqual(updated_at"),
        (None, ["a", "b"], "In(creator_name"),
    ):
        out = ingest.filter_links(links, date_filter, names).select("creator_name", "updated_at")
        scan = out._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
        assert pushed in scan
        read = scan.split("ReadSchema")[1]
        assert "cover_urls" not in read and "other" not in read


def test_cells_with_line_breaks_and_foreign_files(spark, tmp_path):
    rows = [("a\nb", "https://x/1.jpg", "t"), ('q"u,o', "https://x/2.jpg", ""), ("plain", "https://x/3.jpg", "t")]
    df = spark.createDataFrame(rows, "creator_name string, cover_url string, updated_at string")
    path = writers.write_items(df, str(tmp_path / "in"), datetime(2024, 1, 2))
    (tmp_path / "in" / "note.txt").write_text("creator_name,cover_url\nnot,read\n")
    back, lost = csv_records.read_item_files(spark, [str(p) for p in Path(path).glob("*.csv")])
    assert not lost
    for got in (back, readers.read_items(spark, str(tmp_path / "in"))):
        assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(rows)
