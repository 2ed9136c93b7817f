import csv
import random

import pandas as pd
import pytest

from mediabatch.session import one_layout
from mediabatch.sources import csv_records, readers

CELLS = ["a", "b c", "", " ", 'say "x"', "x,y", "two\nlines", '"\n"', "\n\n,", "é😀", "ERROR: x"]


def write(path, header, rows, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield use
    for n, value in zip(names, old, strict=True):
        spark.conf.set(n, value)


def plain(df):
    return [tuple(r) for r in df.orderBy("ord.file", "ord.block", "ord.row").select("creator_name", "cover_url", "updated_at").collect()]


@pytest.mark.parametrize("size", [29, 333, 1 << 20])
def test_records_equal_the_parser(spark, tmp_path, small_splits, size):
    own = random.Random(size)
    expected = []
    for i, header in enumerate([["creator_name", "cover_url", "updated_at"], ["x", "cover_url", "creator_name"], ["cover_url"]]):
        rows = [[own.choice(CELLS) for _ in header] for _ in range(30)]
        # A row that is the header again, and blank lines, which are no rows.
        rows = [r for r in rows if any(c.strip() for c in r)] + [header]
        write(tmp_path / f"{i} [x].csv", header, rows)
        cells = [dict(zip(header, r, strict=True)) for r in rows]
        expected += [(c.get("creator_name", "unknown"), c.get("cover_url", ""), c.get("updated_at", "")) for c in cells]
    small_splits(size)
    paths = sorted(str(p) for p in tmp_path.iterdir())
    with one_layout(spark):
        assert plain(csv_records.read_records(spark, paths)) == expected


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_batches_may_end_anywhere(size):
    lines = [("a", 0, 'x,"1'), ("a", 0, '2"'), ("a", 0, "y"), ("a", 0, 'z,"3'), ("a", 5, "4"), ("a", 5, "5"), ("a", 9, '6",'),
             ("a", 9, "v"), ("a", 9, '"7'), ("a", 9, '8"'), ("b", 0, "w"), ("b", 0, '"9'), ("b", 0, '0",')]
    frame = pd.DataFrame(lines, columns=["file", "block", "value"])
    frame["row"] = range(len(frame))
    frame["inside"] = (frame["file"] == "a") & (frame["block"] > 0)
    batches = [frame.iloc[i : i + size].reset_index(drop=True) for i in range(0, len(frame), size)]
    out = pd.concat(csv_records._joined(batches))
    R, H, M, T = csv_records.RECORD, csv_records.HEAD, csv_records.MIDDLE, csv_records.TAIL
    assert list(zip(out["file"], out["block"], out["kind"], out["text"], strict=True)) == [
        ("a", 0, R, 'x,"1\n2"'), ("a", 0, R, "y"), ("a", 0, T, 'z,"3'), ("a", 5, M, "4\n5"), ("a", 9, H, '6",'), ("a", 9, R, "v"),
        ("a", 9, R, '"7\n8"'), ("b", 0, R, "w"), ("b", 0, R, '"9\n0",')]


def test_a_cell_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(300))
    rows = [["a", "u1", "t"], ["b", long, "t"], ["c", "u3", "t"], ["d", '"\n' * 50, "t"], ["e", "u5", "t"]]
    write(tmp_path / "a.csv", ["creator_name", "cover_url", "updated_at"], rows)
    small_splits(100)
    assert plain(csv_records.read_records(spark, [str(tmp_path / "a.csv")])) == [tuple(r) for r in rows]


def test_odd_files(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("\ufeffcover_url,creator_name\r\nu1,a\r\n\r\nu2\r\n,b,c,d\r\n".encode())
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("creator_name,cover_url")
    (tmp_path / "open.csv").write_text('creator_name,cover_url\na,u\nb,"never closed\nc,u\n')
    (tmp_path / "quoted.csv").write_text('"creator_name","cover,url","cover_url"\n"q","","u,9"\n"short"\n')
    got = plain(csv_records.read_records(spark, sorted(str(p) for p in tmp_path.iterdir())))
    assert got == [("a", "u1", ""), (None, "u2", ""), ("b", "", ""), ("a", "u", ""), ("b", "never closed\nc,u", ""),
                   ("q", "u,9", ""), ("short", None, "")]
    assert csv_records.read_records(spark, []).count() == 0


def test_many_quoted_rows_equal_the_multiline_reader(spark, tmp_path, small_splits):
    df = spark.range(100_000).selectExpr(
        "concat('c', id % 97, ', \"x\"\n', id) AS creator_name", "concat('u', id) AS cover_url", "'t' AS updated_at"
    )
    path = str(tmp_path / "big")
    df.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    part = [str(p) for p in (tmp_path / "big").glob("part-*.csv")]
    small_splits(100_000)
    with one_layout(spark):
        got = csv_records.read_records(spark, part)
        assert got.select("ord.block").distinct().count() > 20
        assert got.drop("ord").exceptAll(readers.read_items(spark, path).drop("ord")).count() == 0
        assert got.count() == 100_000


def test_other_splits_than_counted_fail(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", ["creator_name", "cover_url"], [[f"c{i}", "u\nv"] for i in range(500)])
    small_splits(500)
    rows = csv_records.read_records(spark, [str(tmp_path / "a.csv")]).select("cover_url")
    again = csv_records._scan(spark, [str(tmp_path / "a.csv")])
    assert rows.count() == again.count() == 500


def test_references(spark, tmp_path):
    root = tmp_path / "store"
    write(root / "a" / "x y.csv", ["cover_url", "creator_name"], [["u1", "a"]])
    write(root / "a" / "+b%20.csv", ["creator_name", "cover_url"], [["b", "u2"], ["c", "u\n3"]])
    write(root / "a" / "not asked.csv", ["creator_name", "cover_url"], [["z", "u9"]])
    (root / "a" / "empty.csv").write_text("")
    keys = [("a/x y.csv", 1), ("a/x y.csv", 2), ("a/+b%20.csv", 3), ("a", 4), ("gone/x.csv", 5), ("a/empty.csv", 6), ("a/no.csv", 7)]
    refs = spark.createDataFrame(keys, "s3_key string, message_id int")
    rows, missing = csv_records.read_referenced(spark, refs, str(root))
    got = sorted((r.message_id, r.creator_name, r.cover_url) for r in rows.collect())
    assert got == [(1, "a", "u1"), (2, "a", "u1"), (3, "b", "u2"), (3, "c", "u\n3")]
    assert sorted(r.s3_key for r in missing.collect()) == ["a", "a/empty.csv", "a/no.csv", "gone/x.csv"]
    none = spark.createDataFrame([], "s3_key string, message_id int")
    rows, missing = csv_records.read_referenced(spark, none, str(root))
    assert rows.count() == missing.count() == 0
