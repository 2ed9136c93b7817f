"""CSV files of differing headers as one scan that may be split anywhere, also where quoted cells hold line breaks.

A line begins a record if the quotes before it in its file are even in number. A first scan counts: per split its number
of quotes, per file its first line, which is the header. Running sums over a file's splits tell for each split
whether it begins inside a quoted cell. A second scan cuts the cells. In splits where every line has its quotes in
pairs, each line is a record; only the lines of the others go through Python, which joins lines to records. What is left open
at a split's ends is one piece of text on either side: these few meet by file and are joined.

Quotes have to stand around whole cells and to be doubled inside them (RFC 4180); a header is one line. The files may
have as many splits as Spark likes, but both scans the same ones: read inside `one_layout` where executors come and go. A
scan whose splits are not those that were counted fails.

`ord` (file, block, row) restores the order of a file's rows. Only the list of files passes through the driver, as for any scan.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediabatch.session import staged, within_broadcast

# Files planned in one scan; more of them are several scans in one plan.
FILES_PER_SCAN = 100_000
# No text has this cell: it is put behind a record to see how many cells the record has.
LAST_CELL = "\u0001"
ABSENT = {"creator_name": "unknown", "cover_url": "", "updated_at": ""}

ROWS = "creator_name STRING, cover_url STRING, updated_at STRING, ord STRUCT<file: STRING, block: LONG, row: LONG>"
GLOB = re.compile(r"([\[\]{}*?\\])")

RECORD, HEAD, MIDDLE, TAIL = range(4)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files' lines: value, file, block (their split's first byte), row (ascending in a split)."""
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def _quotes(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit('"')))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _names(headers: pd.Series) -> pd.Series:
    return headers.map(lambda h: next(csv.reader([h.lstrip("\ufeff").rstrip("\r")]), []))


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: file, block, inside (whether it begins in a quoted cell), odd (whether some line has an odd number of
    quotes), first and last (numbers of its lines), header (of the file, in its first split)."""
    found = lines.groupBy("file", "block").agg(
        F.sum(_quotes(F.col("value"))).alias("quotes"),
        F.max(_quotes(F.col("value")) % 2).alias("odd"),
        F.min("row").alias("first"),
        F.max("row").alias("last"),
        F.min_by(F.when(F.col("block") == 0, F.col("value")), "row").alias("header"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return found.withColumn("inside", inside).withColumn("odd", F.col("odd") == 1)


def _joined(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of splits, in order, joined to records: file, block, row (of the first line), kind, text.

    What a split begins or ends inside of is a head, middle or tail of a record.
    """
    held, known = None, None
    for batch in filter(len, batches):
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        held = None
        for key, split in rows.groupby(["file", "block"], sort=False):
            if key == known and split.index[0] == 0 and len(rows) == len(batch):
                # Goes on from the batch before, which ended with a record.
                split = split.assign(inside=False)
            # The last split of a batch may go on in the next one: its open lines wait.
            last = split.index[-1] == rows.index[-1]
            done, rest = _records(split, final=not last)
            if last:
                held, known = rest if len(rest) else None, key
            if len(done):
                yield done
    if held is not None:
        yield _records(held, final=True)[0]


def _records(split: pd.DataFrame, final: bool) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The finished records of a split's lines, and the lines left, whose `inside` tells how they begin."""
    inside = bool(split["inside"].iloc[0])
    odd = split["value"].str.count('"').to_numpy() % 2
    parity = (np.cumsum(odd) + inside) % 2
    ends = np.flatnonzero(parity == 0)
    starts = np.concatenate([[0], ends + 1])
    values, rows = split["value"].tolist(), split["row"].to_numpy()
    n = len(ends)
    texts = ["\n".join(values[a : b + 1]) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)]
    kinds = [RECORD] * n
    if inside and n:
        kinds[0] = HEAD
    left = split.iloc[int(starts[n]) :]
    if final and len(left):
        texts.append("\n".join(left["value"]))
        kinds.append(MIDDLE if inside and not n else TAIL)
        n += 1
    elif len(left):
        # As before, but for what the finished records have closed.
        left = left.assign(inside=inside and not n)
    out = pd.DataFrame(
        {
            "file": split["file"].iloc[0],
            "block": split["block"].iloc[0],
            "row": rows[starts[:n]],
            "kind": np.array(kinds, np.int32),
            "text": texts,
        }
    )
    return out, left


def _across(pieces: DataFrame) -> DataFrame:
    """Records that lie across splits, from their pieces: a tail, any number of middles, a head."""
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == TAIL)
    numbered = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"])
    return numbered.groupBy("file", "record").agg(
        F.min("block").alias("block"), F.min_by("row", "block").alias("row"), F.array_join(texts, "\n").alias("text")
    )


def _cells(text: Column, most: int) -> Column:
    """A record's cells; `most` is the number of cells that any header has."""
    plain = F.split(text, ",")
    schema = ", ".join(f"c{i} STRING" for i in range(most + 1))
    options = {"escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    # A cell that is still open at the file's end is closed there.
    closed = F.when(_quotes(text) % 2 == 1, F.concat(text, F.lit('"'))).otherwise(text)
    parsed = F.from_csv(F.concat(closed, F.lit("," + LAST_CELL)), schema, options)
    # An empty cell comes as NULL, as one that is not there does; the last cell tells them apart.
    cells = F.array(*(F.coalesce(parsed[f"c{i}"], F.lit("")) for i in range(most + 1)))
    end = F.array_position(cells, LAST_CELL)
    quoted = F.slice(cells, F.lit(1), F.when(end > 0, end.cast("int") - 1).otherwise(F.lit(most)))
    return F.when(F.contains(text, F.lit('"')), quoted).otherwise(plain)


def _checked(value: Column, block: Column, known: Column) -> Column:
    """`value`, if the line's number is one that the first scan gave to its split."""
    changed = F.raise_error(F.concat(F.lit("other splits than counted in "), F.col("file")))
    return F.when(F.coalesce(known | ~block, F.lit(False)), value).otherwise(changed)


def _scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = _lines(spark, paths)
    splits = staged(_splits(lines), "csv-splits")
    headers = splits.where("block = 0 AND header IS NOT NULL")
    files = staged(headers.select("file", "first", "last", _names(F.col("header")).alias("names")), "csv-headers")
    most = files.agg(F.max(F.size("names"))).first()[0] or 1
    inside = F.col("row").between(F.col("first"), F.col("last"))

    known = lines.join(within_broadcast(files), "file", "left")
    known = known.withColumn("names", _checked(F.col("names"), F.col("block") == 0, inside))
    body = known.where((F.col("block") != 0) | (F.col("row") != F.col("first"))).drop("first", "last")
    if splits.where("inside OR odd").isEmpty():
        records = body.select("file", "block", "row", "names", F.col("value").alias("text"))
    else:
        marks = splits.select("file", "block", "first", "last", "inside", (F.col("inside") | F.col("odd")).alias("open"))
        marked = body.join(within_broadcast(marks), ["file", "block"], "left")
        marked = marked.withColumn("open", _checked(F.col("open"), F.lit(True), inside))
        whole = marked.where(~F.col("open")).select("file", "block", "row", "names", F.col("value").alias("text"))
        loose = marked.where("open").select("file", "block", "row", "value", "inside")
        # A split's lines have to come in order, by whatever way the marks were joined.
        ordered = loose.repartition("file", "block").sortWithinPartitions("file", "block", "row")
        pieces = ordered.mapInPandas(_joined, "file string, block long, row long, kind int, text string")
        pieces = staged(pieces, "csv-records")
        columns = ["file", "block", "row", "text"]
        made = pieces.where(F.col("kind") == RECORD).select(*columns)
        made = made.unionByName(_across(pieces.where(F.col("kind") != RECORD)).select(*columns))
        records = whole.unionByName(made.join(within_broadcast(files.select("file", "names")), "file"))
    text = F.regexp_replace("text", "\r$", "")
    records = records.withColumn("text", text).where(F.char_length(F.trim("text")) > 0)
    cells = records.withColumn("cells", _cells(F.col("text"), most))

    def cell(name: str) -> Column:
        at = F.array_position("names", name).cast("int")
        return F.when(at == 0, F.lit(ABSENT[name])).otherwise(F.get("cells", at - 1)).alias(name)

    return cells.select(*map(cell, ABSENT), F.struct("file", "block", "row").alias("ord"))


def read_records(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Item rows of CSV files, each by its own header: creator_name, cover_url, updated_at, ord.

    As `read_items`: an empty cell is `''`, one that the row is too short to have is NULL, a missing creator column
    reads as `unknown`, blank lines are passed over. Files without any line give no rows.
    """
    # A path is a name here, not a pattern.
    names = [GLOB.sub(r"\\\1", path) for path in paths]
    out = None
    for at in range(0, len(names), FILES_PER_SCAN):
        rows = _scan(spark, names[at : at + FILES_PER_SCAN])
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], ROWS) if out is None else out


def read_item_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """Item rows of the files among `paths`, and the paths that are none or hold nothing; no file is opened for that."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def filled(path: str) -> bool:
        target = jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(conf)
        if not files.exists(target):
            return False
        status = files.getFileStatus(target)
        return status.isFile() and status.getLen() > 0

    with ThreadPoolExecutor(16) as pool:
        there = dict(zip(paths, pool.map(filled, paths), strict=True))
    found = [p for p in paths if there[p]]
    return (read_records(spark, found) if found else None), [p for p in paths if not there[p]]


def key_of(file: Column, root: str) -> Column:
    """The key below `root` of a file as scans name it, which is as a URI."""
    plain = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    return F.substring_index(plain, root.rstrip("/") + "/", -1)


def stored_files(spark: SparkSession, refs: DataFrame, root: str) -> DataFrame:
    """Which of the keys in `refs` (s3_key) are files below `root` that hold something: s3_key, path.

    The folders that keys lie in are listed; contents are not read.
    """
    base = root.rstrip("/") + "/"
    folder = F.regexp_replace("s3_key", "[^/]*$", "")
    folders = [row.folder for row in refs.select(folder.alias("folder")).distinct().toLocalIterator()]
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    places = [hadoop(base + name) for name in folders if name is not None]
    places = [p.toString() for p in places if p.getFileSystem(conf).exists(p)]
    if not places:
        return spark.createDataFrame([], "s3_key STRING, path STRING")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listed = reader.load([GLOB.sub(r"\\\1", p) for p in places]).where("length > 0").select("path")
    keyed = listed.withColumn("s3_key", F.substring_index("path", base, -1)).dropDuplicates(["s3_key"])
    return keyed.join(refs.select("s3_key").distinct(), "s3_key", "left_semi").select("s3_key", "path")


def read_referenced(spark: SparkSession, refs: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Item rows of the stored files that `refs` names (s3_key and columns to carry), and the keys that are no file.

    All files are one scan, whatever their headers; the rows meet their message by file. A key that is named by
    several messages gives its rows to each.
    """
    wanted = staged(stored_files(spark, refs, root), "csv-wanted")
    rows = read_records(spark, (row.path for row in wanted.select("path").toLocalIterator()))
    missing = refs.select("s3_key").distinct().join(wanted.select("s3_key"), "s3_key", "left_anti")
    return rows.withColumn("s3_key", key_of(F.col("ord.file"), root)).join(refs, "s3_key"), missing
