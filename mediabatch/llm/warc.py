"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing: each page is a record; of equal payloads the one with the smallest page_id is the response and the others are
revisit records without a body. Spark's text writer puts the records, UTF-8 as they are, into part files.

Reading: Spark's text reader cuts the files at the record magic, in splits of any file, so a row is what lies
between two magics. Running sums of the rows' lengths, first inside each split and then over a file's splits, give every
row's byte offset. A row whose header parses is a candidate record; its Content-Length says where its successor begins.
Where each successor is the next candidate, candidates form a run; runs are joined by pointer jumping from the file's
first byte. Only candidates reached that way are records: a magic inside a payload starts a candidate that nothing
reachable points to. Payloads cut by such a magic are put together again from a second read of just those rows.

Nothing but numbers and headers is shuffled, and no task needs a whole file. Defined cases: a null html is an empty payload; line
breaks in a url become spaces; a null url is left out; a record whose length runs past the file's end, and what follows a
broken chain, is not returned; null page ids and repeated ids are pages of their own; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediabatch.llm.common import ROW, new_path, small, stored, with_row

# Fixed values of the format (WARC 1.1).
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
BASE32_HEX = "0123456789abcdefghijklmnopqrstuv"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
# The digest of no bytes stands for nothing special here: empty payloads are deduplicated like any other.
LEAST_BYTES = 0


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: 160 bits are four groups of 40, 10 hex or 8 base32 digits each."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.lower(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32)), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*groups), BASE32_HEX, BASE32)


def _records(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Per page: row, page_id, url, payload, bytes, digest, and the first page (and row) of the same payload."""
    rows = with_row(pages.select("page_id", "url", "html")).select(
        F.col(ROW).alias("row"),
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7f]+", " ").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn(
        "digest", base32_sha1(F.col("payload"))
    )
    first = (
        stored(rows.filter(F.col("bytes") >= least_bytes).select("digest", "page_id", "row"), "digests")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first"))
        .filter("n > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    # Few payloads are repeated: pages of all others go past the join.
    repeated = stored(first, "repeated")
    return rows, repeated


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def record_id(row: Column) -> Column:
    digest = F.md5(F.concat(F.lit("record:"), row.cast("string")))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Writes `pages` (page_id, url, html) as WARC files under `path`."""
    rows, repeated = _records(pages, least_bytes)
    joined = rows.join(small(repeated), "digest", "left")
    revisit = (F.col("bytes") >= least_bytes) & F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", record_id(F.col("row"))),
        _line("WARC-Date", F.lit(DATE)),
        F.coalesce(_line("WARC-Target-URI", F.col("url")), F.lit("")),
        F.coalesce(_line("X-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Profile", F.lit(PROFILE)),
                _line("WARC-Refers-To", record_id(F.col("first_row"))),
                F.coalesce(_line("X-Refers-To-Page", F.col("first_id").cast("string")), F.lit("")),
            ),
        ).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
    )
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)


@contextlib.contextmanager
def one_layout(spark: SparkSession) -> Iterator[None]:
    """Inside, every read of the same files has the same splits, also if executors come or go between two of them.

    Spark derives the splits' number from the cores it has when a read is planned, unless it is set.
    """
    name = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(name, None)
    if old is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic, up to the next one: file, block, seq, value (bytes), magic (whether one stands before)."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def _placed(chunks: DataFrame) -> DataFrame:
    """Adds `at`, the offset of the chunk's first byte in its file."""
    size = F.col("size") + F.lit(len(MAGIC))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = chunks.withColumn("inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    blocks = chunks.groupBy("file", "block").agg(F.sum(size).alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    return rows.join(blocks, ["file", "block"]).withColumn("at", F.col("before") + F.col("inside")).drop(
        "before", "inside"
    )


def _field(name: str) -> str:
    """SQL for a header field's value, NULL if it isn't there."""
    return rf"nullif(regexp_extract(head, r'(?im)^{name}:[ \t]*([^\r\n]*)', 1), '')"


def chunk_table(spark: SparkSession, path: str) -> DataFrame:
    """A light row per chunk: its place, its header's fields if it has one, and the payload's digest if it is whole."""
    text = F.col("value").cast("string")
    cut = F.locate(END, text)
    chunks = (
        _chunks(spark, path)
        .withColumn("size", F.octet_length("value").cast("long"))
        .withColumn("head", F.when(cut > 0, F.substring(text, F.lit(1), cut + 1)))
        .withColumn("head_size", F.octet_length("head").cast("long") + 2)
        .withColumn("length", F.expr(f"try_cast({_field('Content-Length')} AS BIGINT)"))
    )
    whole = F.col("size") >= F.col("head_size") + F.col("length")
    payload = F.substring("value", F.col("head_size").cast("int") + 1, F.col("length").cast("int"))
    light = chunks.select(
        "file",
        "block",
        "seq",
        "file_size",
        "size",
        "head_size",
        F.when(F.col("length") >= 0, F.col("length")).alias("length"),
        F.expr(_field("WARC-Type")).alias("type"),
        F.expr(_field("WARC-Record-ID")).alias("record_id"),
        F.expr(_field("WARC-Target-URI")).alias("url"),
        F.expr(f"try_cast({_field('X-Page-ID')} AS BIGINT)").alias("page_id"),
        F.expr(_field("WARC-Payload-Digest")).alias("stated_digest"),
        F.expr(f"try_cast({_field('X-Payload-Length')} AS BIGINT)").alias("stated_bytes"),
        F.expr(f"try_cast({_field('X-Refers-To-Page')} AS BIGINT)").alias("refers_to"),
        F.when(whole, base32_sha1(payload)).alias("digest"),
    )
    return stored(_placed(stored(light, "chunks")), "placed")


def candidates(chunks: DataFrame) -> DataFrame:
    """The chunks that could be records: file, start (of the magic), next (where the successor would start), fields."""
    return (
        chunks.filter((F.col("at") > 0) & F.col("length").isNotNull() & F.col("type").isNotNull())
        .withColumn("start", F.col("at") - len(MAGIC))
        .withColumn("next", F.col("at") + F.col("head_size") + F.col("length") + len(END))
        .filter(F.col("next") <= F.col("file_size"))
    )


def reachable(found: DataFrame) -> DataFrame:
    """The candidates that the chain from each file's first byte reaches."""
    order = Window.partitionBy("file").orderBy("start")
    breaks = F.coalesce((F.lag("next").over(order) != F.col("start")).cast("int"), F.lit(0))
    runs = stored(
        found.select("file", "start", "next")
        .withColumn("break", breaks)
        .withColumn("run", F.sum("break").over(order)),
        "runs",
    )
    # From a run's end the chain goes on in some later run. After round k a jump spans 2^k runs.
    ends = runs.groupBy("file", "run").agg(F.max_by("next", "start").alias("entry"))
    targets = runs.select("file", F.col("start").alias("entry"), F.col("run").alias("to"))
    # Offsets compress so well that a table's file says little of its rows: no broadcast on that ground.
    jumps = stored(ends.join(targets.hint("merge"), ["file", "entry"]), "jumps")
    reached = runs.filter("start = 0").select("file", "run", F.col("start").alias("entry"))
    while not jumps.isEmpty():
        step = reached.select("file", "run").join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), "entry")
        reached = stored(reached.unionByName(step), "reached")
        onward = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("to2"), F.col("entry").alias("entry2"))
        doubled = jumps.drop("entry").join(onward, ["file", "to"])
        jumps = stored(doubled.select("file", "run", F.col("to2").alias("to"), F.col("entry2").alias("entry")), "jumps")
    entries = reached.groupBy("file", "run").agg(F.min("entry").alias("entry"))
    kept = runs.join(entries, ["file", "run"]).filter(F.col("start") >= F.col("entry")).select("file", "start")
    return found.join(kept.hint("merge"), ["file", "start"], "left_semi")


def _bodies(spark: SparkSession, path: str, chunks: DataFrame, records: DataFrame) -> DataFrame:
    """The payloads (binary) of `records`, a stored table: file, start, payload. Reads the archive again, which has to be done
    in the layout of the first read."""
    own = Window.partitionBy("file").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, 0)
    marks = records.select("file", F.col("start"), F.col("next"), (F.col("start") + len(MAGIC)).alias("at"))
    owned = (
        chunks.select("file", "at", "block", "seq", "size")
        .join(marks, ["file", "at"], "left")
        .withColumn("start", F.last("start", ignorenulls=True).over(own))
        .withColumn("next", F.last("next", ignorenulls=True).over(own))
        .filter("at < next")
        .select("file", "block", "seq", "at", "start")
    )
    values = _chunks(spark, path).drop("file_size")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda c: c["value"])
    magic = F.lit(MAGIC.encode())
    joined = F.reduce(
        F.slice(parts, 2, F.size(parts)), F.element_at(parts, 1), lambda a, b: F.concat(a, magic, b)
    )
    whole = values.join(owned.hint("merge"), ["file", "block", "seq"]).groupBy("file", "start").agg(joined.alias("value"))
    return whole.join(records.select("file", "start", "head_size", "length"), ["file", "start"]).select(
        "file",
        "start",
        F.substring("value", F.col("head_size").cast("int") + 1, F.col("length").cast("int")).alias("payload"),
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: file, start, type, record_id, url, page_id, length, digest (of the body), and what they state."""
    with one_layout(spark):
        chunks = chunk_table(spark, path)
        records = stored(reachable(stored(candidates(chunks), "candidates")), "records")
        broken = records.filter("digest IS NULL")
        if not broken.isEmpty():
            again = _bodies(spark, path, chunks, stored(broken, "broken"))
            again = stored(again.select("file", "start", base32_sha1(F.col("payload")).alias("again")), "again")
            records = records.join(again, ["file", "start"], "left").withColumn("digest", F.coalesce("digest", "again"))
    return records.select(
        "file", "start", "type", "record_id", "url", "page_id", "length", "digest", "stated_digest", "stated_bytes",
        "refers_to",
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The records' bodies as bytes: file, start, payload, as a stored table."""
    with one_layout(spark):
        chunks = chunk_table(spark, path)
        records = stored(reachable(stored(candidates(chunks), "candidates")), "records")
        return stored(_bodies(spark, path, chunks, records), "payloads")


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes the pages, reads the archive back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(pages, path, least_bytes)
    revisit = F.col("type") == "revisit"
    stated = F.regexp_replace("stated_digest", "^sha1:", "")
    return read_warc(spark, path).select(
        "page_id",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
    )
