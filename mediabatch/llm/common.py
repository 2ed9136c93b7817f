"""Helpers the operators share: tables in the shared folder, row keys, a bitmap of fixed size, worker state."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediabatch.session import shared_dir

# A bitmap has some eight bits a key, between 2 MB and 32 MB. Beyond some 30 million keys it lets more rows
# through; the exact join behind it decides, so only the saved shuffle gets smaller.
BITMAP_BITS, MOST_BITS = 24, 28

# Small tables are broadcast up to this many rows and this many bytes as text; beyond that the same join is left to
# Spark's shuffle.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 1 << 26

# A row's key is its file's number, then its place in the file.
PLACE_BITS = 40
ROOT = re.compile(r"^([A-Za-z0-9+.-]+):/+")
ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read again: later steps neither repeat it nor lose it."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, *tables: DataFrame) -> str:
    """`name`, or a longer one, that no column of the tables has in any case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def with_row(docs: DataFrame, name: str = ROW) -> DataFrame:
    """Adds a key that tells repeated rows apart: the number of the row's file and its place there.

    Both are part of the stored data, so every scan of a table gives the same keys, however it is split. What is not read
    from Parquet files is stored with keys first.
    """
    # The two name the root of a file system with a different number of slashes.
    files = sorted({ROOT.sub(r"\1:/", f) for f in docs.inputFiles()})
    file, number, at = (free_name(x, docs) for x in ("_file", "_number", "_at"))
    try:
        meta = docs.metadataColumn("_metadata")
        named = F.regexp_replace(meta["file_path"], ROOT.pattern, "$1:/")
        placed = docs.select(*columns_of(docs), named.alias(file), meta["row_index"].alias(at))
    except AnalysisException:
        return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows")
    if len(files) == 1:
        return placed.withColumn(name, F.col(at)).drop(file, at)
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), f"{number} long, {file} string")
    numbers = F.broadcast(numbers) if len(files) <= BROADCAST_ROWS else numbers
    known = F.coalesce(number, F.raise_error(F.concat(F.lit("not among the table's files: "), file)))
    key = F.shiftleft(known, PLACE_BITS).bitwiseOR(F.col(at))
    return placed.join(numbers, file, "left").withColumn(name, key).drop(file, number, at)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small(df: DataFrame) -> DataFrame:
    """`df`, a stored table, marked for broadcast if it is small enough; beyond that Spark shuffles."""
    if df.count() > BROADCAST_ROWS:
        return df
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*columns_of(df)))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def bitmap_bits(n: int) -> int:
    return min(max(BITMAP_BITS, (8 * n).bit_length()), MOST_BITS)


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The keys' hashes as a bitmap (bucket, bits): 2^(bits - 15) rows of 4 KB at most."""
    bit = _bit(F.col(key), bits)
    return (
        keys.filter(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    )


def with_hit(rows: DataFrame, bitmap: DataFrame, key: str, hit: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Adds the column `hit`: false only where the key is certainly none of the bitmap's keys."""
    bit = _bit(F.col(key), bits)
    bucket, held = free_name("_bucket", rows), free_name("_bits", rows)
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(held, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.withColumn(bucket, F.bitmap_bucket_number(bit))
        .join(F.broadcast(bitmap.select(F.col("bucket").alias(bucket), F.col("bits").alias(held))), bucket, "left")
        .withColumn(hit, F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)))
        .drop(bucket, held)
    )


def _marked(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, str]:
    bits, hit = bitmap_bits(keys.count()), free_name("_hit", rows)
    return with_hit(rows, stored(key_bitmap(keys, key, bits), "bitmap"), key, hit, bits), hit


def rows_among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among `keys`, a stored table: the bitmap drops most others before the exact join shuffles texts."""
    marked, hit = _marked(rows, keys, key)
    near = marked.filter(F.col(hit)).drop(hit)
    return near.join(keys.select(key).distinct().hint("shuffle_hash"), key, "left_semi")


def rows_not_among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among `keys`, a stored table; only rows that the bitmap can't clear are shuffled."""
    marked, hit = _marked(rows, keys, key)
    near = marked.filter(F.col(hit)).drop(hit).join(keys.select(key).distinct().hint("shuffle_hash"), key, "left_anti")
    return marked.filter(~F.col(hit)).drop(hit).unionByName(near)


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` without the rows whose keys are in `dropped`, a stored table with the column ROW."""
    key = free_name(ROW, docs)
    left = rows_not_among(with_row(docs, key), dropped.select(F.col(ROW).alias(key)), key)
    return left.select(*columns_of(docs))


def stretches(texts: list[str], size: int = 1 << 20) -> Iterator[range]:
    """Places of neighbouring texts, about `size` characters at a time."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield range(first, i + 1)
            first, held = i + 1, 0
    if first < len(texts):
        yield range(first, len(texts))


def give_back() -> None:
    """Gives the worker's unused memory back to the system."""
    gc.collect()
    with contextlib.suppress(ImportError):
        import pyarrow

        pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can't, memory is kept for later use
        ctypes.CDLL(None).malloc_trim(0)


def releasing(work: Callable) -> Callable:
    """`work`, a generator over a task's batches; workers outlive their tasks, so unused memory is given back at its end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


@contextlib.contextmanager
def light_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Jobs that run inside hand texts and sets to Python in batches of about `size` bytes, unless the session names its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    named = spark.sparkContext.getConf().contains(name)
    old = spark.conf.get(name, None)
    if not named:
        spark.conf.set(name, size)
    try:
        yield
    finally:
        if not named:
            spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def worker_state(group: str, key: str, make: Callable):
    """What `make` gives, made once per Python worker. Functions travel by value, so a module's own globals would not last.

    A worker outlives its operator: the state of one group is let go when another group's is asked for, and its memory given
    back to the system.
    """
    store = sys.modules.setdefault("mediabatch_worker_state", types.ModuleType("mediabatch_worker_state")).__dict__
    if store.get("group") != group:
        store["group"], store["items"] = group, {}
        give_back()
    items = store["items"]
    if key not in items:
        items[key] = make()
    return items[key]


class Cache(dict):
    """A look-up that makes missing values and keeps at most `limit` of them."""

    def __init__(self, make: Callable, limit: int = 1 << 18):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value
