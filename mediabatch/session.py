"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast up to so many rows and bytes as text; a larger table is left to Spark's shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 1 << 26

# Runtime SQL settings the plans rely on; a cluster's own values win when present.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the next operator wants the same partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Resampling does far more work per shuffled byte than joins do: merge fewer partitions.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Only on a local master a temporary one is made where none is named: elsewhere each machine would have its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="mediabatch-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read again; the folder goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def within_broadcast(df: DataFrame) -> DataFrame:
    """`df`, a stored table, marked for broadcast if its rows and bytes allow it."""
    if df.count() > BROADCAST_ROWS:
        return df
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


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
